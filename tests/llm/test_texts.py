"""Operators that judge each text, against plain Python."""

import base64
import hashlib
import math
import random
import re
import string
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tidewatch.llm import catalog, fingerprints, language, quality, secrets, warc
from tidewatch.session import scoped_conf
from tests.llm.conftest import rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_agrees_with_sql(spark, duck, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    relation = duck.sql(catalog.ORACLES[name])
    assert sorted(df.columns) == sorted(relation.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(relation.columns, relation.fetchall())


def test_every_operator_is_registered():
    names = driver.queries()
    assert "pipeline" in names
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))


def shingles(text, size=5):
    words = WORD.findall(text)
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check_edited(rows, texts):
    """Compare with the definition; ``texts`` in descending order of id."""
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(texts)
    errors = []
    for (doc_id, text), (_, following) in zip(texts, texts[1:] + texts[:1]):
        text, following, r = text or "", following or "", by_id[doc_id]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        errors += [r["near_edited"] - jaccard(text, edited), r["near_next"] - jaccard(text, following)]
        if text == edited:
            assert r["fingerprint"] == r["edited_fingerprint"] and r["near_edited"] == 1
    return errors


def test_fingerprints_of_all_documents(spark, duck, sf_dir):
    rows = catalog.QUERIES["op1_fingerprints"](spark, sf_dir).collect()
    texts = duck.sql("SELECT doc_id, text FROM documents ORDER BY doc_id DESC").fetchall()
    errors = check_edited(rows, texts)
    assert max(abs(e) for e in errors) < 0.2
    assert abs(sum(errors) / len(errors)) < 0.01  # the chance agreements are taken out
    assert sum(e * e for e in errors) / len(errors) < 0.0015


def test_fingerprints_of_odd_texts(documents):
    words = [f"w{i}" for i in range(400)]
    texts = [(9, "é" * 7), (8, None), (7, ""), (5, " ".join(words)), (4, " ".join(words)), (3, "one two"), (-2, "x \t\n y")]
    for rows in ([texts], [texts[:1]]):
        made = fingerprints.edited_fingerprints(documents([r[:2] for r in rows[0]])).collect()
        check_edited(made, rows[0])
    made = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(documents(texts)).collect()}
    assert made[5]["fingerprint"] == made[4]["fingerprint"] and made[5]["near_next"] == 1
    assert made[8]["near_next"] == 1 and made[9]["near_next"] == 0
    assert len(made[3]["fingerprint"]) == fingerprints.BINS * fingerprints.BITS // 4
    assert fingerprints.edited_fingerprints(documents([])).count() == 0
    odd = fingerprints.edited_fingerprints(documents([(1, "a b"), (1, "a b"), (None, "c d"), (None, "e f")]))
    assert odd.count() == 4


def test_fingerprint_runs_do_not_change_neighbours(spark, documents):
    texts = [(i * 7 % 101, f"text number {i} " + "word " * (i % 13)) for i in range(101)]
    assert not [e for e in check_edited(fingerprints.edited_fingerprints(documents(texts)).collect(), sorted(texts, reverse=True)) if abs(e) > 0.25]


def test_quality_on_held_out_labels(spark, duck, sf_dir):
    rows = catalog.QUERIES["op4_quality"](spark, "/root/testdata/sf0.01").collect()
    labels = dict(duck.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall())
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    tested = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    right = [p == y for p, y in tested]
    assert sum(right) / len(right) > 0.93
    good = [p for p, y in tested if y]
    assert sum(good) / len(good) > 0.95


def test_quality_of_odd_tables(spark, documents):
    docs = documents([(1, None), (1, None), (2, ""), (None, "some text"), (3, "more " * 30000)])
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = quality.quality_scores(docs, none).collect()
    assert len(rows) == 5 and all(r["score"] == 1 for r in rows)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id bigint, quality int, toxic int")
    many = documents([(i, f"good plain words number {i} " * 9 if i % 2 else f"BAD!! {i}!! " * 20) for i in range(40)])
    scores = {r["doc_id"]: r["score"] for r in quality.quality_scores(many.union(docs.where("doc_id is null")), labels).collect()}
    assert len(scores) == 41 and all(0 <= s <= 1 for s in scores.values())
    kept = quality.good_documents(many.withColumn("score", F.lit(3)).withColumn("row_key", F.lit(1)), labels)
    assert kept.columns == [*many.columns, "score", "row_key"]


def test_quality_ignores_held_out_labels(spark, documents):
    many = documents([(i, f"plain words {i} and others " * 9 if i % 2 else f"BAD!! {i}!! " * 20) for i in range(80)])
    held = {i for i in range(80) if zlib.crc32(str(i).encode()) % 4 == 2}
    make = lambda flip: spark.createDataFrame(
        [(i, 1 - i % 2 if flip and i in held else i % 2, 0) for i in range(80)], "doc_id bigint, quality int, toxic int"
    )
    assert quality.train(many, make(False)) == quality.train(many, make(True))


def test_language_on_held_out_documents(spark, duck):
    rows = catalog.QUERIES["op8_language"](spark, "/root/testdata/sf0.01").collect()
    lang = dict(duck.sql("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").fetchall())
    tested = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert len(tested) > 100 and sum(tested) / len(tested) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_texts(documents):
    docs = documents(
        [(i, "the cat and the dog" if i % 2 else "der Hund und die Katze", "en" if i % 2 else "de") for i in range(40)]
        + [(100, None, "en"), (101, "", "en"), (102, "123 !!", None), (103, "the und", None), (104, "dog " * 30000, None), (None, "Katze", "de")]
    )
    made = {r["doc_id"]: r for r in language.languages(docs).collect()}
    assert [made[i]["lang_pred"] for i in (100, 101, 102)] == ["und"] * 3 and made[102]["score"] == 0
    assert made[104]["lang_pred"] == "en" and made[None]["lang_pred"] == "de" and not made[None]["held_out"]
    assert language.languages(documents([])).count() == 0
    assert [r["lang_pred"] for r in language.languages(documents([(1, "words", None)])).collect()] == ["und"]
    model = language.train(docs)
    # An unknown word scores by the longest n-grams of which any is known.
    assert language.word_score(model, "katzen") is not None and language.word_score(model, "qqq") is None


BASE = {
    "assign": (re.compile(secrets.ASSIGN[4:-1], re.I | re.A), lambda m: len(m[2]) >= 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
}


def base_spans(text):
    found = [
        (m.start(), k, m.end(), name) for k, (name, (p, ok)) in enumerate(BASE.items()) for m in p.finditer(text or "") if ok(m)
    ]
    return [f"{name}:{a}:{b}" for a, _, b, name in sorted(found)]


def check_secrets(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        base = base_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest(), texts[r["doc_id"]]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s.startswith(k + ":") for s in base) for k in BASE]
        shown = [s for s in r["spans"].split(",") if s]
        assert [s for s in shown if not s.startswith("random")] == base
        assert shown == sorted(shown, key=lambda s: (int(s.split(":")[1]), [*BASE, "random"].index(s.split(":")[0])))


def test_secrets_of_all_documents(spark, duck):
    sf_dir = "/root/testdata/sf0.01"
    texts = dict(duck.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall())
    check_secrets(catalog.QUERIES["op9_secrets"](spark, sf_dir).collect(), texts)


def test_secrets_in_odd_texts(documents):
    draw = random.Random(3)
    b64 = "".join(draw.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(60))
    texts = {
        1: "secret=token: abcdefgh", 2: "é password = 'hunter22' Token:abc API_KEY=\"x.y-z_1\" apikey:123456",
        3: "AKIA" + "B" * 16 + " xAKIAAKIA1", 4: "0123456789abcdef0123456789 " + "a" * 23 + "😀" + "f" * 24, 5: None, 6: "",
        7: "plain words " * 9000 + "key " + b64, 8: "https://example.org/a/long/path/of/ordinary/words",
        9: "-" * 40 + " " + "A" * 40, 10: "secret=" * 40,
    }
    rows = secrets.secret_digest(documents(list(texts.items()))).collect()
    check_secrets(rows, texts)
    found = {r["doc_id"]: r["n_random"] for r in rows}
    assert found[7] == 1 and found[8] == 0 and found[9] == 0
    assert secrets.secret_digest(documents([])).count() == 0
    assert secrets.secret_digest(documents([(1, "AKIA"), (1, "AKIA"), (None, "x")])).count() == 3


def check_pages(rows, pages):
    """``pages``: page_id to html; ids differ."""
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    first = {}
    for page_id, html in pages.items():
        first[digest(html)] = min(first.get(digest(html), page_id), page_id)
    assert len(rows) == len(pages)
    for r in rows:
        html = pages[r["page_id"]] or ""
        again = first[digest(html)] != r["page_id"]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(html.encode()), digest(html))
        assert (r["record_type"], r["refers_to"]) == (("revisit", first[digest(html)]) if again else ("response", None))
        assert again or bytes(r["payload"]).decode() == html


def test_archives_of_all_pages(spark, duck, sf_dir, tmp_path):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    warc.write_archives(pages, str(tmp_path / "a"), segment_bytes=3000)
    assert spark.read.format("binaryFile").load(str(tmp_path / "a/part-*")).count() > 0
    parts = warc.read_records(spark, str(tmp_path / "a"))
    assert parts.where("segment > 1").count() > 10
    check_pages(warc.read_pages(spark, str(tmp_path / "a")).collect(), dict(pages.select("page_id", "html").collect()))


def test_archives_of_odd_pages(spark, tmp_path):
    trap = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    html = {1: trap * 40, 2: None, 3: "", 4: "ä" * 50001, 5: trap * 40, 7: "0\r\n\r\n", 6: "0\r\n\r\n"}
    df = spark.createDataFrame([(i, "http://x/\r\nWARC-Type: bad", h, "extra") for i, h in html.items()], "page_id bigint, url string, html string, digest string")
    warc.write_archives(df, str(tmp_path / "b"), segment_bytes=1000)
    check_pages(warc.read_pages(spark, str(tmp_path / "b")).collect(), html)
    same = spark.createDataFrame([(1, "u", "x" * 3000), (1, "u", "x" * 3000), (2, "u", "x" * 3000), (None, None, "y"), (None, None, None)], "page_id bigint, url string, html string")
    warc.write_archives(same, str(tmp_path / "c"), segment_bytes=1000)
    made = sorted((r["page_id"] or 0, r["record_type"], r["payload_bytes"]) for r in warc.read_pages(spark, str(tmp_path / "c")).collect())
    assert made == [(0, "response", 0), (0, "response", 1), (1, "response", 3000), (1, "response", 3000), (2, "revisit", 3000)]
    warc.write_archives(df.limit(0), str(tmp_path / "d"))
    assert warc.read_pages(spark, str(tmp_path / "d")).count() == 0


def test_archives_follow_the_bytes_not_the_partitions(spark, tmp_path):
    """Few pages in many shuffle partitions are as many archives as there are cores, at most; a copy still finds its first."""
    cores = spark.sparkContext.defaultParallelism
    width = str(8 * cores + 1)
    df = spark.range(1000).selectExpr("id AS page_id", "'u' AS url", "repeat(cast(id % 900 AS string), 20) AS html")
    settings = {
        "spark.sql.shuffle.partitions": width, "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    with scoped_conf(spark, settings):
        warc.write_archives(df, str(tmp_path / "f"))
        made = warc.read_pages(spark, str(tmp_path / "f")).collect()
    assert len(list((tmp_path / "f").glob("part-*"))) <= cores
    check_pages(made, dict(df.select("page_id", "html").collect()))


def test_a_missing_segment_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "x" * 5000)], "page_id bigint, url string, html string")
    warc.write_archives(df, str(tmp_path / "e"), segment_bytes=1000)
    parts = warc.read_records(spark, str(tmp_path / "e"))
    for lost in ("segment = 2", "total is not null", "segment = 1"):
        with pytest.raises(Exception, match="segments missing"):
            warc.reassembled(parts.where(f"not ({lost})")).collect()


def test_chunked_framing():
    for body in (b"", b"x", b"\r\n0\r\n\r\n" * 900):
        assert warc.unchunked(warc.chunked(body, 7)) == body
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


def _tail(z):
    return 1 / (1 + math.exp(min(600.0, z * 1.5976 + z**3 * 0.07056)))


def _battery(match):
    """P-values of the three tests (thrice the least) and of ordinary text, from the formulas alone."""
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", match):
        name, match = "hex", match.lower()
    else:
        name = "base32" if re.fullmatch("[A-Z2-7]+", match) else "base36" if re.fullmatch("[0-9a-z]+", match) else "base64"
    alphabet = secrets.ALPHABETS[name]
    x = [alphabet.index(c) for c in match.replace("-", "+").replace("_", "/")]
    m, n = len(alphabet), len(x)
    chi = sum(v * v for v in Counter(x).values()) * m / n - n
    z_chi = (chi - (m - 1)) / math.sqrt(2 * (m - 1) * (1 - 1 / n))
    side = [v >= m // 2 for v in x]
    both = 2 * sum(side) * (n - sum(side))
    runs = 1 + sum(a != b for a, b in zip(side, side[1:]))
    spread = both * (both - n) / (n * n * (n - 1))
    z_runs = (runs - (1 + both / n)) / math.sqrt(spread) if spread > 0 else 99.0
    middle, square = (m - 1) / 2, (m * m - 1) / 12
    z_serial = sum((a - middle) * (b - middle) for a, b in zip(x, x[1:])) / (square * math.sqrt(n - 1))
    uniform = min(1.0, 3 * min(_tail(z_chi), 2 * _tail(abs(z_runs)), 2 * _tail(abs(z_serial))))
    surprise, mean, variance = secrets._letter_model(alphabet, name in ("hex", "base32"))
    return uniform, _tail((sum(surprise[v] for v in x) - n * mean) / math.sqrt(n * variance))


def brute_random_spans(texts):
    """Benjamini-Hochberg by class of length over the candidates of all texts, in bins of a tenth of a decade."""
    tested = []
    for doc_id, text in texts.items():
        for found in re.finditer(secrets.CANDIDATE, text):
            uniform, p = _battery(found[0])
            size = max(c for c in secrets.CLASSES if c <= len(found[0]))
            b = min(secrets.BINS, math.floor(-10 * math.log10(max(p, 1e-300))))
            tested.append((doc_id, found.start(), found.end(), size, b, uniform >= secrets.LEVEL))
    least = {}
    for size in secrets.CLASSES:
        mine = [t for t in tested if t[3] == size]
        for b in sorted({t[4] for t in mine}, reverse=True):
            if 10 ** (-b / 10) <= secrets.RATE * sum(t[5] for t in mine if t[4] >= b) / len(mine):
                least[size] = b
    return {(d, s, e) for d, s, e, size, b, passed in tested if passed and size in least and b >= least[size]}


def test_random_spans_by_brute_force(documents):
    rng = random.Random(9)
    kinds = [*secrets.ALPHABETS.values(), "e" * 9 + "taoinsrhld", string.ascii_lowercase + "_/"]
    texts = {}
    for i in range(150):
        parts = []
        for _ in range(rng.randrange(12)):
            parts.append("".join(rng.choice(rng.choice(kinds[-2:]) if rng.random() < 0.3 else kinds[i % 6]) for _ in range(rng.choice([5, 19, 20, 31, 40, 64, 200]))))
            parts.append(rng.choice([" ", "é ", ".", " token: ", "password=", " = ", "AKIA"]))
        texts[i] = "".join(parts)
    expected = brute_random_spans(texts)
    rows = secrets.secret_digest(documents(list(texts.items()))).collect()
    for r in rows:
        found = [s.split(":") for s in r["spans"].split(",") if s]
        base = [(int(a), int(b)) for k, a, b in found if k != "random"]
        mine = {(r["doc_id"], a, b) for d, a, b in expected if d == r["doc_id"]}
        free = {t for t in mine if not any(a < t[2] and t[1] < b for a, b in base)}
        assert {(r["doc_id"], int(a), int(b)) for k, a, b in found if k == "random"} == free
    assert sum(r["n_random"] for r in rows) > 50


def test_time_of_secrets_follows_the_length(documents):
    """A run of a million characters, and fifty thousand matches next to as many runs, in one text each."""
    rng = random.Random(4)
    run = "".join(rng.choice(secrets.ALPHABETS["base64"]) for _ in range(1_000_000))
    many = " ".join(f"token={rng.getrandbits(64):016x} {rng.getrandbits(96):024X}" for _ in range(50_000))
    began = time.time()
    rows = {r["doc_id"]: r for r in secrets.secret_digest(documents([(1, run), (2, many)])).collect()}
    assert time.time() - began < 240
    assert rows[1]["spans"] == "random:0:1000000" and rows[2]["n_assign"] == 50_000


@pytest.mark.parametrize("seed", range(6))
def test_the_curve_reaches_its_maximum(seed):
    """Plain Newton steps ran off on some of these; no small step from the weights found raises the likelihood."""
    rng = np.random.default_rng(seed)
    n = rng.integers(50, 40_000, 900).astype(float)
    good = n * rng.uniform(0.02, 0.6, 900)
    y = (rng.random(900) < [0.5, 0.9, 0.1, 0.99, 0.5, 0.7][seed]).astype(float)
    x = quality.features(n, good, good * np.where(y == 1, 1.4, 0.7) * rng.uniform(0.9, 1.1, 900))
    if seed > 3:
        x[:, 1] *= 40
    w = quality.fit_curve(x, y, np.ones(900))
    value = lambda v: (y * (x @ v) - np.logaddexp(0, x @ v)).sum() - v @ v / 2
    assert np.isfinite(w).all()
    assert all(value(w) >= value(w + d) - 1e-6 for d in rng.normal(size=(200, len(w))) * 1e-2)
    p = quality.probability(x, w)
    assert ((p > 0.5) == (y == 1)).mean() >= max(y.mean(), 1 - y.mean())


def test_scores_by_brute_force(spark, documents):
    """The same dictionaries and weights give the same score for each text, and ids with both labels teach nothing."""
    rng = random.Random(8)
    word = {1: "alpha beta gamma delta epsilon".split(), 0: "buy cheap click now win".split()}
    rows = [(i, " ".join(rng.choice(word[i % 2]) for _ in range(rng.randrange(5, 400)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "alpha " * 30_000), (7, "another text")]
    labels = [(i, i % 2) for i in range(300)] + [(3, 0), (4, 1), (None, 1), (5, None)]
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    model = quality.train(documents(rows), marks)
    good, bad = (zstandard.ZstdCompressor(
        level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_AUTO),
        write_content_size=False, write_checksum=False, write_dict_id=False,
    ) for d in (model.good, model.bad))
    expected = []
    for doc_id, text in rows:
        data = (text or "").encode()
        blocks = [data[i : i + quality.BLOCK] for i in range(0, len(data), quality.BLOCK)]
        g, b = (float(sum(len(c.compress(x)) for x in blocks)) for c in (good, bad))
        both = max(g + b, 1.0)
        d, r = (b - g) / both * 10, 4 * (both / (2 * max(len(data), 1)) if data else 0.5)
        z = sum(w * v for w, v in zip(model.weights, (1.0, d, r, d * d, r * r, d * r), strict=True))
        expected.append((doc_id, 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))))
    made = quality.quality_scores(documents(rows), marks).collect()
    for (doc_id, score), r in zip(sorted(expected, key=str), sorted(((r["doc_id"], r["score"]) for r in made), key=str), strict=True):
        assert r[0] == doc_id and abs(r[1] - score) < 1e-9
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in made)


def test_a_long_record_is_joined_in_proportion(spark):
    """Ten thousand segments of all byte values make one record again."""
    piece = bytes(range(256)) * 8
    rows = [("response", "<urn:x>", "7", None, "D", len(piece) * 10_000, i, len(piece) * 10_000 if i == 10_000 else None, piece) for i in range(1, 10_001)]
    shape = "type string, id string, page_id string, refers_to string, digest string, length bigint, segment int, total bigint, block binary"
    began = time.time()
    (made,) = warc.reassembled(spark.createDataFrame(rows, shape).repartition(3)).collect()
    assert bytes(made["block"]) == piece * 10_000 and time.time() - began < 60
