"""The queries of this folder, and the SQL of those that SQL can express on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (
    collocations,
    conversations,
    decontamination,
    fingerprints,
    language,
    lines,
    mixing,
    pieces,
    quality,
    secrets,
    simhash,
    substrings,
    warc,
)
from tidewatch.llm.common import table
from tidewatch.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


@query()
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and edited texts, and how like they are."""
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP2_WORDS = rf"coalesce(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"


@query(
    rf"""
    WITH item AS (SELECT item_id, {_OP2_WORDS} AS w FROM benchmark),
    spans AS (
        SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS p FROM item WHERE len(w) > 0)
    ),
    doc AS (SELECT doc_id, {_OP2_WORDS} AS w FROM documents),
    sizes AS (SELECT DISTINCT size FROM spans),
    grams AS (
        SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS s
        FROM (SELECT doc_id, size, w, unnest(range(1, greatest(1, len(w) - size + 2))) AS p FROM doc, sizes WHERE len(w) >= size)
    ),
    found AS (SELECT doc_id, p, g.size, item_id FROM grams g JOIN spans USING (size, s)),
    hit AS (
        SELECT doc_id, count(DISTINCT q) AS n_hit
        FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM found) GROUP BY doc_id
    ),
    items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
    )
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM doc d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
    """
)
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that stand in a benchmark item."""
    return decontamination.contaminated_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_BARE = r"trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13))"


@query(
    rf"""
    WITH numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS LAST, source, text) AS rid FROM documents),
    spread AS (
        SELECT line, min(rid) AS first_row
        FROM (SELECT rid, source, {_BARE} AS line FROM (SELECT rid, source, unnest(string_split(text, chr(10))) AS x FROM numbered))
        WHERE line <> '' GROUP BY line HAVING count(DISTINCT coalesce('s' || source, '')) >= {lines.MIN_SITES}
    ),
    placed AS (
        SELECT rid, p, x, {_BARE} AS line
        FROM (SELECT rid, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS p FROM numbered)
    ),
    judged AS (
        SELECT rid, p, x, placed.line, first_row IS NOT NULL AND first_row <> rid AS gone
        FROM placed LEFT JOIN spread USING (line)
    ),
    made AS (
        SELECT rid, count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
            string_agg(x, chr(10) ORDER BY p) FILTER (NOT gone) AS kept
        FROM judged GROUP BY rid
    )
    SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM numbered LEFT JOIN made USING (rid)
    """
)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document, those removed as cross-site boilerplate, and the digest of the text left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    kept = lines.without_boilerplate(docs, counts=True)
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query()
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by compression of all texts."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives and read back."""
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_pages(spark, path).drop("payload")


@query(
    rf"""
    WITH sized AS (
        SELECT doc_id, source, text, row_number() OVER (PARTITION BY doc_id, source, text) AS number,
            CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
    ),
    totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
    weighed AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM totals),
    levels AS (
        SELECT *, (sum(source_size) OVER () - {mixing.MOST} * coalesce(sum(source_size) OVER before, 0))
            / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM weighed
        WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ),
    settled AS (
        SELECT *, (SELECT level FROM levels WHERE level * weight < {mixing.MOST} * source_size
            ORDER BY source_size / weight, source NULLS LAST LIMIT 1) AS one
        FROM levels
    ),
    targets AS (
        SELECT source, source_size, CASE WHEN one * weight < {mixing.MOST} * source_size
            THEN one * weight ELSE CAST({mixing.MOST} * source_size AS DOUBLE) END AS target
        FROM settled
    ),
    rated AS (
        SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
            CAST('0x' || substr(md5(concat_ws(':', '{mixing.SEED}', coalesce(CAST(doc_id AS VARCHAR), 'null'),
                coalesce(md5(text), 'null'), CAST(number AS VARCHAR))), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
        FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
    )
    SELECT doc_id, size, source_size, target,
        CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM rated
    """
)
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    found = mixing.with_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query(
    rf"""
    WITH doc AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
    wins AS (
        SELECT doc_id, p, md5(array_to_string(w[p:p + 34], ' ')) AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM doc WHERE len(w) >= 35)
    ),
    again AS (SELECT s FROM wins GROUP BY s HAVING count(*) > 1),
    gone AS (SELECT DISTINCT doc_id, q FROM (SELECT doc_id, unnest(range(p, p + 35)) AS q FROM wins SEMI JOIN again USING (s))),
    placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM doc WHERE len(w) > 0),
    left_over AS (
        SELECT p.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p.q) AS kept
        FROM placed p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.q = g.q GROUP BY p.doc_id
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM doc LEFT JOIN left_over USING (doc_id)
    """
)
def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without its repeated passages."""
    kept = substrings.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each text."""
    return language.languages(table(spark, sf_dir, "documents"))


@query()
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in each text."""
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


@query()
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components of near-duplicates."""
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


_OP11_PIECES = rf"regexp_split_to_array(coalesce({_LOWERED}, ''), '[.,;:!?\x0A-\x0D]')"


@query(
    rf"""
    WITH piece AS (
        SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
        FROM (SELECT coalesce(lang, 'und') AS lang, unnest({_OP11_PIECES}) AS piece FROM documents)
    ),
    totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM piece GROUP BY lang),
    grams AS (
        SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
        FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM piece, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m)
    ),
    f AS (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
    cuts AS (
        SELECT lang, phrase, a, k, array_to_string(w[:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
        FROM (SELECT lang, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM f WHERE m > 1)
    ),
    scored AS (
        SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, CAST(2000000::HUGEINT * c.a // (l.a + r.a) AS BIGINT) AS score
        FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = x JOIN f r ON r.lang = c.lang AND r.phrase = y
    ),
    weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inside AS (
        SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
        FROM (
            SELECT lang, a, w, m, unnest(range(1, len(w) - m + 2)) AS i
            FROM (SELECT lang, a, string_split(phrase, ' ') AS w FROM f WHERE m > 2), (SELECT unnest([2, 3]) AS m) WHERE len(w) > m
        ) GROUP BY ALL
    )
    SELECT lang, rank, phrase, a, l, r, n, score
    FROM (
        SELECT lang, phrase, a, l, r, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
        FROM weakest LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
    ) JOIN totals USING (lang) WHERE rank <= 2000
    """
)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of each language whose words stand together most."""
    return collocations.best_collocations(table(spark, sf_dir, "documents"))


_CRC = """
    xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split({key}, ''),
        lambda x: [ord(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END), 4294967295::BIGINT)
"""
_KEY = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
_TRIMMED = r"rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


@query(
    rf"""
    WITH RECURSIVE read AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC.format(key=_KEY)} % 20 AS kind
        FROM conversations
    ),
    left_over AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
        FROM read WHERE kind <> 0
    ),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
            row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
        FROM left_over
    ),
    judged AS (
        SELECT conv_id, i, turn, role, text, left(role, 1) AS r,
            lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair,
            CASE WHEN {_TRIMMED} = '' THEN 1 WHEN nth > 1 THEN 2
                WHEN right({_TRIMMED}, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
        FROM placed
    ),
    inserted AS (
        SELECT * FROM (VALUES (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
            (0, 2, 5, 'I', ['user:']), (1, 2, 5, 'I', ['user:']), (2, 3, 5, 'I', ['assistant:']), (3, 2, 5, 'I', ['user:']),
            (0, 3, 10, 'II', ['user:', 'assistant:']), (1, 3, 10, 'II', ['user:', 'assistant:'])) AS t(q, st, paid, done, lines)
    ),
    moves AS (SELECT * FROM (VALUES (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) AS t(st, r, then_st)),
    edits AS (
        SELECT st, st AS then_st, 'D' AS edit, CAST(NULL AS VARCHAR) AS r, CAST(NULL AS VARCHAR) AS name FROM moves
        UNION ALL SELECT st, then_st, 'K', r, NULL FROM moves
        UNION ALL SELECT 0, 1, 'K', 's', NULL
        UNION ALL SELECT st, then_st, 'R', NULL, CASE r WHEN 'u' THEN 'user' ELSE 'assistant' END FROM moves
    ),
    best AS (
        SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS q, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM conversations
        UNION ALL
        SELECT conv_id, i, q, CAST(left(min(rank), 12) AS INT), substr(min(rank), 13), arg_min(lines, rank)
        FROM (
            SELECT b.conv_id, j.i, e.then_st AS q,
                lpad(CAST(b.cost + n.paid + CASE e.edit WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
                    + CASE WHEN j.fault = 3 AND e.edit <> 'D' THEN 5 ELSE 0 END AS VARCHAR), 12, '0') || b.audit || n.done || e.edit AS rank,
                b.lines || n.lines || CASE WHEN e.edit = 'D' THEN [] ELSE [coalesce(e.name, j.role) || ':' || j.text] END AS lines
            FROM best b JOIN judged j ON b.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = b.i + 1
                JOIN inserted n ON n.q = b.q
                JOIN edits e ON e.st = n.st AND (e.edit = 'D' OR j.fault NOT IN (1, 2)) AND (e.r IS NULL OR e.r = j.r)
        )
        GROUP BY conv_id, i, q
    ),
    facts AS (
        SELECT conv_id, count(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
            count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN judged USING (conv_id) GROUP BY conv_id
    ),
    ended AS (
        SELECT b.conv_id, min(lpad(CAST(b.cost + n.paid AS VARCHAR), 12, '0') || b.audit || n.done) AS rank,
            arg_min(b.lines || n.lines, lpad(CAST(b.cost + n.paid AS VARCHAR), 12, '0') || b.audit || n.done) AS lines
        FROM best b JOIN facts f ON b.conv_id IS NOT DISTINCT FROM f.conv_id AND b.i = f.n JOIN inserted n ON n.q = b.q
        WHERE n.st IN (0, 3) GROUP BY b.conv_id
    )
    SELECT f.conv_id, gaps, blank, duplicate, truncated, illegal, CAST(left(rank, 12) AS BIGINT) AS cost, substr(rank, 13) AS audit,
        sha256(array_to_string(lines, chr(10))) AS repaired_sha256
    FROM facts f JOIN ended e ON f.conv_id IS NOT DISTINCT FROM e.conv_id
    """
)
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, their faults and cheapest repairs."""
    return conversations.damaged_and_repaired(table(spark, sf_dir, "conversations"))


@query()
def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the pieces of each text, and the text decoded from them."""
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.round_trips(table(spark, sf_dir, "documents"), model)
