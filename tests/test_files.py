import bz2
import datetime
import gzip
import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewatch import plans, sinks, sources
from tidewatch.functions.keys import schema_key
from tidewatch.schemas import ARTICLE_COLUMNS, CODE_OVERRIDES

LOCATION = "1#Taiwan#TW#TW##24#121#TW#5774;1#Kenya#KE#KE##1#38#KE#1"


def article_line(record, url, stamp, locations=LOCATION, fields=27):
    values = {"GKGRECORDID": record, "DATE": stamp, "DocumentIdentifier": url, "V2Locations": locations}
    line = [values.get(c, "") for c in ARTICLE_COLUMNS]
    return "\t".join((line + ["extra"] * 3)[:fields])


def embedding(url, stamp, value=0.5, title="t"):
    date = datetime.datetime.strptime(stamp, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    return {"date": date, "lang": "ENGLISH", "title": title, "model": "m", "url": url, "docembed": [value, 1.0]}


def test_articles_with_every_kind_of_bad_line(spark, tmp_path):
    stamp = "20200101000000"
    lines = [
        article_line("r1", "u1", stamp),
        article_line("r2", "u2", stamp, fields=28),
        article_line("r3", "u3", stamp, fields=5),
        article_line('r"4', "u4", "not a number") + "\r",
    ]
    body = "\n".join(lines).encode() + b"\n" + article_line("r5", "u\xff5", stamp).encode("latin-1") + b"\n"
    (tmp_path / f"{stamp}.gkg.csv").write_bytes(body)
    read = sources.read_articles(spark, str(tmp_path), keep_all=True)
    got = {r["GKGRECORDID"]: r for r in read.collect()}
    assert set(got) == {"r1", "r3", 'r"4', "r5"}
    assert got["r1"]["DATE"] == 20200101000000 and got['r"4']["DATE"] is None
    assert got["r3"]["V2Locations"] is None and got["r3"]["DocumentIdentifier"] == "u3"
    assert got["r5"]["DocumentIdentifier"] == "u5"
    assert {r["granule"] for r in got.values()} == {stamp}
    kept = sources.read_articles(spark, str(tmp_path))
    assert "DATE" not in kept.columns and "V2Locations" in kept.columns
    assert read.columns == [*ARTICLE_COLUMNS, "granule"]


def test_embeddings_in_every_layout(spark, tmp_path):
    stamps = ["20200101000000", "20200101001500", "20200101003000", "20200101004500", "20200101010000"]
    dump = [json.dumps(embedding(f"u{i}", s, title="a } { b}{c")) for i, s in enumerate(stamps)]
    texts = [
        dump[0] + "\n" + dump[1] + "\n\n",
        dump[2] + " " + dump[3],
        json.dumps(embedding("u4", stamps[4]), indent=1) + json.dumps(embedding("u5", stamps[4])),
        "",
    ]
    for stamp, body in zip(stamps, texts):
        with gzip.open(tmp_path / f"{stamp}.docembed.json.gz", "wt") as f:
            f.write(body)
    auto = sources.read_article_embeddings(spark, str(tmp_path))
    granules, counts = sources.landed(
        sources.read_granules(spark, str(tmp_path), datetime.date(2020, 1, 1), datetime.date(2020, 1, 2), per_task=12), f"{tmp_path.name}"
    )
    assert {r["granule"]: (r["found"], r["read"]) for r in counts.collect() if r["found"]} == dict(zip(stamps, [(True, 2), (True, 2), (True, 2), (True, 0)]))
    for read in (auto, sources.typed_embeddings(granules)):
        rows = {r["url"]: r for r in read.collect()}
        assert set(rows) == {f"u{i}" for i in range(6)}
        assert rows["u3"]["date"] == datetime.datetime(2020, 1, 1, 0, 45)
        assert rows["u3"]["granule"] == stamps[1] and rows["u0"]["title"] == "a } { b}{c"
        assert rows["u5"]["docembed"] == [0.5, 1.0] and "model" not in read.columns
    assert "model" in sources.read_article_embeddings(spark, str(tmp_path), keep_all=True).columns
    with pytest.raises(ValueError):
        sources.read_article_embeddings(spark, str(tmp_path), layout="other")


def test_truncated_granule_is_tolerated_and_reported(spark, tmp_path):
    whole = gzip.compress(json.dumps(embedding("u1", "20200101000000")).encode())
    (tmp_path / "20200101000000.json.gz").write_bytes(whole)
    noise = os.urandom(4000).hex()
    cut = gzip.compress(json.dumps(embedding("u2", "20200101001500", title=noise)).encode())
    (tmp_path / "20200101001500.json.gz").write_bytes(cut[: len(cut) // 2])
    read = sources.read_article_embeddings(spark, str(tmp_path), layout="lines")
    assert [r["url"] for r in read.collect()] == ["u1"]
    expected = spark.createDataFrame([("20200101000000",), ("20200101001500",)], "granule string")
    assert [r[0] for r in sources.missing_granules(expected, read).collect()] == ["20200101001500"]


def write_day(folder, day, urls):
    (folder / "a").mkdir(exist_ok=True)
    (folder / "e").mkdir(exist_ok=True)
    for quarter, url in enumerate(urls):
        stamp = f"{day}{quarter // 4:02d}{quarter % 4 * 15:02d}00"
        lines = [article_line(f"{stamp}-{url}", url, stamp), article_line(f"{stamp}-copy", url, stamp)]
        (folder / "a" / f"{stamp}.gkg.csv").write_text("\n".join(lines) + "\n")
        with gzip.open(folder / "e" / f"{stamp}.docembed.json.gz", "wt") as f:
            f.write(json.dumps(embedding(url, stamp)) + "\n" + json.dumps(embedding(url, stamp, 0.7)) + "\n")


def ingest(spark, folder, start, days, **options):
    start = datetime.date.fromisoformat(start)
    options.setdefault("per_task", 24)
    return plans.ingest_days(
        spark, f"{folder}/a", f"{folder}/e", f"{folder}/out", start, start + datetime.timedelta(days=days), **options
    )


def test_ingest_rewrites_its_days_only(spark, tmp_path):
    write_day(tmp_path, "20200101", ["u1", "u2", "u1"])
    write_day(tmp_path, "20200102", ["u1", "u3"])
    assert ingest(spark, tmp_path, "2020-01-01", 2, p=1.0, report=f"{tmp_path}/report") == 4
    counts = spark.read.json(f"{tmp_path}/report").where("found").groupBy("feed").agg(F.sum("read"), F.sum("rejected")).collect()
    assert sorted(map(tuple, counts)) == [("articles", 10, 0), ("embeddings", 10, 0)]
    once = {(str(r["day"]), r["DocumentIdentifier"], r["country-1"], r["country-2"]) for r in sinks.read_published(spark, f"{tmp_path}/out").collect()}
    assert once == {
        ("2020-01-01", "u1", "TW", "KE"),
        ("2020-01-01", "u2", "TW", "KE"),
        ("2020-01-02", "u1", "TW", "KE"),
        ("2020-01-02", "u3", "TW", "KE"),
    }
    assert ingest(spark, tmp_path, "2020-01-02", 1, p=1.0) == 2
    assert sinks.read_published(spark, f"{tmp_path}/out").count() == 4
    with pytest.raises(ValueError, match="expected rows"):
        ingest(spark, tmp_path, "2021-01-01", 1, p=1.0, require_rows=True)
    assert ingest(spark, tmp_path, "2021-01-01", 1, p=1.0) == 0
    # A day whose files are gone is empty after the next run.
    for f in list((tmp_path / "a").glob("20200102*")):
        f.unlink()
    assert ingest(spark, tmp_path, "2020-01-01", 2) == 2
    assert {r["day"] for r in sinks.read_published(spark, f"{tmp_path}/out").collect()} == {"2020-01-01"}


def test_ingest_samples_both_feeds_alike(spark, tmp_path):
    write_day(tmp_path, "20200101", [f"u{i}" for i in range(96)])
    rows = ingest(spark, tmp_path, "2020-01-01", 1, p=0.3)
    out = sinks.read_published(spark, f"{tmp_path}/out")
    assert 10 < rows < 50 and out.where("gkg_file != gsg_file").count() == 0


def test_partitioned_write_sizes_and_timestamps(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "2020 AS year", "id % 2 AS month", "timestamp_micros(id) AS ts")
    sinks.write_table(df, f"{tmp_path}/t", ["year", "month"])
    files = [os.path.join(d, f) for d, _, names in os.walk(tmp_path / "t") for f in names if f.endswith(".parquet")]
    assert len(files) == 2 and all("snappy" in f for f in files)
    assert "millis" in str(pq.ParquetFile(files[0]).schema).lower()
    assert sources.read_table(spark, f"{tmp_path}/t", ["id"], year=2020, month=1).count() == 500
    plan = sources.read_table(spark, f"{tmp_path}/t", ["id"], "id > 5", month=1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "GreaterThan(id,5)" in plan and "ReadSchema: struct<id:bigint>" in plan


def test_files_hold_at_most_the_rows_asked_for(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id % 3 AS part")
    sinks.write_table(df, f"{tmp_path}/t", ["part"], rows_per_file=15)
    files = [os.path.join(d, f) for d, _, names in os.walk(tmp_path / "t") for f in names if f.endswith(".parquet")]
    assert sorted(pq.ParquetFile(f).metadata.num_rows for f in files) == [3, 3, 4] + [15] * 6


def test_append_and_overwrite(spark, tmp_path):
    one, two = (spark.range(10).withColumn("day", F.lit(d)) for d in ("d1", "d2"))
    sinks.write_table(one, f"{tmp_path}/t", ["day"])
    sinks.append_table(two, f"{tmp_path}/t", ["day"])
    for _ in range(2):
        sinks.overwrite_partitions(two.where("id < 3"), f"{tmp_path}/t", ["day"])
    counts = {r["day"]: r["count"] for r in spark.read.parquet(f"{tmp_path}/t").groupBy("day").count().collect()}
    assert counts == {"d1": 10, "d2": 3}
    sinks.write_table(one, f"{tmp_path}/t", ["day"])
    assert spark.read.parquet(f"{tmp_path}/t").count() == 10


def test_samples_are_sharded_and_read_as_matrices(spark, tmp_path):
    df = spark.range(25).selectExpr("id", "array(1F, 2F, 3F, 4F) AS embeddings", "2L AS height", "2L AS width", "id % 2 AS label")
    sinks.write_samples(df.coalesce(1), f"{tmp_path}/s", 10)
    assert len([f for f in os.listdir(tmp_path / "s") if f.endswith(".parquet")]) == 3
    row = sources.read_samples(spark, f"{tmp_path}/s").first()
    assert row["matrix"] == [[1.0, 2.0], [3.0, 4.0]]


def test_country_codes_with_overrides(spark, tmp_path):
    (tmp_path / "codes.csv").write_text(
        "Country,Fips_10,iso_alpha2,iso_alpha3\nMonaco,XX,MC,MCO\nKenya,KE,KE,KEN\n"
    )
    got = {r["Country"]: r["Fips_10"] for r in sources.country_codes(spark, f"{tmp_path}/codes.csv").collect()}
    assert got == {"Kenya": "KE", **CODE_OVERRIDES}


def test_conflict_counts(spark, tmp_path):
    (tmp_path / "c.csv").write_text("Country,Month,Year,Fatalities\nKenya,April,2020,3\nKenya,Dec,2020,1\n")
    got = {r["Month"]: r for r in sources.read_conflict(spark, f"{tmp_path}/c.csv").collect()}
    assert (got["April"]["month_num"], got["April"]["quarter"], got["April"]["date"]) == (4, 2, datetime.date(2020, 4, 1))
    assert got["Dec"]["date"] is None


def test_stack_resumes_where_it_stopped(spark, tmp_path):
    rows = [("2020-01-05", "AA", "BB", None), ("2020-02-05", "AA", None, None)]
    df = spark.createDataFrame(rows, "d string, `country-1` string, `country-2` string, `country-3` string")
    df = df.withColumn("date", F.to_timestamp("d"))
    first = plans.stack_months(df.where("d < '2020-02'"), f"{tmp_path}/s")
    assert {tuple(r) for r in first.collect()} == {("202001_AA", "202001", "AA", 1), ("202001_BB", "202001", "BB", 1)}
    second = plans.stack_months(df, f"{tmp_path}/s", done=first)
    assert {tuple(r) for r in second.collect()} == {("202002_AA", "202002", "AA", 1)}
    assert sources.read_country_months(spark, f"{tmp_path}/s", "AA", ["202001", "202002"]).count() == 2


def test_training_samples_job(spark, tmp_path):
    articles = spark.range(12).selectExpr(
        "concat('u', id) AS url", "'AA' AS country", "TIMESTAMP '2020-01-10 00:00:00' AS date", "array(1F, 2F) AS docembed"
    )
    labels = spark.createDataFrame(
        [("AA", datetime.date(2020, 3, 1), True), ("BB", datetime.date(2020, 3, 1), False)],
        "country string, month date, trend_increasing boolean",
    )
    failures = plans.training_samples(articles, labels, f"{tmp_path}/x", n=5, width=2)
    assert [r["message"] for r in failures.collect()] == ["no sample for BB_2020-03-01"]
    manifest = spark.read.json(f"{tmp_path}/x/manifest").first()
    assert (manifest["label_column"], manifest["count"], manifest["lag_months"]) == ("trend_increasing", 2, "2")


def test_schema_key(spark):
    import hashlib

    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert df.select(schema_key(df)).first()[0] == hashlib.md5(b"ab").hexdigest()[:6]


def test_granule_report_and_spoiled_objects(spark, tmp_path):
    good = [json.dumps(embedding(f"u{i}", "20200101000000")) for i in range(50)]
    spoiled = [*good[:1], good[1][:30] + " oops}", *good[2:]]
    (tmp_path / "e").mkdir()
    (tmp_path / "e/20200101000000.json.gz").write_bytes(gzip.compress("".join(spoiled).encode()))
    (tmp_path / "e/20200101001500.json.gz").write_bytes(gzip.compress("\n".join(good).encode()))
    noise = [json.dumps(embedding(f"v{i}", "20200101003000", title="".join(chr(97 + (i * 31 + k * k) % 26) for k in range(99)))) for i in range(400)]
    cut = gzip.compress("\n".join(noise).encode())
    (tmp_path / "e/20200101003000.json.gz").write_bytes(cut[: len(cut) // 2])
    read = sources.read_article_embeddings(spark, f"{tmp_path}/e", layout="auto")
    assert read.where("granule = '20200101000000'").count() == 49
    report = {r["granule"]: r for r in sources.granule_report(spark, f"{tmp_path}/e").collect()}
    assert tuple(report["20200101000000"])[1:] == (49, 1, True) and tuple(report["20200101001500"])[1:] == (50, 0, True)
    assert not report["20200101003000"]["complete"] and 0 < report["20200101003000"]["read"] < 400
    (tmp_path / "a").mkdir()
    (tmp_path / "a/20200101000000.gkg.csv").write_text("a\tb\n" + "\t" * 40 + "\nc\n")
    lines = sources.granule_report(spark, f"{tmp_path}/a", feed="articles").first()
    assert tuple(lines)[1:] == (2, 1, True)


def test_cut_off_granules_give_what_the_report_counts(spark, tmp_path):
    letters = lambda i: "".join(chr(97 + (i * 31 + k * k) % 26) for k in range(99))
    records = [json.dumps(embedding(f"u{i}", "20200101000000", title=letters(i))) for i in range(2000)]
    joined, lined = (gzip.compress(sep.join(records).encode()) for sep in ("", "\n"))
    broken = bytearray(joined)
    broken[len(broken) * 2 // 3] ^= 255
    bodies = {"00": joined[: len(joined) // 2], "15": lined[: len(lined) // 2], "30": joined, "45": bytes(broken)}
    for minute, body in bodies.items():
        (tmp_path / f"2020010100{minute}00.json.gz").write_bytes(body)
    (tmp_path / "20200101010000.json").write_text("".join(records[:7]) + "[1, 2]")
    (tmp_path / "20200101011500.json.bz2").write_bytes(bz2.compress(" ".join(records[:5]).encode()))
    report = {r["granule"]: r["read"] for r in sources.granule_report(spark, f"{tmp_path}/*[z0].*[gn]*").collect()}
    report["20200101011500"] = 5  # the report inflates gzip only
    for layout in ("auto",):
        rows = sources.read_article_embeddings(spark, str(tmp_path), layout=layout)
        assert {r["granule"]: r["count"] for r in rows.groupBy("granule").count().collect()} == report
        assert rows.where("url = 'u3'").count() == 6
        with pytest.raises(Exception, match="ends early|CRC|stream"):
            sources.read_article_embeddings(spark, str(tmp_path), layout=layout, tolerant=False).collect()
    assert all(report[f"2020010100{minute}00"] > 400 for minute in bodies) and report["20200101003000"] == 2000


def test_versions_are_published_as_a_whole(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "n int, day string")
    sinks.publish_partitions(rows, path, "day")
    # A run that breaks between writing and publishing is not seen, and can be run again.
    version = sinks.write_version(rows.where("n = 1").withColumn("n", F.lit(10)), path, "day")
    assert {tuple(r) for r in sinks.read_published(spark, path).collect()} == {(1, "a"), (2, "b"), (3, "c")}
    sinks.publish_version(rows, path, "day", version, ["a", "b"])
    assert {tuple(r) for r in sinks.read_published(spark, path).collect()} == {(10, "a"), (3, "c")}
    assert {tuple(r) for r in sinks.read_published(spark, path, ["c", "b"]).collect()} == {(3, "c")}
    # An empty run empties its days; the table keeps its columns.
    sinks.publish_partitions(rows.where("n > 9"), path, "day", ["a", "c"], mark="empty")
    empty = sinks.read_published(spark, path)
    assert empty.count() == 0 and empty.columns == ["n", "day"] and sinks.published(spark, path).mark == "empty"
    for n in range(5):
        sinks.publish_partitions(rows.withColumn("n", F.lit(n)), path, "day")
    kept = [f for f in os.listdir(f"{path}/published") if f.endswith(".json")]
    assert len(kept) == 2 and len(os.listdir(f"{path}/data")) <= 3 + 1
    assert {tuple(r) for r in sinks.read_published(spark, path).collect()} == {(4, "a"), (4, "b"), (4, "c")}


def test_two_runs_cannot_take_one_number(spark, tmp_path):
    from tidewatch.session import FileSystem

    files = FileSystem(spark, str(tmp_path))
    files.create(f"{tmp_path}/x/1.json", "a")
    with pytest.raises(FileExistsError):
        files.create(f"{tmp_path}/x/1.json", "b")
    assert files.read(f"{tmp_path}/x/1.json") == "a" and [f for f in os.listdir(tmp_path / "x") if "tmp" in f and not f.startswith(".")] == []


def test_granule_filters_cut_the_tasks(spark, tmp_path):
    for stamp in ("20200101000000", "20200101001500", "20200102000000"):
        (tmp_path / f"{stamp}.docembed.json").write_text(json.dumps(embedding("u", stamp)))
    read = sources.read_granules(spark, str(tmp_path), datetime.date(2020, 1, 1), datetime.date(2020, 1, 3))
    assert read.rdd.getNumPartitions() == 192
    some = read.where("granule >= '20200101001500' and granule < '20200101003000'")
    assert some.rdd.getNumPartitions() == 1 and [r["kind"] for r in some.collect()] == ["row", "count"]
    one = read.where(F.col("granule").isin("20200102000000", "20200102001500"))
    assert one.rdd.getNumPartitions() == 2 and one.where("kind = 'row'").count() == 1
    wide = sources.read_granules(spark, f"file:{tmp_path}", datetime.date(2020, 1, 1), datetime.date(2020, 1, 3), per_task=50)
    assert wide.rdd.getNumPartitions() == 4 and wide.where("kind = 'row'").count() == 3
    for bad in ({"every": "1 year"}, {"feed": "other"}):
        with pytest.raises(Exception, match="must be"):
            sources.read_granules(spark, str(tmp_path), datetime.date(2020, 1, 1), datetime.date(2020, 1, 3), **bad).collect()


def test_article_granules_equal_the_line_reader(spark, tmp_path):
    stamp = "20200101000000"
    lines = [
        article_line("r1", "u1", stamp), article_line("r2", "u2", stamp, fields=28), article_line("r3", "u3", stamp, fields=5),
        article_line('r"4', "u4", "not a number") + "\r", "x",
    ]
    body = "\n".join(lines).encode() + b"\n" + article_line("r5", "u\xff5", stamp).encode("latin-1") + b"\n"
    (tmp_path / f"{stamp}.gkg.csv.gz").write_bytes(gzip.compress(body))
    made, counts = sources.landed(
        sources.read_granules(spark, str(tmp_path), datetime.date(2020, 1, 1), datetime.date(2020, 1, 2), "articles", per_task=24), "articles"
    )
    for keep_all in (False, True):
        own, other = sources.typed_articles(made, keep_all), sources.read_articles(spark, str(tmp_path), keep_all)
        assert own.columns == other.columns and own.dtypes == other.dtypes
        assert sorted(map(str, own.collect())) == sorted(map(str, other.collect()))
    assert [tuple(r)[1:] for r in counts.where("found").collect()] == [(True, 5, 1, True)]
