import datetime

from pyspark.sql import functions as F

from tidewatch.functions import arrays, dates, keys, text


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_month_names_and_quarters(spark):
    rows = spark.createDataFrame([("April", 2020), ("december", 2020), ("December", 2021)], "m string, y int")
    got = rows.select(dates.month_number("m"), dates.quarter_number(dates.month_number("m")), dates.month_date("m", "y"))
    assert [tuple(r) for r in got.collect()] == [
        (4, 2, datetime.date(2020, 4, 1)),
        (None, None, None),
        (12, 4, datetime.date(2021, 12, 1)),
    ]


def test_shift_key_rolls_over(spark):
    assert one(
        spark,
        dates.shift_key(F.lit("2020-11"), 2),
        dates.shift_key(F.lit("2020-12"), 2),
        dates.shift_key(F.lit("202001"), -2, "yyyyMM"),
        dates.shift_key(F.lit("nonsense"), 1),
    ) == ("2021-01", "2021-02", "201911", None)


def test_parse_bad_stamps_give_null(spark):
    assert one(spark, dates.parse_stamp(F.lit(20200101010203)), dates.parse_stamp(F.lit("2020")), dates.parse_iso(F.lit("x"))) == (
        datetime.datetime(2020, 1, 1, 1, 2, 3),
        None,
        None,
    )


def test_quarter_hours_exclude_the_end(spark):
    start, end = (F.lit(t).cast("timestamp") for t in ("2020-01-01 00:00:00", "2020-01-01 01:00:00"))
    whole, part, none = one(
        spark,
        F.size(dates.quarter_hours(start, end)),
        F.size(dates.quarter_hours(start, end + F.expr("interval 1 minute"))),
        F.size(dates.quarter_hours(end, start)),
    )
    assert (whole, part, none) == (4, 5, 0)


def test_month_range(spark):
    months = one(spark, dates.month_range(F.lit("2020-11-17").cast("date"), F.lit("2021-01-02").cast("date")))[0]
    assert months == [datetime.date(2020, 11, 1), datetime.date(2020, 12, 1), datetime.date(2021, 1, 1)]


LOCATIONS = (
    "2#Iowa, United States#US#USIA##42.0046#-93.214#IA#6714;1#Taiwan#TW#TW##24#121#TW#5774;"
    "1#Türkiye#TU#TU##39#35#TU#1;1#United States#US#US##39#-98#US#2;1#Taiwan#TW#TW##24#121#TW#5874"
)


def test_country_codes(spark):
    golden, default, anyname = one(
        spark,
        text.country_codes(F.lit("1#Taiwan#TW#TW##24#121#TW#5874;")),
        text.country_codes(F.lit(LOCATIONS)),
        text.country_codes(F.lit(LOCATIONS), names="any"),
    )
    assert golden == ["TW"]
    assert default == ["TW", "TU", "TW"]
    assert anyname == ["TW", "TU", "US", "TW"]


def test_feed_names(spark):
    url = F.lit("http://feed.example/v2/20200101001500.gkg.csv.zip")
    part = F.lit("file:/x/feed=20200201000000/part-0001-abc.txt")
    assert one(spark, text.feed_stamp(url), text.feed_kind(url), text.feed_stamp(part), text.feed_stamp(F.lit("a.csv"))) == (
        "20200101001500",
        "gkg",
        "20200201000000",
        None,
    )


def test_undecodable_bytes_are_dropped(spark):
    broken = F.unhex(F.lit("41ff42")).cast("string")
    assert one(spark, text.without_undecodable(broken), text.without_undecodable(F.lit("né�"))) == ("AB", "né�")


def test_first_distinct_and_item(spark):
    values = F.array(*[F.lit(x) for x in ["b", "a", "b", "c"]])
    assert one(spark, arrays.first_distinct(values, 2), arrays.item(values, 3), arrays.item(values, 4)) == (
        ["b", "a"],
        "c",
        None,
    )


def test_matrix_functions(spark):
    flat = F.array(*[F.lit(float(x)) for x in range(6)])
    rows = arrays.reshape(flat, 3, 2)
    assert one(spark, rows, F.flatten(rows), arrays.reshape(flat, 0, 2)) == (
        [[0.0, 1.0], [2.0, 3.0], [4.0, 5.0]],
        [0.0, 1.0, 2.0, 3.0, 4.0, 5.0],
        [],
    )
    padded, kept = one(spark, arrays.pad_rows(rows, 4, 2), arrays.pad_rows(rows, 2, 2))
    assert padded[3] == [0.0, 0.0] and len(padded) == 4 and len(kept) == 3


def test_argmax_prefers_the_first_on_a_tie(spark):
    half = F.array(F.lit(0.5), F.lit(0.5))
    up = F.array(F.lit(0.2), F.lit(0.8))
    assert one(spark, arrays.argmax(half), arrays.argmax(arrays.mean_vectors(half, up))) == (0, 1)


def test_widen_narrow_round_trip(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [4.0])], "id int, v array<double>")
    wide = arrays.widen(df, "v", 3)
    assert wide.columns == ["id", "v-0", "v-1", "v-2"]
    assert wide.where("id = 2").first()["v-1"] is None
    assert arrays.narrow(wide, arrays.columns_like(wide, "v"), "v").where("id = 1").first()["v"] == [1.0, 2.0, 3.0]


def test_chosen_share_is_stable(spark):
    ids = spark.range(20000)
    kept = ids.where(keys.chosen(keys.hash_key(4, "id"), 0.15))
    again = ids.repartition(7).where(keys.chosen(keys.hash_key(4, "id"), 0.15))
    assert 0.13 < kept.count() / 20000 < 0.17
    assert kept.exceptAll(again).count() == 0
    assert ids.where(keys.chosen(keys.hash_key(4, "id"), 1.0)).count() == 20000
    assert ids.where(keys.chosen(keys.hash_key(4, "id"), 0.0)).count() == 0
