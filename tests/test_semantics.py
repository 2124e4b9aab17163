"""Missing-value, ordering and rounding rules (N1–N15) on hand-typed frames."""

from pyspark.sql import functions as F

from riffle.functions import semantics as N
from riffle.functions.text import bin_label, grouped_code, number_word, number_words, WATERSHED_CODE_WIDTHS
from riffle.operators import dedupe, joins


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_null_keys_match_in_joins(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "k int, a string")
    b = spark.createDataFrame([(1, "p"), (None, "q")], "k2 int, b string")
    out = joins.join_na(a, b, "k", "left", "k2")
    assert sorted(rows(out, "a", "b")) == [("x", "p"), ("y", "q")]


def test_negated_regex_keeps_missing_text(spark):
    df = spark.createDataFrame([("phase1",), ("phase2",), (None,)], "s string")
    kept = df.filter(N.rlike_na("s", "PHASE2", ci=True, negate=True))
    assert sorted(rows(kept, "s"), key=str) == [("phase1",), (None,)]


def test_paste0_prints_na(spark):
    df = spark.createDataFrame([("8530", None)], "a string, b string")
    assert df.select(N.paste0("a", F.lit("_"), "b")).first()[0] == "8530_NA"
    assert df.select(N.str_c("a", "b")).first()[0] is None


def test_strict_min_is_missing_when_any_missing(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 3.0)], "g string, v double")
    out = dict(rows(df.groupBy("g").agg(N.strict_min("v").alias("m")), "g", "m"))
    assert out == {"a": None, "b": 2.0}


def test_keep_first_order_survives_clock_changes_and_nan(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Vancouver")
    try:
        df = spark.sql("""SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2022-03-13 02:30:00', double('NaN')),
                          (2, TIMESTAMP_NTZ'2022-03-13 03:10:00', 5D), (3, NULL, NULL) AS t(id, ts, v)
                       """).selectExpr("'k' AS key", "*")
        first = lambda *order: dedupe.keep_first(df, ["key"], [*order, "id"]).first().id
        assert (first("ts desc"), first("ts"), first("ts nulls last")) == (2, 3, 1)
        assert (first("v desc"), first("v nulls last"), first("v desc nulls first")) == (1, 2, 3)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_keep_first_respects_order_and_direction(spark):
    df = spark.createDataFrame(
        [("k", 1, "2024-01-01 10:00:00", "b"), ("k", 2, "2024-01-02 10:00:00", "a"),
         ("j", 3, None, "z"), ("j", 4, "2024-01-01 00:00:00", "y")],
        "key string, id int, ts string, s string").withColumn("ts", F.to_timestamp_ntz("ts"))
    latest = dict(rows(dedupe.keep_first(df, ["key"], ["ts desc", "id"]), "key", "id"))
    assert latest == {"k": 2, "j": 4}          # desc puts NULL last
    earliest = dict(rows(dedupe.keep_first(df, ["key"], ["ts", "id"]), "key", "id"))
    assert earliest == {"k": 1, "j": 3}        # asc puts NULL first
    by_text_desc = dict(rows(dedupe.keep_first(df, ["key"], ["s desc"]), "key", "id"))
    assert by_text_desc == {"k": 1, "j": 3}    # window fallback for text desc


def test_part_gives_null_when_piece_missing(spark):
    df = spark.createDataFrame([("198220_us_ef1",), ("8530_ds",), ("8530",)], "a string")
    got = rows(df.select(N.part("a", 1), N.part("a", 2), N.part("a", 3)), "*")
    assert got == [("198220", "us", "ef1"), ("8530", "ds", None), ("8530", None, None)]


def test_cast_and_divide_give_null(spark):
    df = spark.createDataFrame([("12", 0.0), ("x1", 2.0)], "t string, d double")
    got = rows(df.select(N.cast_na("t", "int"), N.safe_div(F.lit(1.0), "d")), "*")
    assert got == [(12, None), (None, 0.5)]


def test_rounding_rules(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (0.125,), (2.675,), (17.25,), (12345.0,)], "x double")
    got = rows(df.select(N.round_even("x", 0), N.round_half_up("x", 2), N.round_multiple("x", 0.5),
                         F.round("x", -3)), "*")
    assert got[0][0] == 2.0 and got[1][0] == -2.0           # half to even
    assert got[3][1] == 2.68                                  # exact decimal half-up
    assert got[4][2] == 17.0                                  # 17.25 -> 34.5 -> 34 (even) -> 17.0
    assert got[5][3] == 12000.0


def test_bins_closed_on_the_right(spark):
    df = spark.createDataFrame([(65.0,), (65.5,), (110.0,), (140.0,), (141.0,), (None,)], "x double")
    got = [r[0] for r in df.select(bin_label("x", [65, 110, 140], ["fry", "parr", "juvenile", "adult"])).collect()]
    assert got == ["fry", "parr", "parr", "juvenile", "adult", None]


def test_number_words():
    w = number_words(100)
    assert w[0] == "zero" and w[21] == "twenty one" and w[100] == "one hundred"
    o = number_words(30, ordinal=True)
    assert o[1] == "first" and o[3] == "third" and o[20] == "twentieth" and o[22] == "twenty second"


def test_number_word_column(spark):
    df = spark.createDataFrame([(5,), (250,), (1000,), (-21,), (1234567,), (None,), (10 ** 18,)], "n long")
    got = [tuple(r) for r in df.select(number_word("n"), number_word("n", ordinal=True)).collect()]
    assert [g[0] for g in got] == ["five", "two hundred fifty", "one thousand", "minus twenty one",
                                   "one million two hundred thirty four thousand five hundred sixty seven", None,
                                   "one quintillion"]
    assert got[1][1] == "two hundred fiftieth" and got[3][1] == "minus twenty first"
    n = spark.range(2100).select(number_word("id").alias("w"), number_word("id", ordinal=True).alias("o")).collect()
    assert [r.w for r in n] == number_words(2099) and [r.o for r in n] == number_words(2099, ordinal=True)


def test_grouped_code(spark):
    code = "400" + "431358" + "0" * 36
    df = spark.createDataFrame([(code,)], "c string")
    got = df.select(grouped_code("c", WATERSHED_CODE_WIDTHS)).first()[0]
    assert got == "400-431358-00000-00000-0000-0000-000-000-000-000-000-000"
