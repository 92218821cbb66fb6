import datetime

from pyspark.sql import functions as F

from clickweave.functions import scalars


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_packed_field(spark):
    text = F.lit("searchKeywords=|ids=1,2,3|age=30")
    assert one(spark, scalars.packed_field(text, "ids")) == "1,2,3"
    assert one(spark, scalars.packed_field(text, "searchKeywords")) is None
    assert one(spark, scalars.packed_field(text, "sex")) is None
    assert one(spark, scalars.with_packed_field(text, "age", F.lit("31"))) == "searchKeywords=|ids=1,2,3|age=31"
    assert one(spark, scalars.with_packed_field(text, "sex", F.lit("x"))) == "searchKeywords=|ids=1,2,3|age=30"


def test_trim_comma_drops_one_on_each_side(spark):
    assert one(spark, scalars.trim_comma(F.lit(",,a,b,,"))) == ",a,b,"
    assert one(spark, scalars.trim_comma(F.lit("a"))) == "a"


def test_two_digits(spark):
    assert [one(spark, scalars.two_digits(F.lit(x))) for x in ("7", "12")] == ["07", "12"]


def test_malformed_dates_and_json_give_null(spark):
    assert one(spark, scalars.parse_date_key(F.lit("2024-13"))) is None
    assert one(spark, scalars.parse_date_key(F.lit("20240229"))) == datetime.date(2024, 2, 29)
    assert one(spark, scalars.parse_minute_key(F.lit("202402291503"))) == datetime.datetime(2024, 2, 29, 15, 3)
    assert one(spark, scalars.json_field(F.lit("{bad"), "a")) is None
    assert one(spark, scalars.json_field(F.lit('{"a": {"b": 1}}'), "a")) == '{"b":1}'


def test_seconds_are_cut_off(spark):
    a, b = F.lit("2024-01-01 00:00:00.900").cast("timestamp_ntz"), F.lit("2024-01-01 00:00:02.100").cast("timestamp_ntz")
    assert one(spark, scalars.seconds_between(b, a)) == 1
    assert one(spark, scalars.seconds_between(a, b)) == -1


def test_leap_day_minus_years(spark):
    assert one(spark, F.to_date(F.lit("2024-02-29")) - F.expr("INTERVAL 5 YEAR")) == datetime.date(2019, 2, 28)


def test_unescape(spark):
    df = spark.createDataFrame([("&lt;p&gt; caf&eacute; &amp;lt;",), (None,)], "t string")
    assert [r[0] for r in df.select(scalars.unescape("t")).collect()] == ["<p> café &lt;", None]


def test_full_match_needs_the_whole_line(spark):
    from clickweave.operators.filters import full_match

    df = spark.createDataFrame([("abc",), ("abcd",), ("abc\n",)], "t string")
    assert [r[0] for r in df.select(full_match(F.col("t"), "a|abc")).collect()] == [True, False, False]


def test_entities(spark):
    from clickweave.operators.text import clean_words

    texts = ["It&#39;s caf&eacute;&nbsp;x", "&#x41;&#66;&unknown;&amp;amp;&", "&#0;&#xD800;&#99999999;", "&lt", "", None, "a;b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(scalars.unescape("t")).collect()]
    assert got == ["It's caf\u00e9\u00a0x", "AB&unknown;&amp;&", "&#0;&#xD800;&#99999999;", "&lt", "", None, "a;b"]
    words = [w for w in df.select(clean_words("t")).first()[0] if w]
    assert words == ["its", "caf", "x"]


def test_links_of_questions_are_skipped(spark):
    from clickweave.operators.text import link_index

    pages = spark.createDataFrame([(1, 'href="a&amp;b"', 1), (2, 'href="A&b" href="a&b"', 2), (3, None, 2), (4, 'href="c"', None)], "id int, body string, kind int")
    got = [tuple(r) for r in link_index(pages, "id", "body", 'href="([^"]+)"', F.col("kind") == 1).orderBy("link", "position").collect()]
    assert got == [("a&b", 1, 2), ("c", 1, 4)]
