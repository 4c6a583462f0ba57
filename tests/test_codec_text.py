from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from recsmith.functions import codec as C, text as X
from recsmith.sources import text as TX


def test_encode_matches_python_str(spark):
    rows = [([1, 2, 3],), ([],), ([42],)]
    df = spark.createDataFrame(rows, "a array<int>")
    got = [r[0] for r in df.select(C.encode_id_list("a")).collect()]
    assert got == [str(r[0]) for r in rows]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=-2**31, max_value=2**31 - 1), max_size=30))
def test_codec_round_trip(spark, xs):
    df = spark.createDataFrame([(xs,)], "a array<int>")
    back = df.select(C.decode_id_list(C.encode_id_list("a")).alias("b")).first()["b"]
    assert back == xs


def test_decode_variants(spark):
    df = spark.createDataFrame([("[1,2]",), ("[1, 2]",), ("[]",), (" [7] ",), ("bad",)], "t string")
    got = [r[0] for r in df.select(C.decode_id_list("t")).collect()]
    assert got == [[1, 2], [1, 2], [], [7], None]


def test_parse_rating_lines(spark):
    lines = spark.createDataFrame([("1::2::5",), ("3::None::4",), ("4::5",), ("x::1::2",), ("7::8::0",)], "value string")
    got = sorted(tuple(r) for r in TX.parse_rating_lines(lines).collect())
    assert got == [(1, 2, 5), (7, 8, 0)]
    bad = TX.parse_rating_lines(lines, keep_bad=True).filter(~F.col("ok")).count()
    assert bad == 3


def test_parse_seed_lines(spark):
    lines = spark.createDataFrame([
        ("http://a/1 alice",), ("http://a/1 alice",), ("http://a/2 alice",),
        ("   http://a/3    bob   ",), ("http://a/4 Zoë",), ("",), ("   ",)], "value string")
    got = sorted(tuple(r) for r in TX.parse_seed_lines(lines).collect())
    assert got == [("http://a/1", "alice"), ("http://a/2", "alice"), ("http://a/3", "bob"), ("http://a/4", "Zoë")]


def test_scalar_extractors(spark):
    df = spark.createDataFrame([('<span class="rating4-t"></span> (123) x 950 watched',), ("none here",)], "s string")
    r = df.select(X.extract_score("s").alias("a"), X.extract_total("s").alias("b"),
                  X.extract_first_number("s").alias("c")).collect()
    assert tuple(r[0]) == (4, 123, 4) and tuple(r[1]) == (0, None, None)


def test_page_url_and_offsets(spark):
    df = spark.createDataFrame([("http://x/collect?", 3)], "b string, n int")
    r = df.select(F.explode(X.page_offsets("n")).alias("o")).collect()
    assert [x.o for x in r] == [0, 15, 30]
    r = df.select(F.explode(X.page_offsets("n", inclusive=True)).alias("o")).collect()
    assert [x.o for x in r] == [0, 15, 30, 45]
    u = df.select(X.page_url("b", F.lit(15))).first()[0]
    assert u == "http://x/collect?start=15&sort=time&ratind=all&filter=all&mode=gird"


def test_normalise_and_strip(spark):
    df = spark.createDataFrame([("First Last", "Name\n>\nhome")], "a string, b string")
    r = df.select(X.normalise_name("a"), X.strip_label("b", "\n>\nhome")).first()
    assert tuple(r) == ("First-Last", "Name")
