"""The linear quote-aware split equals the original look-ahead regex split."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trendstats.schema import QUOTE_AWARE_COMMA
from trendstats.sources.trending import java_token_count, quote_aware_split

FIXED = [
    "", ",", ",,", '"', '","', 'a,"b,c",d', 'a,"b,c,d', '"a,b",c,"d', 'x,"",y,', 'a""b,c', '",a,"b,c"',
    ',,a"', 'a,b,c,,,', '"""",",",', 'v03,"Comma, once",Chan B,"a ""quoted"" desc, with comma"',
    'has\x00mark,"a,b",c', '\x00', 'a,\x00"b,c"',
]


def compare(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    out = df.select(
        "value",
        F.split("value", QUOTE_AWARE_COMMA, -1).alias("regex"),
        quote_aware_split("value").alias("linear"),
        java_token_count(F.split("value", QUOTE_AWARE_COMMA, -1)).alias("w1"),
        java_token_count(quote_aware_split("value")).alias("w2"),
    ).collect()
    for r in out:
        assert r.regex == r.linear, r.value
        assert r.w1 == r.w2, r.value


def test_fixed_cases(spark):
    compare(spark, FIXED)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='abm,"e\x00', max_size=24), min_size=1, max_size=200))
def test_random_lines(spark, lines):
    compare(spark, lines)
