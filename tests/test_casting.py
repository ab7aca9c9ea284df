from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.functions.casting import text_shape, try_parse, try_read

TEXTS = [
    "1", " 5 ", "+7", "-8", "\t9\n", "3.7", ".5", "5.", "1e3", "1E400", "abc", "", " ", "-", "+", "0x1p3",
    "1d", "1f", "inf", "-Infinity", "+inf", "NaN", "nan", " nan ", "true", "T", "y", " no ", "0", "maybe",
    "127", "128", "32768", "2147483648", "9223372036854775808", "99999999999999999999999999999999999999999",
    "１２", "1,000", "2020-01-01", "12-", "--1", "1 2", None, "\x001", "1\x7f", "é", "1e-400",
]


@pytest.mark.parametrize(
    "target",
    ["tinyint", "smallint", "int", "bigint", "float", "double", "decimal(5,2)", "decimal(38,18)", "boolean", "date", "timestamp", "string"],
)
def test_texts_read_as_by_a_plain_cast(spark, target):
    df = spark.createDataFrame([(t,) for t in TEXTS], "v string")
    value = F.col("v")
    rows = df.select(
        "v", try_read(value, T.StringType(), target).alias("ours"), value.try_cast(target).alias("plain")
    )
    assert rows.where(~F.col("ours").eqNullSafe(F.col("plain"))).collect() == []


@pytest.mark.parametrize("kind", ["bigint", "double", "decimal(20,3)"])
@pytest.mark.parametrize("target", ["tinyint", "smallint", "int", "bigint", "decimal(5,2)", "decimal(10,0)", "double"])
def test_numbers_read_as_by_a_plain_cast(spark, kind, target):
    values = [0, 1, -1, 127, 128, -128, -129, 999, 1000, -1000, 32767, 32768, 2147483647, 2147483648, -2147483649, 10**10, 10**10 - 1, 2**62]
    numbers = [float(v) for v in values] + [999.994, 999.995, 999.999, -999.996, 127.9, 2147483647.5]
    if kind == "double":
        numbers += [math.nan, math.inf, -math.inf, 1e300, 9.3e18]
    df = spark.createDataFrame([(v,) for v in numbers], "v double").select(F.col("v").try_cast(kind).alias("v"))
    value = F.col("v")
    rows = df.select(
        "v", try_read(value, T.DataType.fromDDL(kind), target).alias("ours"), value.try_cast(target).alias("plain")
    )
    assert rows.where(~F.col("ours").eqNullSafe(F.col("plain"))).collect() == []


@pytest.mark.parametrize(
    "pattern", ["yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd", "yyyy-MM-dd HH:mm:ss", "MMM-yy", "d.M.yyyy", "yyyy-MM-dd'T'HH:mm"]
)
def test_dates_parse_as_by_the_engine(spark, pattern):
    texts = [
        "2020-01-31", "2020-1-31", "31/01/2020", "20200131", "2020-02-30", "+12020-01-01", "12020-01-01", "-2020-01-01",
        "0020-01-01", "2020-01-31 23:59:59", "2020-01-31 24:00:00", "2020-01-31 ", " 2020-01-31", "Jan-95", "1.2.2020",
        "2020-01-31T10:20", "２０２０-01-31", "", None, "2020-01-31\n", "x",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    value = F.col("v")
    for timestamp, plain in ((True, F.try_to_timestamp(value, F.lit(pattern))), (False, F.try_to_date(value, pattern))):
        rows = df.select("v", try_parse(value, T.StringType(), pattern, timestamp).alias("ours"), plain.alias("plain"))
        assert rows.where(~F.col("ours").eqNullSafe(F.col("plain"))).collect() == []


def test_only_plain_patterns_have_a_shape():
    assert text_shape("yyyy-MM-dd") is not None
    for pattern in ("MMM-yy", "d.M.yyyy", "yyyy-MM-dd'T'HH", "yyyy-MM-dd HH:mm:ss.SSS", "yyyyy"):
        assert text_shape(pattern) is None
