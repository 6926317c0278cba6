"""P10: malformed numbers fail the job whatever the session's ANSI setting."""

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from pomelo.functions import text as T
from pomelo.operators import tokens as TK


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


def _one(spark, feature):
    return spark.createDataFrame([("e", feature)], "entity_id string, feature string")


@pytest.mark.parametrize("bad", ["1:x", "x:1", "1:", "1.5:1", "9999999999:1"])
def test_malformed_numbers_fail(spark, ansi, bad):
    df = _one(spark, f"0:1 {bad}")
    if bad == "1:":                                  # no value: not a pair, dropped (F4)
        assert TK.parse_feature_long(df).count() == 1
        return
    for rows in (TK.parse_feature_long(df), df.select(TK.index_values())):
        with pytest.raises(SparkRuntimeException, match="not a "):
            rows.collect()


def test_behaviour_values(spark, ansi):
    with pytest.raises(SparkRuntimeException, match="not a double: 'many'"):
        TK.explode_behavior(_one(spark, "a:1 b:many")).collect()
    got = TK.explode_behavior(_one(spark, "a:1 b:many c: 2.5"), strict=False).collect()
    assert {(r.item_code, r.value) for r in got} == {("a", 1.0), ("b", None)}


def test_sound_numbers_and_null_pass(spark, ansi):
    df = spark.createDataFrame([("1",), ("-2.5e3",), (None,)], "v string")
    assert [r.v for r in df.select(T.strict_double(F.col("v")).alias("v")).collect()] == [1.0, -2500.0, None]
    assert spark.range(1).select(T.strict_int(F.lit("7")).alias("i")).collect()[0].i == 7
