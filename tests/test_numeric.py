from pyspark.sql import functions as F

from larder.functions.numeric import band, clip, half_even, half_up, ratio, steady_sum, sum_skipping_nulls
from larder.functions.text import capitalise, percent, whole


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_two_rounding_families(spark):
    assert one(spark, half_up(F.lit(0.125), 2)) == 0.13
    assert one(spark, half_even(F.lit(0.125), 2)) == 0.12
    assert one(spark, half_up(F.lit(-2.5), 0)) == -3.0
    assert one(spark, half_even(F.lit(2.5), 0)) == 2.0


def test_values_just_below_a_tie_round_down(spark):
    assert one(spark, half_up(F.lit(0.4999996), 0)) == 0.0
    assert one(spark, half_up(F.lit(2.4999999), 0)) == 2.0


def test_ratio_is_null_on_zero_denominator(spark):
    assert one(spark, ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, ratio(F.lit(1.0), F.lit(4))) == 0.25


def test_clip_keeps_null(spark):
    assert one(spark, clip(F.lit(1.5), 0, 1)) == 1.0
    assert one(spark, clip(F.lit(None).cast("double"), 0, 1)) is None


def test_band_edges_are_exclusive(spark):
    edges = [(2, "a"), (5, "b")]
    labels = [one(spark, band(F.lit(v), edges, "c")) for v in (1.9, 2.0, 5.0)]
    assert labels == ["a", "b", "c"]


def test_row_sum_skips_nulls(frame):
    df = frame([(1.0, None), (None, None)], "a double, b double")
    assert [r.s for r in df.select(sum_skipping_nulls(["a", "b"]).alias("s")).collect()] == [1.0, 0.0]


def test_steady_sum_ignores_order(spark, frame):
    values = [(0.1,), (0.2,), (0.3,), (1e6,), (-1e6,)]
    forward = frame(values, "v double").coalesce(1).agg(steady_sum(F.col("v")).alias("s")).first().s
    backward = frame(values[::-1], "v double").repartition(3).agg(steady_sum(F.col("v")).alias("s")).first().s
    assert forward == backward == 0.6


def test_texts(spark):
    assert one(spark, whole(F.lit(0.5))) == "0"
    assert one(spark, whole(F.lit(1.5))) == "2"
    assert one(spark, percent(F.lit(0.6))) == "60%"
    assert one(spark, percent(F.lit(None).cast("double"))) == "nan%"
    assert one(spark, capitalise(F.lit("replenish_now"))) == "Replenish_now"
