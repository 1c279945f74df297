from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from exportlens import functions as X


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


@pytest.mark.parametrize("num, den, up, even", [
    ("1.005", 1, "1.01", "1.00"), ("1.015", 1, "1.02", "1.02"), ("-1.005", 1, "-1.01", "-1.00"),
    ("2.000", 3, "0.67", "0.67"), ("-2.000", 3, "-0.67", "-0.67"), ("0.000", 7, "0.00", "0.00"),
    ("0.010", 8, "0.00", "0.00"), ("0.030", 4, "0.01", "0.01"), ("0.010", 2, "0.01", "0.00"),
    ("0.030", 2, "0.02", "0.02"), ("-0.030", 2, "-0.02", "-0.02"), ("5.000", -8, "-0.63", "-0.62"),
])
def test_round_ratio_and_mean(spark, num, den, up, even):
    n, d = F.lit(D(num)), F.lit(den)
    got = one(spark, X.round_ratio(n, d, 2, scale=3), X.round_ratio(n, d, 2, scale=3, even=True),
              X.round_mean(n, d, 2, scale=3), X.round_mean(n, d, 2, scale=3, even=True))
    assert got == (D(up), D(even), D(up), D(even))


def test_zero_denominator_is_null(spark):
    assert one(spark, X.round_ratio(F.lit(D("1.00")), F.lit(0), 2), X.round_mean(F.lit(D("1.00")), F.lit(0), 2),
               X.safe_div(F.lit(D("1.00")), F.lit(0)), X.rate_pct(F.lit(1), F.lit(0)),
               X.pct(F.lit(D("1.00")), F.lit(D("0.00")))) == (None,) * 5


def test_large_sums_keep_their_fraction(spark):
    """A sum of fifteen digits still divides to the exact cent."""
    small = D("123456789012345.67")
    assert one(spark, X.round_ratio(F.lit(small), F.lit(7), 2), X.round_mean(F.lit(small), F.lit(7), 2)) == (
        D("17636684144620.81"), D("17636684144620.81"))


def test_aggregates(spark):
    df = spark.createDataFrame([("a", 10, "1.00"), ("b", 0, "2.00"), ("a", 5, "4.00"), (None, None, None)],
                               "k string, n int, x string").withColumn("x", F.col("x").cast("decimal(14,2)"))
    row = df.agg(
        X.mean("x", 2).alias("mean"), X.mean("n", 1, scale=0).alias("mean_n"), X.mean_double("x").alias("md"),
        X.count_when(F.col("k") == "a").alias("a"), X.sum_when(F.col("k") == "a", "x").alias("sa"),
        X.avg_when(F.col("k") == "c", "n", 1).alias("none"), X.money_sum("x").alias("s"),
        X.avg_ratio(F.col("x"), F.col("n").cast("decimal(10,0)"), 4, scale=13).alias("ratio"),
        X.ratio_of_sums("x", "n", 3).alias("of_sums"),
    ).first()
    assert row.asDict() == {"mean": D("2.33"), "mean_n": D("5.0"), "md": 7 / 3, "a": 2, "sa": D("5.00"), "none": None,
                            "s": D("7.00"), "ratio": D("0.4500"), "of_sums": D("0.467")}


def test_bins_are_right_closed(spark):
    edges = [D("0"), D("6.5"), D("7.5"), D("8.5"), D("10")]
    got = [one(spark, X.bin_right(F.lit(D(v)), edges, list("abcd")))[0]
           for v in ("0", "0.01", "6.5", "6.51", "7.5", "8.5", "10", "10.01")]
    assert got == [None, "a", "a", "b", "b", "c", "d", None]
    with pytest.raises(ValueError):
        X.bin_right("x", edges, ["one"])


def test_band_and_tag(spark):
    null = F.lit(None).cast("int")
    assert one(spark, X.band([(null > 1, "x")], "else"), X.band([(F.lit(2) > 1, "x"), (F.lit(2) > 0, "y")], "z")) == ("else", "x")
    assert one(spark, X.tag_contains(F.lit("⭐ Star Export"), "Star"), X.tag_contains(F.lit(None).cast("string"), "Star")) == (True, False)


def test_text_and_units(spark):
    assert one(spark, X.padded_id("P", F.lit(7), 3), X.padded_id("P", F.lit(12345), 3), X.short_text(F.lit("abcdef"), 4),
               X.days_since(F.lit("2024-12-01").cast("date"), "2024-12-31"),
               X.scale_units(F.lit(D("15250000.00")), "crore"), X.scale_units(F.lit(D("2687320.32")), "million"),
               X.clamp(F.lit(120), 0, 92), X.clamp(F.lit(None).cast("int"), 0, 92)) == (
        "P007", "P12345", "abcd", 30, D("1.53"), D("2.69"), 92, None)


def test_ordered_join(spark):
    df = spark.createDataFrame([(2, "b"), (1, "z"), (3, "a")], "o int, v string")
    assert df.agg(X.ordered_join("v", "o")).first()[0] == "z, b, a"
