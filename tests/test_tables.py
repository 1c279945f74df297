from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from exportlens.sources import tables as T
from exportlens.sources.schemas import FOREIGN_KEYS, PRIMARY_KEYS, SCHEMAS
from exportlens.sources.warehouse import Warehouse

RATES = "date,currency_code,currency_pair,rate_to_inr,daily_change_pct,month,year,quarter\n"


def csv(tmp_path, text):
    path = tmp_path / "rates.csv"
    path.write_text(RATES + text)
    return str(path)


def test_schemas():
    assert len(SCHEMAS) == 9 and set(PRIMARY_KEYS) == set(SCHEMAS) and len(FOREIGN_KEYS) == 16
    assert sum(len(s.fields) for s in SCHEMAS.values()) == 24 + 22 + 17 + 8 + 31 + 30 + 14 + 14 + 17
    assert SCHEMAS["fact_export_orders"]["total_fob_value_inr"].dataType.simpleString() == "decimal(16,2)"


def test_csv_scan_uses_declared_types(spark, tmp_path):
    df = T.read_table(spark, csv(tmp_path, "2024-01-01,USD,USD/INR,83.5,0.0,1,2024,Q1\n2024-01-02,EUR,None,,0.1,1,2024,Q1\n"), "dim_forex_rates")
    first, second = df.orderBy("date").collect()
    assert first.rate_to_inr == D("83.5000") and second.rate_to_inr is None and second.currency_pair == "None"
    nulls = T.read_table(spark, csv(tmp_path, "2024-01-02,EUR,None,1.0,0.1,1,2024,Q1\n"), "dim_forex_rates", null_values="None")
    assert nulls.first().currency_pair is None


def test_malformed_csv_stops_the_load(spark, tmp_path):
    df = T.read_table(spark, csv(tmp_path, "not a date,USD,USD/INR,83.5,0.0,1,2024,Q1\n"), "dim_forex_rates")
    with pytest.raises(Exception, match="(?i)malformed"):
        df.collect()


def test_load_append_overwrite_and_counts(spark, tmp_path):
    rows = spark.range(10).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) if f.name not in ("return_id", "return_year") else
          (F.col("id") if f.name == "return_id" else (F.lit(2023) + F.col("id") % 2).cast("int")).alias(f.name)
          for f in SCHEMAS["fact_returns"].fields])
    path = str(tmp_path / "returns")
    T.load_table(rows, path, "fact_returns")
    T.load_table(rows, path, "fact_returns")
    read = T.read_table(spark, path, "fact_returns", fmt="parquet")
    assert read.count() == 20
    assert "return_year" in read.where("return_year = 2024")._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:60]
    T.load_table(rows, path, "fact_returns", mode="overwrite")
    read = T.read_table(spark, path, "fact_returns", fmt="parquet")
    assert [tuple(r) for r in T.row_counts({"fact_returns": read, "again": rows}).orderBy("table_name").collect()] == [
        ("again", 10), ("fact_returns", 10)]


def test_csv_sink_and_registry(spark, tmp_path):
    df = spark.createDataFrame([(1, "x, y")], "a int, b string")
    T.write_csv(df, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert [tuple(r) for r in back.collect()] == [("1", "x, y")]
    assert T.register_views({"t": df}, {"doubled": lambda t: t["t"].select((F.col("a") * 2).alias("a"))}) == ["vw_doubled"]
    assert T.view(spark, "doubled").first().a == 2
    assert T.register_views({"t": df}, {"doubled": lambda t: t["t"].select((F.col("a") * 3).alias("a"))})
    assert spark.sql("SELECT a FROM vw_doubled").first().a == 3


def test_warehouse_loads_once(spark):
    built = []

    class Source(dict):
        def __getitem__(self, name):
            built.append(name)
            return super().__getitem__(name)

    rates = spark.createDataFrame([], SCHEMAS["dim_forex_rates"])
    house = Warehouse(spark, Source(dim_forex_rates=rates), "x")
    assert house["dim_forex_rates"].count() == 0 and house["dim_forex_rates"].schema.fieldNames() == rates.schema.fieldNames()
    assert built == ["dim_forex_rates"] and list(house) == ["dim_forex_rates"] and len(house) == 1


def test_unwritable_folder_raises(spark, tmp_path):
    rates = spark.createDataFrame([], SCHEMAS["dim_forex_rates"])
    blocked = tmp_path / "file"
    blocked.write_text("not a folder")
    house = Warehouse(spark, {"dim_forex_rates": rates}, "x", folder=str(blocked))
    with pytest.raises(Exception, match="file"):
        house["dim_forex_rates"]
