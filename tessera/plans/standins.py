"""Stand-in tables derived from the driver tables.

Each builder reads the parquet tables it needs with only the columns it uses (the scan shows a
pruned ``ReadSchema``) and leaves joins and aggregates to Catalyst/AQE: no forced broadcasts of
tables that grow with the data.

| builder              | plays                          | shape                                   |
| -------------------- | ------------------------------ | --------------------------------------- |
| nation_year_cells    | daily measurements (long)      | (station, yr, pos, v)                   |
| nation_year_series   | station x year vectors, holes  | (station, yr, v array<double>[12])      |
| user_event_series    | sparse measurement vectors     | (user_id, event_type, v array[31])      |
| brand_month_prices   | stock prices (long)            | (brand, period, price)                  |
| brand_sector         | ticker -> sector               | (brand, sector)                         |
| vectors              | spectra / digits / points      | (vec_id, label, x array<double>[64])    |
| station_dim          | station dimension              | (station, name, region, lat, lon, elev) |
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.series import build_series

NATION_YEAR_D = 12
USER_EVENT_D = 31


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def nation_year_cells(spark: SparkSession, sf_dir: str, since: datetime | None = None) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    if since is not None:
        o = o.where(F.col("o_orderdate") >= F.lit(since).cast(o.schema["o_orderdate"].dataType))
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.groupBy(
        F.col("c_nationkey").alias("station"),
        F.year("o_orderdate").cast("int").alias("yr"),
        (F.month("o_orderdate") - 1).cast("int").alias("pos"),
    ).agg(F.sum("o_totalprice").cast("double").alias("v"))


def nation_year_series(spark: SparkSession, sf_dir: str, since: datetime | None = None) -> DataFrame:
    return build_series(nation_year_cells(spark, sf_dir, since), ["station", "yr"], "pos", "v", NATION_YEAR_D)


def user_event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events", "user_id", "event_type", "ts", "value")
    cells = e.select("user_id", "event_type", (F.dayofmonth("ts") - 1).cast("int").alias("pos"), "value")
    return build_series(cells, ["user_id", "event_type"], "pos", "value", USER_EVENT_D)


def brand_month_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(brand, period, price): mean unit price per brand and month; period = year*12 + month-1."""
    li = table(spark, sf_dir, "lineitem", "l_partkey", "l_extendedprice", "l_quantity", "l_shipdate")
    p = table(spark, sf_dir, "part", "p_partkey", "p_brand")
    j = li.join(p, li.l_partkey == p.p_partkey)
    return j.groupBy(
        F.col("p_brand").alias("brand"),
        (F.year("l_shipdate") * 12 + F.month("l_shipdate") - 1).cast("int").alias("period"),
    ).agg(F.avg(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))).alias("price"))


def brand_sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """brand -> its most common p_type (ties: smallest name)."""
    p = table(spark, sf_dir, "part", "p_brand", "p_type")
    n = p.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(F.col("p_brand").alias("brand")).agg(
        F.min_by("p_type", F.struct((-F.col("n")).alias("a"), F.col("p_type").alias("b"))).alias("sector")
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")
    return e.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))


def station_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation as a station: name, region name, and customer-derived 'coordinates'.

    lat = mean customer balance / 100, lon = number of customers, elev = nation key * 10 - 50
    (negative for the first five, standing in for the -999.9 missing marker rule).
    """
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    c = table(spark, sf_dir, "customer", "c_nationkey", "c_acctbal")
    cs = c.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("_bal"), F.count(F.lit(1)).alias("_n"))
    j = n.join(r, n.n_regionkey == r.r_regionkey).join(cs, n.n_nationkey == cs.c_nationkey, "left")
    return j.select(
        F.col("n_nationkey").alias("station"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("region"),
        (F.col("_bal") / 100.0).alias("lat"),
        F.col("_n").cast("double").alias("lon"),
        (F.col("n_nationkey") * 10 - 50).cast("double").alias("elev"),
    )
