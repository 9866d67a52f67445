"""Hot keys: one value / group holding a third of all rows must not land in one task."""

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import gram, ordered


def test_hot_value_is_split_across_range_partitions(spark):
    n = 30000
    df = spark.range(n).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.rand(1)).alias("v"))
    r = ordered._ranged(df, [F.col("v"), F.col("k")], 8)
    sizes = [row["count"] for row in r.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 2.0 * n / 8  # the hot value (n/3 rows) is spread, not one partition
    rn = ordered.global_row_number(df, [F.col("v"), F.col("k")], "rn")
    got = rn.agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first()
    assert tuple(got) == (1, n, n)


def test_hot_group_covariance_matches_numpy(spark):
    rng = np.random.default_rng(9)
    X = rng.normal(size=(3000, 5))
    g = np.where(np.arange(3000) % 3 == 0, "hot", np.where(np.arange(3000) % 2 == 0, "a", "b"))
    g[: 2000] = "hot"  # two thirds in one group
    df = spark.createDataFrame([(str(gi), list(map(float, x))) for gi, x in zip(g, X)], "g string, v array<double>").repartition(8)
    c = gram.covariance(df, by=["g"]).where(F.col("g") == "hot").toPandas()
    M = np.zeros((5, 5))
    M[c["i"], c["j"]] = c["cov"]
    assert np.allclose(M, np.cov(X[g == "hot"].T, bias=True), atol=1e-10)


def test_many_gram_groups_in_one_task_are_handed_on_in_parts(spark):
    from pyspark.sql import functions as F

    from tessera.operators import gram

    rows = spark.range(20_000).select((F.col("id") % 5000).alias("g"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v")).coalesce(1)
    parts = gram.gram_partials(rows, "v", ["g"], max_bytes=200_000).cache()
    sums = parts.groupBy("g", "i", "j").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    assert parts.count() > sums.count() or parts.groupBy("g").count().count() == 5000
    got = sums.where("g = 7 and i = 0 and j = 1").first()
    assert got.n == 4 and got.s == 7 + 5007 + 10007 + 15007
