"""Column functions against the worked examples (FIXTURES part B)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import codec
from tessera.functions import vec as V


def one(spark, expr, data, schema):
    return spark.createDataFrame(data, schema).select(expr.alias("r")).first()["r"]


def test_nanmean_variants_b1(spark):
    row = [(None if math.isnan(x) else float(x)) for x in [1, float("nan"), 2, float("nan"), 3, 4, 5]]
    df = spark.createDataFrame([(row,)], "v array<double>")
    r = df.select(V.plain_mean("v").alias("m"), V.zero_filled_mean("v").alias("z"), V.nanmean("v").alias("n")).first()
    assert r["m"] is None
    assert r["z"] == pytest.approx(15 / 7)
    assert r["n"] == pytest.approx(3.0)


@pytest.mark.parametrize(
    "scores,top1,top5",
    [
        ([-0.3, 1.2, 0.3, 0.5, -0.4, 0.0, 0.01, 1.0, -1.3, 0.2, -1.2], 1, [1, 7, 3, 2, 9]),
        ([0.4, -0.5, 1.3, -0.2, 0.6, -2.2, -0.8, 1.9, 0.9, -0.2, -1.7], 7, [7, 2, 8, 4, 0]),
    ],
)
def test_topk_b2_b3(spark, scores, top1, top5):
    df = spark.createDataFrame([(scores,)], "s array<double>")
    r = df.select(V.topk_desc("s", 5).alias("t"), V.argmax("s").alias("a")).first()
    assert r["t"] == top5
    assert r["a"] == top1


def test_argmax_ties_lowest(spark):
    assert one(spark, V.argmax("s"), [([1.0, 3.0, 3.0],)], "s array<double>") == 1
    assert one(spark, V.topk_desc("s", 3), [([2.0, 5.0, 5.0],)], "s array<double>") == [1, 2, 0]


def test_f16_bytes_b8(spark):
    b = bytes([0x00, 0x7E, 0x00, 0x00, 0x28, 0x5B, 0x60, 0x56])
    df = spark.createDataFrame([(b,)], "b binary")
    r = df.select(codec.decode_f16("b").alias("c"), codec.decode_packed("b", "<f2").alias("a")).first()
    assert r["c"] == [None, 0.0, 229.0, 102.0]
    assert r["a"] == [None, 0.0, 229.0, 102.0]


def test_f16_special_values_match_numpy(spark):
    vals = np.array([0.0, -0.0, 1.0, -2.5, 65504.0, 6e-8, 1e-5, np.inf, -np.inf, np.nan], dtype=np.float16)
    df = spark.createDataFrame([(vals.tobytes(),)], "b binary")
    got = df.select(codec.decode_f16("b").alias("c")).first()["c"]
    want = [None if np.isnan(x) else float(x) for x in vals.astype(np.float64)]
    assert got == want
    assert math.copysign(1.0, got[1]) == -1.0


def test_f8_roundtrip(spark):
    df = spark.createDataFrame([([1.5, None, -3.25],)], "v array<double>")
    r = df.select(codec.decode_packed(codec.encode_packed("v", "<f8"), "<f8").alias("r")).first()["r"]
    assert r == [1.5, None, -3.25]


def test_vote_share_and_simplex_b6(spark):
    df = spark.createDataFrame([([6.0, 1.0, 3.0],)], "v array<double>")
    r = df.select(V.normalize_sum("v").alias("p")).select("p", V.simplex_xy("p").alias("xy")).first()
    assert r["p"] == pytest.approx([0.6, 0.1, 0.3], abs=1e-4)
    assert r["xy"]["x"] == pytest.approx(0.25, abs=1e-4)
    assert r["xy"]["y"] == pytest.approx(0.261, abs=1e-4)


def test_vector_math(spark):
    df = spark.createDataFrame([([3.0, 4.0, None], [0.0, 0.0, 1.0])], "a array<double>, b array<double>")
    r = df.select(V.norm("a").alias("n"), V.dot("a", "b").alias("d"), V.distance("a", "b").alias("dist"),
                  V.softmax(F.array(F.lit(1.0), F.lit(2.0))).alias("sm"), V.fill_missing("a").alias("f")).first()
    assert r["n"] == pytest.approx(5.0)
    assert r["d"] == pytest.approx(0.0)
    assert r["dist"] == pytest.approx(5.0)  # missing position contributes nothing
    assert sum(r["sm"]) == pytest.approx(1.0)
    assert r["f"] == [3.0, 4.0, 0.0]


def test_vec_std_peak(spark):
    x = [1.0, 2.0, 4.0, 7.0]
    df = spark.createDataFrame([(x,)], "v array<double>")
    r = df.select(V.vec_std("v").alias("s"), V.peak_to_peak("v").alias("p")).first()
    assert r["s"] == pytest.approx(np.std(x))
    assert r["p"] == 6.0


def test_sig_is_the_same_in_both_engines(spark):
    """10,000 values from 1e-9 to 1e9, ties and powers of ten among them."""
    import random

    import duckdb
    import pandas as pd

    from tessera.functions.rounding import sig, sig_sql

    rng = random.Random(3)
    values = [rng.choice([-1, 1]) * 10 ** rng.uniform(-9, 9) for _ in range(8000)]
    values += [round(rng.uniform(0, 1000), rng.randint(0, 10)) for _ in range(2000)]
    values += [-5.036730512e-05, -5.03673049e-05, 0.0, 1217.571375, 999999999.5, *(10.0**k for k in range(-12, 16))]
    rows = pd.DataFrame({"i": range(len(values)), "v": values})
    got = {r.i: (r.a, r.b) for r in spark.createDataFrame(rows).select("i", sig("v", 9).alias("a"), sig("v", 5).alias("b")).collect()}
    want = {i: (a, b) for i, a, b in duckdb.sql(f"SELECT i, {sig_sql('v', 9)}, {sig_sql('v', 5)} FROM rows").fetchall()}
    assert got == want
    assert all(abs(got[i][0] - v) <= 0.6e-8 * abs(v) for i, v in enumerate(values))
