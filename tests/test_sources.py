"""Sources, sinks, record parsing and the streaming form."""

import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import stats
from tessera.plans import standins as S
from tessera.sources import io, records
from tessera.streaming import incremental


def _line(fields):
    return ",".join(fields)


def good_fields():
    f = ["2010-04-01 12:00:00.123456", "Gervais", "DT", "r1", "7", "0.5"]
    f += [str(0.1 * i) for i in range(202)] + [str(0.01 * i) for i in range(101)] + ["1", "0", "0", "1", "0", "0", "0", "0", "1"]
    return f


def test_parse_records_c10(spark):
    g = good_fields()
    short = g[:100]
    bad_num = list(g)
    bad_num[10] = "abc"
    bad_date = list(g)
    bad_date[0] = "not-a-date"
    lines = spark.createDataFrame([(_line(x),) for x in (g, short, bad_num, bad_date)], "value string")
    good, bad = records.parse_records(lines, records.click_layout())
    rows = good.collect()
    assert len(rows) == 1 and bad.count() == 3
    r = rows[0]
    assert r["species"] == "Gervais" and r["bout_i"] == 7 and len(r["MSN"]) == 202 and len(r["MSP"]) == 101
    assert r["TPWS2"] == 1
    reasons = sorted(x["reason"] for x in bad.collect())
    assert any("expected 318 fields" in x for x in reasons)
    assert any("MSN" in x for x in reasons) and any("time" in x for x in reasons)


def test_sink_roundtrip_with_partition_pruning(spark):
    out = tempfile.mkdtemp(prefix="tessera-sink-")
    series = S.nation_year_series(spark, SF_SMALL)
    io.write_table(series, out, ["yr"])
    back = spark.read.parquet(out)
    assert back.count() == series.count()
    plan = back.where(F.col("yr") == 1997)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "1997" in plan


def test_csv_tsv_readers(spark):
    d = tempfile.mkdtemp(prefix="tessera-csv-")
    p = os.path.join(d, "prices.csv")
    with open(p, "w") as f:
        f.write("Date,train/AAA_P,train/AAA_D\n2020-01-01,1.5,0.1\n2020-01-02,1.6,\n")
    df = io.read_csv(spark, p, "Date string, `train/AAA_P` double, `train/AAA_D` double")
    assert df.count() == 2 and df.where(F.col("`train/AAA_D`").isNull()).count() == 1
    t = os.path.join(d, "tickers.tsv")
    with open(t, "w") as f:
        f.write("Ticker\tSECTOR_ID\nAAA\tIT\n")
    assert io.read_tsv(spark, t).first()["SECTOR_ID"] == "IT"


def test_stat_and_pca_bundles(spark):
    from tessera.operators import decomp, gram

    d = tempfile.mkdtemp(prefix="tessera-bundle-")
    series = S.nation_year_series(spark, SF_SMALL)
    eig = decomp.pca(gram.covariance(series))
    io.save_pca_bundle(eig, d)
    basis, ev = io.load_pca_bundle(spark, d)
    U = io.basis_matrix(basis)
    assert np.allclose(U @ U.T, np.eye(U.shape[0]), atol=1e-9)
    vec = stats.position_stats(series).select(F.lit("orders").alias("group"), F.lit("mean").alias("name"), "pos", F.col("mean").alias("value"))
    io.save_stat_tables(io.scalars_table(spark, "orders", {"n": 1.0}), vec, None, d + "/stat")
    t = io.load_stat_tables(spark, d + "/stat")
    assert t["stat_vector"].count() == 12


def test_streaming_running_sums_equal_batch(spark):
    d = tempfile.mkdtemp(prefix="tessera-stream-")
    series = S.nation_year_series(spark, SF_SMALL)
    series.write.mode("overwrite").parquet(d + "/in")
    stream = spark.readStream.schema(series.schema).parquet(d + "/in")
    q = incremental.start_position_stats(stream, "tessera_pos_sums", d + "/ckpt")
    q.processAllAvailable()
    got = incremental.finish_position_stats(spark.table("tessera_pos_sums")).toPandas().sort_values("pos")
    q.stop()
    want = stats.position_stats(series).toPandas().sort_values("pos")
    assert np.allclose(got["mean"].to_numpy(), want["mean"].to_numpy())
    assert (got["NE"].to_numpy() == want["NE"].to_numpy()).all()
