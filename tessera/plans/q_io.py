"""Source / sink queries: positional record parsing, parquet round trip, and A29."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import vec as V
from ..functions.rounding import sig
from ..operators import stats
from ..session import ensure_checkpoint_dir
from ..sources import io, records
from . import standins as S
from .registry import register
from .sqltext import EVENT_SERIES, SERIES, sig_sql

EVENT_LAYOUT = [
    records.Field("event_id", 0, 1, "long"),
    records.Field("ts", 1, 2, "timestamp"),
    records.Field("user_id", 2, 3, "long"),
    records.Field("event_type", 3, 4, "string"),
    records.Field("value", 4, 5, "double"),
]


@register("parse_records", "SELECT event_id, ts, user_id, event_type, value FROM events")
def parse_records(spark, sf):
    """Every events row written as a comma line, then parsed back by position (good rows)."""
    e = S.table(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value")
    lines = e.select(
        F.concat_ws(
            ",", F.col("event_id").cast("string"), F.date_format("ts", records.TIMESTAMP_FORMAT), F.col("user_id").cast("string"),
            "event_type", F.col("value").cast("string"),
        ).alias("value")
    )
    good, _ = records.parse_records(lines, EVENT_LAYOUT)
    return good.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value")


@register(
    "parse_records_rejects",
    "SELECT CAST(count(*) AS BIGINT) AS n_bad FROM events WHERE event_type = 'error'",
)
def parse_records_rejects(spark, sf):
    """S4 side table: lines whose value field is corrupted (for 'error' events) are reported, not fatal."""
    e = S.table(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value")
    v = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    lines = e.select(F.concat_ws(",", F.col("event_id").cast("string"), F.date_format("ts", records.TIMESTAMP_FORMAT),
                                 F.col("user_id").cast("string"), "event_type", v).alias("value"))
    _, bad = records.parse_records(lines, EVENT_LAYOUT)
    return bad.agg(F.count(F.lit(1)).alias("n_bad"))


@register(
    "sink_roundtrip",
    f"WITH {SERIES} SELECT station, yr, CAST(count(v) AS INTEGER) AS n_defined FROM series WHERE yr >= 1998 GROUP BY 1, 2",
)
def sink_roundtrip(spark, sf):
    """Write the series partitioned by year into the shared checkpoint folder, read back with
    a partition filter (pruned to the matching folders)."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/series-{uuid.uuid4().hex}"
    io.write_table(S.nation_year_series(spark, sf), path, ["yr"])
    back = spark.read.parquet(path).where(F.col("yr") >= 1998)
    return back.select("station", F.col("yr").cast("int").alias("yr"), V.n_defined("v").alias("n_defined"))


@register(
    "variance_distance",
    f"""WITH {EVENT_SERIES},
var AS (SELECT event_type, pos, sum(v * v) / count(v) - avg(v) * avg(v) AS var FROM eseries GROUP BY 1, 2)
SELECT {sig_sql('sum(abs(a.var - b.var))', 8)} AS l1
FROM var a JOIN var b ON a.pos = b.pos WHERE a.event_type = 'click' AND b.event_type = 'view'""",
)
def variance_distance(spark, sf):
    """L1 distance between two groups' per-position variance vectors."""
    ps = stats.position_stats(S.user_event_series(spark, sf), by=["event_type"])
    a = ps.where(F.col("event_type") == "click")
    b = ps.where(F.col("event_type") == "view")
    return stats.variance_distance(a, b).select(sig("l1", 8).alias("l1"))
