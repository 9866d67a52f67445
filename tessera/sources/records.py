"""Positional text records -> typed rows, as one Spark job.

A layout is a list of fields ``(name, start, end, kind)`` over the comma-separated values of a
line: scalars take one position, arrays a slice.  Parsing is pure Column work (``split``,
``slice``, ``try_cast``, ``try_to_timestamp``), so it runs next to the scan.  Lines with the wrong
field count or an unparsable value go to a side table with the reason instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    name: str
    start: int
    end: int  # exclusive
    kind: str  # 'string', 'long', 'double', 'timestamp', 'array<double>'


def click_layout() -> list[Field]:
    # The click record layout (318 comma-separated fields).
    #   0 time, 1 species, 2 site, 3 rec_no, 4 bout_i, 5 peak2peak,
    #   6-207 MSN (202 values), 208-308 MSP (101 values),
    #   309-317 flags TPWS1, MD1, FD1, TPWS2, MD2, FD2, TPWS3, MD3, FD3
    fields = [
        Field("time", 0, 1, "timestamp"),
        Field("species", 1, 2, "string"),
        Field("site", 2, 3, "string"),
        Field("rec_no", 3, 4, "string"),
        Field("bout_i", 4, 5, "long"),
        Field("peak2peak", 5, 6, "double"),
        Field("MSN", 6, 208, "array<double>"),
        Field("MSP", 208, 309, "array<double>"),
    ]
    flags = ["TPWS1", "MD1", "FD1", "TPWS2", "MD2", "FD2", "TPWS3", "MD3", "FD3"]
    fields += [Field(f, 309 + i, 310 + i, "long") for i, f in enumerate(flags)]
    return fields


TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _parse(part: Column, kind: str) -> Column:
    if kind == "string":
        return part
    if kind == "timestamp":
        return F.try_to_timestamp(part, F.lit(TIMESTAMP_FORMAT))
    return part.try_cast(kind)


def parse_records(lines: DataFrame, layout: Sequence[Field], text: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good rows, bad lines with a reason).  ``lines`` holds one string column ``text``."""
    n_fields = max(f.end for f in layout)
    parts = F.split(F.col(text), ",")
    cols = []
    checks = []
    for f in layout:
        if f.kind.startswith("array<"):
            raw = F.slice(parts, f.start + 1, f.end - f.start)
            inner = f.kind[6:-1]
            val = F.transform(raw, lambda s: F.trim(s).try_cast(inner))
            bad = F.exists(val, lambda x: x.isNull())
        else:
            raw = F.trim(F.try_element_at(parts, F.lit(f.start + 1)))
            val = _parse(raw, f.kind)
            bad = raw.isNotNull() & val.isNull()
        cols.append(val.alias(f.name))
        checks.append(F.when(bad, F.lit(f.name)))
    staged = lines.select(
        F.col(text).alias("_line"),
        F.size(parts).alias("_n"),
        F.array_compact(F.array(*checks)).alias("_bad_fields"),
        *cols,
    )
    ok = (F.col("_n") == n_fields) & (F.size("_bad_fields") == 0)
    good = staged.where(ok).drop("_line", "_n", "_bad_fields")
    reason = F.when(F.col("_n") != n_fields, F.format_string("expected %d fields, got %d", F.lit(n_fields), F.col("_n"))).otherwise(
        F.concat(F.lit("unparsable: "), F.array_join("_bad_fields", ","))
    )
    bad = staged.where(~ok).select(F.col("_line").alias("line"), reason.alias("reason"))
    return good, bad


def read_records(spark: SparkSession, path: str, layout: Sequence[Field]) -> tuple[DataFrame, DataFrame]:
    return parse_records(spark.read.text(path), layout)
