"""Series operators: long <-> dense vectors with holes, reshapes, returns and smoothing.

A *series table* holds one row per key with ``v array<double>`` of fixed length ``d``; holes are
NULL entries.  Long form is ``(key..., pos int, v double)``.

Scale notes
-----------
* ``build_series`` aggregates cells first (map-side partial aggregation absorbs hot keys), then
  gathers at most ``d`` cells per key -- the only per-key gather, and it is bounded by ``d``.
* Smoothing works inside each row's array (the reference smooths "across days" of one vector),
  so it needs no window and no shuffle.
* ``log_ratio`` pairs each row with the previous period by an equi-join on (key, period - 1)
  instead of a window partitioned by key: a hot key never lands in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vec import to_double_array


def _out_of_range(pos: str, d: int) -> Column:
    text = F.concat(F.lit("build_series: position "), F.coalesce(F.col(pos).cast("string"), F.lit("NULL")), F.lit(f" is outside 0..{d - 1}"))
    return F.raise_error(text).cast("int")


def build_series(
    cells: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    d: int,
    agg: str = "sum",
    out: str = "v",
) -> DataFrame:
    """Long cells -> one dense ``array<double>`` of length ``d`` per key; absent cells are NULL.

    Cells with the same (key, pos) are combined with ``agg`` (sum, avg, max, min, first). A cell whose
    position is NULL or outside 0 .. d-1 is an error, never dropped.
    """
    aggf = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min, "first": F.first}[agg]
    c = (
        cells.withColumn(pos, F.when(F.col(pos).between(0, d - 1), F.col(pos)).otherwise(_out_of_range(pos, d)))
        .groupBy(*keys, pos)
        .agg(aggf(F.col(value).cast("double")).alias("_v"))
    )
    vec = c.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.col(pos), F.col("_v")))).alias("_m"))
    return vec.select(
        *keys,
        F.transform(F.sequence(F.lit(0), F.lit(d - 1)), lambda p: F.col("_m")[p]).alias(out),
    )


def explode_series(df: DataFrame, vec: str = "v", keep: Sequence[str] | None = None, pos: str = "pos", out: str | None = None) -> DataFrame:
    """Vector -> entries: one row per position, holes kept as NULL values."""
    keep = list(keep) if keep is not None else [c for c in df.columns if c != vec]
    return df.select(*keep, F.posexplode(to_double_array(vec)).alias(pos, out or vec))


def pivot_wide(long: DataFrame, row: str, col: str, value: str, col_values: Sequence | None = None) -> DataFrame:
    """Pivot with one value per cell; a duplicate (row, col) raises at run time (pandas ``pivot``)."""
    cell = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("pivot: duplicate entry for one cell"))).otherwise(
        F.first(value)
    )
    g = long.groupBy(row)
    g = g.pivot(col, list(col_values)) if col_values is not None else g.pivot(col)
    return g.agg(cell)


def unpivot_wide(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "column", value: str = "value") -> DataFrame:
    """Wide -> long (``unpivot``); all value columns must share one type."""
    return df.unpivot(list(ids), list(values), name, value)


def decode_column_name(name: Column) -> tuple[Column, Column, Column]:
    """``train/AAPL_D`` -> (split, ticker, kind)."""
    pattern = r"^(train|test)/(.*)_([PD])$"
    return (
        F.regexp_extract(name, pattern, 1),
        F.regexp_extract(name, pattern, 2),
        F.regexp_extract(name, pattern, 3),
    )


def select_by_pattern(df: DataFrame, prefix_order: Sequence[str] = ("train/", "test/"), suffix: str = "_D") -> list[str]:
    """Column names ending in ``suffix``: first those starting with ``prefix_order[0]``, sorted, then the next."""
    out: list[str] = []
    for p in prefix_order:
        out.extend(sorted(c for c in df.columns if c.startswith(p) and c.endswith(suffix)))
    return out


def row_to_vector(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), out: str = "v", fill: float | None = 0.0) -> DataFrame:
    """Wide row -> ``array<double>`` in the given column order; missing -> ``fill`` (NaN -> 0 rule)."""
    items = []
    for c in cols:
        x = F.col(f"`{c}`").cast("double")
        if fill is not None:
            x = F.coalesce(F.nanvl(x, F.lit(fill)), F.lit(fill))
        items.append(x)
    return df.select(*keep, F.array(*items).alias(out))


def log_ratio(long: DataFrame, key: str, period: str, price: str, out: str = "log_ratio") -> DataFrame:
    """ln(p(t) / p(t-1)) per key over a dense integer period; NULL when the previous period is absent.

    Equi-join on (key, period-1): both sides are unique on their keys, so there is no skew.
    """
    prev = long.select(F.col(key), (F.col(period) + 1).alias(period), F.col(price).alias("_prev"))
    j = long.join(prev, [key, period], "left")
    return j.select(
        key,
        period,
        price,
        F.when((F.col("_prev") > 0) & (F.col(price) > 0), F.log(F.col(price) / F.col("_prev"))).alias(out),
    )


def window_mean(arr: Column, before: int, after: int) -> Column:
    """Centred moving average inside one array over offsets [-before, after], skipping NULLs."""
    a = to_double_array(arr)
    d = F.size(a)

    def at(i: Column) -> Column:
        lo = F.greatest(i - F.lit(before), F.lit(0))
        hi = F.least(i + F.lit(after), d - F.lit(1))
        win = F.slice(a, lo + F.lit(1), hi - lo + F.lit(1))
        defined = F.filter(win, lambda x: x.isNotNull())
        return F.try_divide(
            F.aggregate(defined, F.lit(0.0), lambda acc, x: acc + x), F.size(defined).cast("double")
        )

    return F.transform(F.sequence(F.lit(0), d - F.lit(1)), at)


def smooth_series(df: DataFrame, vec: str = "v", before: int = 10, after: int = 9, out: str = "v_s20") -> DataFrame:
    """The ``_s20`` smoothing: 20-wide centred box (10 before, 9 after), NULL-skipping.

    The reference's smoothing code is not available; this kernel is our stated choice.
    """
    return df.withColumn(out, window_mean(F.col(vec), before, after))


def multiscale_smooth(arr: Column) -> Column:
    """Multi-scale box smoothing inside one array.

    Position j >= 10 is replaced by the mean of a centred box of width b = 10**floor(log10(j)),
    covering [j - b//2, j - b//2 + b); positions below 10 keep their value.  A box that runs past
    the end of the array gives NULL (the reference trims that tail).  No shuffle: one row at a time.
    """
    a = to_double_array(arr)
    d = F.size(a)

    def at(i: Column) -> Column:
        b = F.pow(F.lit(10), F.floor(F.log10(F.greatest(i, F.lit(1))))).cast("int")
        lo = i - F.floor(b / 2).cast("int")
        win = F.slice(a, lo + F.lit(1), b)
        defined = F.filter(win, lambda x: x.isNotNull())
        mean = F.try_divide(F.aggregate(defined, F.lit(0.0), lambda acc, x: acc + x), F.size(defined).cast("double"))
        return F.when(i < 10, F.element_at(a, i + 1)).when(lo + b > d, F.lit(None).cast("double")).otherwise(mean)

    return F.transform(F.sequence(F.lit(0), d - F.lit(1)), at)
