"""Rounding helpers with one spelling for Spark and one for DuckDB SQL text.

Floating sums depend on summation order, so results compared across engines are rounded first.
``bround`` (Spark) and ``round_even`` (DuckDB) are both half-to-even, like ``np.around``.
``sig`` rounds to significant digits for quantities whose scale is not known in advance: the value is
scaled to ``digits`` whole digits, rounded to three decimals and then to none (so summation noise can't
decide a tie), and scaled back. Only powers of ten that a double holds exactly are used, by multiplying
or dividing, so both engines get the same bits; no more than 22 decimals are kept.
Adding ``0.0`` at the end turns a possible ``-0.0`` into ``0.0``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: 10^0 .. 10^22, the exact ones.
EXACT_POWERS = 22


def rnd(c: Column | str, digits: int = 6) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.bround(col.cast("double"), digits) + F.lit(0.0)


def _power(k: Column) -> Column:
    """10^k for k in 0 .. 22; 1 below, 10^22 above."""
    powers = F.array(*[F.lit(10.0**i) for i in range(EXACT_POWERS + 1)])
    return F.element_at(powers, F.least(F.greatest(k, F.lit(0)), F.lit(EXACT_POWERS)).cast("int") + 1)


def sig(c: Column | str, digits: int = 9) -> Column:
    col = (F.col(c) if isinstance(c, str) else c).cast("double")
    k = F.lit(digits - 1) - F.floor(F.log10(F.abs(col))).cast("int")
    up, down = _power(k), _power(-k)
    return F.when(col == 0, F.lit(0.0)).otherwise(F.bround(F.bround(col * up / down, 3), 0) / up * down + F.lit(0.0))


def rnd_sql(expr: str, digits: int = 6) -> str:
    return f"(round_even(CAST({expr} AS DOUBLE), {digits}) + 0.0)"


def sig_sql(expr: str, digits: int = 9) -> str:
    e = f"CAST({expr} AS DOUBLE)"
    k = f"({digits - 1} - CAST(floor(log10(abs({e}))) AS INTEGER))"
    powers = "[" + ", ".join(f"1e{i}" for i in range(EXACT_POWERS + 1)) + "]"
    p = lambda x: f"{powers}[least(greatest({x}, 0), {EXACT_POWERS}) + 1]"
    up, down = p(k), p(f"-{k}")
    return f"(CASE WHEN {e} = 0 THEN 0.0 ELSE round_even(round_even({e} * {up} / {down}, 3), 0) / {up} * {down} + 0.0 END)"
