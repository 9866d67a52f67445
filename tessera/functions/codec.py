"""Packed byte vectors <-> ``array<double>``.

The measurement tables pack a year of values as little-endian float16 (2 bytes each, ``00 7E`` is
NaN); click tables pack float64 spectra.  Two decoders:

* ``decode_f16`` -- pure Column expressions (hex -> bit fields -> IEEE half), JVM-side, exact
  for normal, subnormal, +-0, +-inf and NaN.  NaN becomes NULL (this library's missing marker).
* ``decode_packed`` -- Arrow-batched pandas UDF using ``np.frombuffer`` for any dtype
  (``<f2``, ``<f4``, ``<f8``, ``<i2`` ...).  The dtype is always explicit.

``encode_packed`` is the inverse (bytes export), also Arrow-batched.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _byte(h: Column, i: Column, k: int) -> Column:
    """Unsigned value of byte (2*i + k) of the packed value, read from its hex string."""
    start = i * F.lit(4) + F.lit(1 + 2 * k)
    return F.conv(F.substring(h, start, F.lit(2)), 16, 10).cast("int")


def decode_f16(packed: Column | str) -> Column:
    """Little-endian float16 bytes -> ``array<double>`` with NaN -> NULL (Column expressions only)."""
    b = F.col(packed) if isinstance(packed, str) else packed
    h = F.hex(b)
    n = F.floor(F.length(b) / 2).cast("int")

    def one(i: Column) -> Column:
        bits = _byte(h, i, 1) * F.lit(256) + _byte(h, i, 0)
        sign = F.when(F.shiftright(bits, 15) == 1, F.lit(-1.0)).otherwise(F.lit(1.0))
        expo = F.shiftright(bits, 10).bitwiseAND(F.lit(0x1F))
        mant = bits.bitwiseAND(F.lit(0x3FF)).cast("double")
        return (
            F.when(expo == 0, sign * mant * F.lit(2.0 ** -24))
            .when((expo == 31) & (mant == 0), sign * F.lit(float("inf")))
            .when(expo == 31, F.lit(None).cast("double"))
            .otherwise(sign * (F.lit(1.0) + mant / F.lit(1024.0)) * F.pow(F.lit(2.0), expo - F.lit(15)))
        )

    return F.when(b.isNull(), F.lit(None)).otherwise(
        F.transform(F.sequence(F.lit(0), n - F.lit(1)), one)
    )


def decode_packed(packed: Column | str, dtype: str) -> Column:
    """Arrow-batched decode of packed bytes for an explicit NumPy dtype; NaN -> NULL."""
    dt = np.dtype(dtype)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def _decode(s: pd.Series) -> pd.Series:
        out = []
        for v in s:
            if v is None:
                out.append(None)
                continue
            a = np.frombuffer(bytes(v), dtype=dt).astype(np.float64)
            out.append([None if np.isnan(x) else float(x) for x in a])
        return pd.Series(out)

    return _decode(F.col(packed) if isinstance(packed, str) else packed)


def encode_packed(arr: Column | str, dtype: str) -> Column:
    """``array<double>`` -> packed bytes (NULL -> NaN), Arrow-batched."""
    dt = np.dtype(dtype)

    @F.pandas_udf(T.BinaryType())
    def _encode(s: pd.Series) -> pd.Series:
        out = []
        for v in s:
            if v is None:
                out.append(None)
                continue
            a = np.array([np.nan if x is None else x for x in v], dtype=np.float64)
            out.append(a.astype(dt).tobytes())
        return pd.Series(out)

    return _encode(F.col(arr) if isinstance(arr, str) else arr)
