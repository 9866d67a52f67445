"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

#: Gaps between words of ASCII letters, digits and any non-ASCII characters (before or after lower-casing).
ALNUM_GAP = r"[^\p{Alnum}\x{80}-\x{10FFFF}]+"
#: The six ASCII blanks.
BLANK = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def text_of(col: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(col), F.lit(""))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def alnum_words(text: Column) -> Column:
    """Words of ASCII digits, lower-cased ASCII letters and all non-ASCII characters.

    Only A-Z is lower-cased. ``lower`` does just that for pure ASCII and is much faster than
    ``translate``, which is left with the mixed words that ``lower`` would change.
    """
    pure = lambda c: F.octet_length(c) == F.length(c)
    one = lambda w: F.when(pure(w), F.lower(w)).when(F.lower(w) == w, w).otherwise(F.translate(w, _UPPER, _LOWER))
    words = F.when(pure(text), F.split(F.lower(text), ALNUM_GAP)).otherwise(F.transform(F.split(text, ALNUM_GAP), one))
    return F.array_remove(words, "")


def blank_words(text: Column) -> Column:
    """Words between ASCII blanks."""
    return F.array_remove(F.split(text, r"\s+"), "")  # \s: just these six in Java


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of an array of (kind, start, end) structs, comma-joined in array order."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def ragged_take(values, starts, lengths):
    """Concatenate ``values[s : s + n]`` for all (s, n): one vectorised gather (NumPy)."""
    import numpy as np

    total = int(lengths.sum())
    if total == 0:
        return values[:0]
    ends = np.cumsum(lengths)
    first = np.repeat(starts - (ends - lengths), lengths)
    return values[first + np.arange(total)]
