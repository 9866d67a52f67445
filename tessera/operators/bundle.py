"""Statistics bundle of vectors with holes, for all groups in one pass.

One Python pass folds each task's Arrow batches into a composite partial state per group:

* the upper triangle of the augmented Gram sums (see ``gram``), which holds the per-position sums and counts,
  the moments over all entries, the covariance and hence the principal components;
* how many vectors miss how many entries;
* how many entries fall into each of at most 2^20 bins of the doubles' own order (sign, exponent and the first 8
  bits of the fraction), with the least and the greatest value in each: the ranks of quantiles.

The states are added by one shuffle and checkpointed; they don't grow with the number of vectors. All parts are
finished from them. Only ``extremes`` looks at the vectors again, at the entries in the few bins that hold a
wanted rank, and settles the rank among those exactly.

Missing entries are NULL (or NaN); a group without any defined entry has counts of 0 and NULL moments.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vec import to_double_array
from ..session import cut_lineage
from . import decomp, gram
from .ordered import global_cumsum

#: Bytes of partial states a task holds before it hands them on.
MAX_STATE_BYTES = 128 << 20
_BIN_BITS = 20


def _order_bins(x):
    """The first bits of the doubles in an integer form that is ordered as they are."""
    import numpy as np

    b = (x + 0.0).view(np.int64)
    return (b ^ ((b >> 63) & np.int64((1 << 63) - 1))) >> (64 - _BIN_BITS)


class _State:
    """Partial state of one group."""

    def __init__(self, d: int):
        import numpy as np

        self.sums, self.counts = np.zeros((d + 1, d + 1)), np.zeros((d + 1, d + 1))
        self.missing = np.zeros(d + 1, np.int64)
        self.bins: dict[int, list] = {}

    def add(self, x) -> None:
        import numpy as np

        defined = ~np.isnan(x)
        full = np.hstack([np.ones((len(x), 1)), np.where(defined, x, 0.0)])
        mask = np.hstack([np.ones((len(x), 1)), defined.astype(float)])
        self.sums += full.T @ full
        self.counts += mask.T @ mask
        self.missing += np.bincount(x.shape[1] - defined.sum(axis=1), minlength=len(self.missing))
        values = np.sort(x[defined])
        if not len(values):
            return
        codes, first = np.unique(_order_bins(values), return_index=True)
        last = np.append(first[1:], len(values)) - 1
        for c, n, lo, hi in zip(codes.tolist(), (last + 1 - first).tolist(), values[first].tolist(), values[last].tolist(), strict=True):
            b = self.bins.setdefault(c, [0, lo, hi])
            b[0], b[1], b[2] = b[0] + n, min(b[1], lo), max(b[2], hi)

    def size(self) -> int:
        return 2 * self.sums.nbytes + 200 * len(self.bins)

    def rows(self) -> dict:
        import numpy as np

        i, j = np.triu_indices(len(self.sums))
        m = np.flatnonzero(self.missing)
        codes = list(self.bins)
        b = np.array([self.bins[c] for c in codes], float).reshape(-1, 3)
        pad = lambda *parts: np.concatenate([np.asarray(p, float) for p in parts])
        gone, none = np.full(len(m), np.nan), np.full(len(i), np.nan)
        return {
            "part": ["gram"] * len(i) + ["missing"] * len(m) + ["bin"] * len(codes),
            "i": np.concatenate([i, m, codes]).astype(np.int32), "j": np.concatenate([j, 0 * m, np.zeros(len(codes))]).astype(np.int32),
            "s": pad(self.sums[i, j], 0 * m, b[:, 0] * 0), "n": pad(np.rint(self.counts[i, j]), self.missing[m], b[:, 0]).astype(np.int64),
            "lo": pad(none, gone, b[:, 1]), "hi": pad(none, gone, b[:, 2]),
        }


def states(df: DataFrame, vec: str, by: Sequence[str], max_bytes: int = MAX_STATE_BYTES) -> DataFrame:
    """(by..., part, i, j, s, n, lo, hi): the summed states; see the module's head."""
    by = list(by)
    src = df.select(*by, to_double_array(vec).alias("_v")).where(F.col("_v").isNotNull())
    kinds = {"part": T.StringType(), "i": T.IntegerType(), "j": T.IntegerType(), "s": T.DoubleType(), "n": T.LongType(), "lo": T.DoubleType(), "hi": T.DoubleType()}
    schema = T.StructType([src.schema[k] for k in by] + [T.StructField(k, t) for k, t in kinds.items()])

    def fold(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held: dict = {}

        def handed_on():
            for key, state in held.items():
                rows = state.rows()
                keys = [pa.array([key[k]] * len(rows["i"]), types[k]) for k in range(len(by))]
                yield pa.RecordBatch.from_arrays([*keys, *(pa.array(rows[k], from_pandas=True) for k in kinds)], names=[*by, *kinds])

        types: list = []
        for batch in batches:
            if not batch.num_rows:
                continue
            types = [batch.schema.field(k).type for k in range(len(by))]
            lists = batch.column(len(by))
            x = lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1)
            names = list(zip(*(batch.column(k).to_pylist() for k in range(len(by))), strict=True)) if by else [()] * batch.num_rows
            codes: dict = {}
            group = np.array([codes.setdefault(k, len(codes)) for k in names])
            for key, g in codes.items():
                if key not in held:
                    held[key] = _State(x.shape[1])
                held[key].add(x[group == g])
            if sum(s.size() for s in held.values()) >= max_bytes:
                yield from handed_on()
                held = {}
        yield from handed_on()

    parts = src.mapInArrow(fold, schema)
    return parts.groupBy(*by, "part", "i", "j").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


@dataclass
class Bundle:
    """The statistics of all groups; every part is a DataFrame with the columns ``by`` first."""

    by: list[str]
    state: DataFrame
    vectors: DataFrame
    vec: str

    def _part(self, name: str) -> DataFrame:
        return self.state.where(F.col("part") == name)

    def gram(self) -> DataFrame:
        return self._part("gram").select(*self.by, "i", "j", "s", "n")

    def covariance(self) -> DataFrame:
        return gram.covariance_of(self.gram(), self.by)

    def pca(self, undefined: float | None = None) -> DataFrame:
        return decomp.pca(self.covariance(), self.by, undefined=undefined)

    def positions(self) -> DataFrame:
        """(by..., pos, E, NE, mean, var)."""
        first, own = F.col("i") == 0, F.col("i") == F.col("j")
        g = self.gram().where((F.col("j") > 0) & (first | own)).groupBy(*self.by, (F.col("j") - 1).alias("pos")).agg(
            F.max(F.when(first, F.col("s"))).alias("E"), F.max(F.when(first, F.col("n"))).alias("NE"), F.max(F.when(own, F.col("s"))).alias("_q")
        )  # one row of each kind
        n = F.col("NE").cast("double")
        mean = F.try_divide("E", n)
        return g.select(*self.by, "pos", "E", "NE", mean.alias("mean"), (F.try_divide("_q", n) - mean * mean).alias("var"))

    def overall(self) -> DataFrame:
        """(by..., n_vectors, n, mean, std) over all defined entries."""
        entry = F.when(F.col("i") == 0, F.when(F.col("j") > 0, F.col("s")))
        own = F.when((F.col("i") == F.col("j")) & (F.col("i") > 0), F.col("s"))
        g = self.gram().groupBy(*self.by).agg(
            F.max(F.when(F.col("j") == 0, F.col("n"))).alias("n_vectors"),
            F.sum(F.when((F.col("i") == 0) & (F.col("j") > 0), F.col("n"))).alias("n"), F.sum(entry).alias("_s"), F.sum(own).alias("_q"),
        )
        n = F.col("n").cast("double")
        mean = F.try_divide("_s", n)
        return g.select(*self.by, "n_vectors", "n", mean.alias("mean"), F.sqrt(F.greatest(F.try_divide("_q", n) - mean * mean, F.lit(0.0))).alias("std"))

    def missing(self) -> DataFrame:
        """(by..., n_missing, n_vectors)."""
        return self._part("missing").select(*self.by, F.col("i").alias("n_missing"), F.col("n").alias("n_vectors"))

    def extremes(self, divisors: Sequence[int] = (100, 1000)) -> DataFrame:
        """(by..., low<p>, high<p> ...): the (n div p + 1)-th least and the max(n div p, 1)-th greatest entry, exactly."""
        over = Window.partitionBy(*self.by).orderBy("i")  # at most 2^20 bins
        bins = self._part("bin").withColumn("_cum", F.sum("n").over(over)).withColumn("_n", F.sum("n").over(Window.partitionBy(*self.by)))
        ranks = [F.struct(F.lit(f"low{p}").alias("name"), (F.floor(F.col("_n") / p) + 1).alias("rank")) for p in divisors]
        ranks += [F.struct(F.lit(f"high{p}").alias("name"), (F.col("_n") - F.greatest(F.floor(F.col("_n") / p), F.lit(1)) + 1).alias("rank")) for p in divisors]
        found = bins.select(*self.by, "lo", "hi", "n", "_cum", F.explode(F.array(*ranks)).alias("w"))
        found = found.where((F.col("w.rank") <= F.col("_cum")) & (F.col("w.rank") > F.col("_cum") - F.col("n")))
        found = cut_lineage(found.select(*self.by, "lo", "hi", "w.name", (F.col("w.rank") - F.col("_cum") + F.col("n")).alias("_rank")))
        entries = self.vectors.select(*[F.col(k).alias(f"_by_{k}") for k in self.by], F.explode(to_double_array(self.vec)).alias("_x"))
        inside = F.col("_x").between(F.col("lo"), F.col("hi"))
        for k in self.by:
            inside &= F.col(f"_by_{k}").eqNullSafe(F.col(k))
        # a few bins of each group: small, and joined on the group
        seen = entries.join(found, inside).groupBy(*self.by, "name", "_rank", "_x").agg(F.count(F.lit(1)).alias("_c"))
        cum = global_cumsum(seen, [*[F.col(k) for k in self.by], F.col("name"), F.col("_x")], ["_c"])
        base = cum.groupBy(*self.by, "name").agg(F.min(F.col("_c_cum") - F.col("_c")).alias("_base"))
        same = F.col("a.name") == F.col("b.name")
        for k in self.by:
            same &= F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        upto = F.col("_c_cum") - F.col("_base")
        hit = cum.alias("a").join(base.alias("b"), same).where((F.col("_rank") <= upto) & (F.col("_rank") > upto - F.col("_c")))
        names = [f"{side}{p}" for p in divisors for side in ("low", "high")]
        return hit.groupBy(*[F.col(f"a.{k}") for k in self.by]).agg(*[F.max(F.when(F.col("a.name") == x, F.col("_x"))).alias(x) for x in names])

    def tables(self, group: str = "all") -> tuple[DataFrame, DataFrame, DataFrame]:
        """(scalars, vectors, matrices) in the layout of ``sources.io.save_stat_tables``; the group's keys joined by '/'."""
        name = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in self.by]) if self.by else F.lit(group)
        one = lambda df, cols, keys: df.select(
            name.alias("group"), *keys, F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in cols])).alias("e")
        ).select("group", "e.name", *keys, "e.value")
        scalars = one(self.overall(), ["n_vectors", "n", "mean", "std"], [])
        return scalars, one(self.positions(), ["E", "NE", "mean", "var"], ["pos"]), one(self.covariance(), ["O", "NO", "cov"], ["i", "j"])


def bundle(df: DataFrame, vec: str = "v", by: Sequence[str] = ()) -> Bundle:
    """Statistics of the vectors of ``df``, all of one length, by group; the one pass over them runs here."""
    return Bundle(list(by), cut_lineage(states(df, vec, by)), df, vec)
