"""Exact repeats by sorting a cover of sampled positions (operator 7).

A byte goes if a string of ``LENGTH`` bytes covers it that also starts earlier (in a document of
smaller id, or earlier in the same one), judged on the input. The work follows the difference-cover
scheme for suffix sorting: sort tuples at sampled positions, name them by comparing neighbours,
recurse where names leave something open, merge in the remaining positions, and read the repeats off
adjacent equal prefixes. A suffix need be known to LENGTH bytes only, so the recursion is short.

The cover. A difference cover modulo v guarantees that any two positions reach sampled ones by one
common step. Here the samples are chosen by content, which gives the same guarantee for equal
strings and only then: of all 40-byte grams in a window of 100 bytes the one with the smallest hash
(leftmost on ties) is the window's anchor, so equal windows have their anchor at the same place.
About 1 position in 28 is sampled, where a difference cover of comparable step keeps 1 in 7 and a
cover of triples 2 in 3; README has the figures that ruled those out.

0. Neighbouring windows with one anchor are a run. Runs are sorted by (name of the anchor, name of the
   run's whole stretch of bytes, document, place). Neighbours with equal names are equal stretches: all
   but the first repeat it in every window. Runs whose anchor no other stretch shares are done.
1. The others are cut into cells of 16 windows, counted from the anchor; cells are sorted by (name of
   the bytes common to all its windows, name of its whole stretch).
2. Cells that share their common bytes with a different stretch are merged window by window: sorted
   by the names of the 100 bytes themselves.

Sorting is Spark's: range partitions over (names, document, place), so a stretch that stands in a third
of all documents is spread over many tasks; each task streams through its sorted rows with a constant
state, and groups cut by a partition's border are settled from one row for each border. Names are 64-bit
polynomial hashes, two independent ones for each comparison.

Edge cases: null text is the empty text; texts under 100 bytes have no repeats; rows that repeat id
and text are one document and each gets its result; an id with several texts stands for several
documents, in the order of their digests; null ids come first; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import global_row_number
from .common import table, text_of
from .near_dups import _mix, _seeded
from .scratch import Scratch

LENGTH = 100
GRAM = 40
CELL = 16
#: Bytes of texts whose runs are found together.
BUFFER = 1 << 16
#: Rows of the first sort in a partition, about.
ROWS_PER_TASK = 1_000_000
#: Document keys that may be broadcast to pick texts (8 bytes each); above, a shuffle join.
MAX_BROADCAST_KEYS = 1_000_000
#: Odd bases of the two polynomials.
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

ROW = "a bigint, b bigint, doc bigint, at int, n int, q int"


class Names:
    """Names (64-bit hashes) of byte ranges of one text, read off prefix sums of a polynomial."""

    powers: dict = {}

    def __init__(self, text: bytes):
        import numpy as np

        data = np.frombuffer(text, np.uint8)
        self.n = len(data)
        self.sums, self.down = [], []
        for base in BASES:
            up, down = self._powers(base, self.n + 1)
            s = np.zeros(self.n + 1, np.uint64)
            np.cumsum(_BYTES(base)[data] * up[: self.n], dtype=np.uint64, out=s[1:])
            self.sums.append(s)
            self.down.append(down)

    @classmethod
    def _powers(cls, base: int, n: int):
        import numpy as np

        got = cls.powers.get(base)
        if got is None or len(got[0]) < n:
            n = max(n, 1 << 16)
            got = []
            for x in (base, pow(base, -1, 1 << 64)):
                p = np.full(n, x, np.uint64)
                p[0] = 1
                got.append(np.cumprod(p, dtype=np.uint64))
            cls.powers[base] = got
        return got

    def name(self, start, end, which: int, salt=0):
        import numpy as np

        raw = (self.sums[which][end] - self.sums[which][start]) * self.down[which][start]
        return _mix(raw ^ _mix(np.atleast_1d(np.asarray(salt, np.int64)).astype(np.uint64) + np.uint64(which + 1)))


def _BYTES(base: int):
    return _seeded(256, base & 0xFFFF)


def runs(names: Names, starts, sizes):
    """(anchor, first window, last window) of each run of windows with one anchor, in a buffer of texts
    that begin at ``starts``; windows across two texts don't count."""
    import numpy as np

    n = names.n
    if n < LENGTH:
        return (np.zeros(0, np.int64),) * 3
    grams = np.arange(n - GRAM + 1)
    h = names.name(grams, grams + GRAM, 0)
    left = np.repeat(starts + sizes, sizes) - np.arange(n)  # bytes to the end of the text
    # the smallest of each window, leftmost on ties: sliding minima of (hash, place), doubling the width
    place = np.uint64((1 << 24) - 1)
    out = []
    for first in range(0, n - LENGTH + 1, 1 << 23):  # places stay below 2^24
        last = min(n - LENGTH + 1, first + (1 << 23))
        part = h[first : last + LENGTH - GRAM]
        m = (part & ~place) | np.arange(len(part), dtype=np.uint64)
        width, wide = 1, LENGTH - GRAM + 1
        while width * 2 <= wide:
            m = np.minimum(m[:-width], m[width:])
            width *= 2
        if width < wide:
            m = np.minimum(m[: -(wide - width)], m[wide - width :])
        q = (m & place).astype(np.int64) + first
        q[left[first:last] < LENGTH] = -1
        edge = np.concatenate([[True], q[1:] != q[:-1], [True]])
        begin, end = np.flatnonzero(edge[:-1]), np.flatnonzero(edge[1:])
        on = q[begin] >= 0
        out.append((q[begin[on]], begin[on] + first, end[on] + first))
    return tuple(np.concatenate(x) for x in zip(*out))


def _batch(a, b, doc, at, n, q):
    import numpy as np
    import pyarrow as pa

    sign = lambda x: pa.array(x.view(np.int64))
    return pa.RecordBatch.from_arrays(
        [sign(a), sign(b), pa.array(doc, pa.int64()), pa.array(at, pa.int32()), pa.array(n, pa.int32()), pa.array(q, pa.int32())],
        names=["a", "b", "doc", "at", "n", "q"],
    )


def _collect(parts: list, doc_of: list):
    import numpy as np

    cols = [np.concatenate(c) for c in zip(*parts)]
    docs = np.repeat(np.array(doc_of, np.int64), [len(p[0]) for p in parts])
    return _batch(cols[0], cols[1], docs, cols[2], cols[3], cols[4])


def run_rows(docs: DataFrame) -> DataFrame:
    """Sort rows of step 0 from (doc, text)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def rows(docs, texts):
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            starts = np.cumsum(sizes) - sizes
            names = Names(b"".join(texts))
            q, first, last = runs(names, starts, sizes)
            of = np.searchsorted(starts, first, side="right") - 1
            a = names.name(q, q + GRAM, 0)
            b = names.name(first, last + LENGTH, 1, (last - first) * 128 + q - first)
            return _batch(a, b, np.array(docs, np.int64)[of], first - starts[of], last - first + 1, q - starts[of])

        for batch in batches:
            docs, texts, size = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if len(text) >= LENGTH:
                    docs.append(doc)
                    texts.append(text)
                    size += len(text)
                    if size >= BUFFER:  # short texts together: array calls cost more than their bytes
                        yield rows(docs, texts)
                        docs, texts, size = [], [], 0
            if texts:
                yield rows(docs, texts)

    return docs.select("doc", "text").mapInArrow(run, ROW)


def refined_rows(docs: DataFrame, cells: bool) -> DataFrame:
    """Sort rows of step 1 (cells) or 2 (single windows) from (doc, text, open array<struct<at,n,q>>)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            parts, owner, size = [], [], 0
            for doc, text, todo in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2)):
                fields = todo.values
                at, n, q = (fields.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
                names = Names(text)
                if cells:
                    found = []
                    for c in range(-(-(LENGTH - GRAM + 1) // CELL)):
                        low, high = q - CELL * (c + 1) + 1, q - CELL * c
                        first, last = np.maximum(at, low), np.minimum(at + n - 1, high)
                        on = first <= last
                        if on.any():
                            f, t, x = first[on], last[on], q[on]
                            core = names.name(high[on], low[on] + LENGTH, 0, c)
                            whole = names.name(f, t + LENGTH, 1, (t - f) * 128 + x - f)
                            found.append((core, whole, f, t - f + 1, x))
                    rows = tuple(np.concatenate(c) for c in zip(*found))
                else:
                    first = np.unique(np.repeat(at, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n))
                    rows = (names.name(first, first + LENGTH, 0), names.name(first, first + LENGTH, 1), first, np.ones(len(first), np.int64), first)
                parts.append(rows)
                owner.append(doc)
                size += len(rows[0])
                if size > 100_000:
                    yield _collect(parts, owner)
                    parts, owner, size = [], [], 0
            if parts:
                yield _collect(parts, owner)

    return docs.select("doc", "text", "open").mapInArrow(run, ROW)


#: What a sorted row turns out to be.
REPEAT, OPEN, EDGE = 0, 1, 2


def compare_neighbours(rows: DataFrame, partitions: int) -> DataFrame:
    """(kind, a, b, doc, at, n, q): repeats, rows left open, and the first rows of the first and last
    group of each partition. Constant state: the running group and its first row."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def out(kind, cols, rows):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), kind, np.int32)), *(pa.array(c[rows]) for c in cols)], names=["kind", "a", "b", "doc", "at", "n", "q"])

        lead = None  # columns of the first row of the running (a, b) group
        waiting = None  # the same row, while its a has only one group
        opened = False  # whether the running a has several groups, or may have
        started = False
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(k).to_numpy() for k in range(6)]
            size = batch.num_rows
            if lead is not None:
                cols = [np.concatenate([x, c]) for x, c in zip(lead, cols)]  # row 0 is the running group's first
                size += 1
            a, b, doc, at = cols[:4]
            new_a = np.concatenate([[lead is None], a[1:] != a[:-1]])
            new_b = np.concatenate([[lead is None], b[1:] != b[:-1]]) | new_a
            first = np.maximum.accumulate(np.where(new_b | (np.arange(size) == 0), np.arange(size), 0))
            same_place = (doc == doc[first]) & (at == at[first])
            yield out(REPEAT, cols, np.flatnonzero(~new_b & ~same_place))
            heads = np.flatnonzero(new_b)
            group = np.cumsum(new_a)  # 0: the a that runs on from the last batch
            several = np.bincount(group[heads], minlength=group[-1] + 1) >= 2
            if lead is not None:
                several[0] = opened or (group[heads] == 0).any()
                if waiting is not None and several[0]:
                    yield out(OPEN, waiting, np.array([0]))
                if several[0] or group[-1] > 0:
                    waiting = None
            if not started:
                yield out(EDGE, cols, np.array([0]))
                several[group[0]] = True  # its a may have begun in the partition before
                started = True
            yield out(OPEN, cols, heads[several[group[heads]]])
            opened = bool(several[group[-1]])
            final = first[-1]
            lead = [c[final : final + 1] for c in cols]
            if not opened and waiting is None:
                waiting = lead
        if lead is not None:
            yield out(EDGE, lead, np.array([0]))
            if waiting is not None:  # its a may go on in the next partition
                yield out(OPEN, waiting, np.array([0]))

    ordered = rows.repartitionByRange(partitions, "a", "b", "doc", "at").sortWithinPartitions("a", "b", "doc", "at")
    return ordered.mapInArrow(run, f"kind int, {ROW}")


def repeats_of(compared: DataFrame) -> DataFrame:
    """(doc, at, n): windows at .. at + n - 1 of doc start a repeat."""
    edges = compared.where(F.col("kind") == EDGE)
    firsts = edges.groupBy("a", "b").agg(F.min(F.struct("doc", "at")).alias("first"))
    late = edges.join(firsts, ["a", "b"]).where(F.struct("doc", "at") > F.col("first"))
    return compared.where(F.col("kind") == REPEAT).select("doc", "at", "n").union(late.select("doc", "at", "n"))


def with_texts(docs: DataFrame, todo: DataFrame, name: str) -> DataFrame:
    """(doc, text, <name>) of the documents in ``todo`` (doc, <name>)."""
    keys = todo.select(F.col("doc").alias("k"))
    few = keys.count() <= MAX_BROADCAST_KEYS
    picked = docs.join(F.broadcast(keys), F.col("doc") == F.col("k"), "left_semi") if few else docs
    return picked.join(todo.hint("shuffle_hash"), "doc").select("doc", "text", name)


def numbered(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """(doc, doc_id, text) with a key that orders the documents, and the bytes of all texts. The key is the
    id itself unless ids are null, repeated with other texts, or no integers."""
    rows = docs.select("doc_id", text_of().alias("text"))
    by_id = rows.groupBy("doc_id").agg(
        F.min(F.xxhash64("text")).alias("lo"), F.max(F.xxhash64("text")).alias("hi"), F.sum(F.octet_length("text")).alias("bytes")
    )
    facts = by_id.agg(F.sum("bytes"), F.max(F.col("doc_id").isNull() | (F.col("lo") != F.col("hi")))).first()
    plain = rows.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long") and not facts[1]
    if plain:
        return rows.select(F.col("doc_id").cast("bigint").alias("doc"), "doc_id", "text"), facts[0] or 0
    rows = rows.withColumn("digest", F.sha2("text", 256))
    keys = rows.select(F.col("doc_id").alias("k_id"), F.col("digest").alias("k_digest")).distinct()
    keys = scratch.write(global_row_number(keys, [F.col("k_id").asc_nulls_first(), F.col("k_digest")], "doc"))
    rows = rows.join(keys, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("digest") == F.col("k_digest")))
    return rows.select(F.col("doc").cast("bigint"), "doc_id", "text"), facts[0] or 0


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, removed array<struct<start,end>>, kept binary) for every row of ``docs``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    rows, total = numbered(docs, scratch)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-total // (28 * ROWS_PER_TASK)))

    found = []
    compared = scratch.write(compare_neighbours(run_rows(rows), parts))
    found.append(repeats_of(compared))
    for cells in (True, False):
        todo = compared.where(F.col("kind") == OPEN).groupBy("doc").agg(F.collect_list(F.struct("at", "n", "q")).alias("open"))
        open_rows = refined_rows(with_texts(rows, todo, "open"), cells)
        compared = scratch.write(compare_neighbours(open_rows, parts))
        found.append(repeats_of(compared))
    every = found[0].union(found[1]).union(found[2])
    spans = every.groupBy("doc").agg(F.collect_list(F.struct("at", "n")).alias("spans"))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            sizes, removed, kept = [], [], []
            for text, marks in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2)):
                sizes.append(len(text))
                if not marks.is_valid or not len(marks.values):
                    removed.append([])
                    kept.append(text)
                    continue
                at, n = (marks.values.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(2))
                depth = np.zeros(len(text) + 1, np.int64)
                np.add.at(depth, at, 1)
                np.add.at(depth, at + n - 1 + LENGTH, -1)
                gone = np.cumsum(depth)[:-1] > 0
                turn = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                removed.append([{"start": int(s), "end": int(e)} for s, e in zip(turn[::2], turn[1::2])])
                kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, span), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "removed", "kept"],
            )

    out = rows.join(spans.hint("shuffle_hash"), "doc", "left").select("doc_id", "text", "spans")
    kind = out.schema[0].dataType.simpleString()
    return out.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept binary")


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0).cast("bigint"), lambda acc, s: acc + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
