"""Periodic run detection (operator 11): internal pattern matching over the words of each text.

A run is a maximal stretch of words with smallest period q and length >= max(6, 4q). For every k, the
words are cut into dyadic blocks of m = 2^k words. A run with m <= q < 2m holds a whole
block that occurs again q words later, so it is enough to ask, for every block, for its
occurrences that begin m to 2m - 1 words behind it:

* prefix doubling names all stretches of 2^k words and ends in the suffix array; the occurrences
  of a block are an interval of it;
* a wavelet matrix over the suffix array answers, by range successor, the first, second and last
  occurrence inside that window, for all blocks of a batch at once;
* occurrences that close together form an arithmetic progression. One or two of them are candidate
  periods themselves. Three or more mean that the block has their difference d as a period; a run with a longer
  period then shifts the end of one stretch of period d onto the next, so the distance
  between the beginnings, or the ends, of the two stretches is the candidate;
* a candidate (p, p + q) is extended both ways through the names (binary lifting), exactly; the least period
  of each stretch is kept.

Texts are dealt with whole, many short ones at a time; memory is about 8 bytes for each word and
doubling step (there are as many steps as the longest repeat of a text asks for), and bounded by ``PIECE_WORDS``
but for longer texts, which go alone.

Edge cases: null and blank texts have no words and no runs; a null id is an id of its own (and plants nothing in
the query); repeated rows are told apart by nothing and give equal rows; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blank_words, table, text_of

LEAST, EXPONENT = 6, 4
PIECE_WORDS = 200_000


class WaveletMatrix:
    """Order statistics of intervals of an integer array, for arrays of queries."""

    def __init__(self, values, bits: int):
        import numpy as np

        self.bits, self.ones, self.zeros = bits, [], []
        v = np.asarray(values)
        for b in range(bits - 1, -1, -1):
            bit = (v >> b) & 1
            ones = np.zeros(len(v) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(v) - int(ones[-1]))
            v = np.concatenate([v[bit == 0], v[bit == 1]])

    def below(self, lo, hi, x):
        """How many values of [lo, hi) are less than x."""
        import numpy as np

        lo, hi = lo.copy(), hi.copy()
        count = np.where(x >> self.bits > 0, hi - lo, 0)
        open_ = x >> self.bits == 0
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            a, b = ones[lo], ones[hi]
            up = (x >> (self.bits - 1 - level)) & 1 > 0
            count += np.where(up & open_, (hi - lo) - (b - a), 0)
            lo, hi = np.where(up, zeros + a, lo - a), np.where(up, zeros + b, hi - b)
        return count

    def smallest(self, lo, hi, rank):
        """The value of that rank (from 0) in [lo, hi)."""
        import numpy as np

        lo, hi, rank = lo.copy(), hi.copy(), rank.copy()
        out = np.zeros(len(lo), np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            a, b = ones[lo], ones[hi]
            none = (hi - lo) - (b - a)
            up = rank >= none
            rank = np.where(up, rank - none, rank)
            out = 2 * out + up
            lo, hi = np.where(up, zeros + a, lo - a), np.where(up, zeros + b, hi - b)
        return out


class Words:
    """Names of all stretches of 2^k words, and the suffix array, of several texts side by side.

    Texts stand apart: names of different texts differ, and a stretch that its text's end cuts off has a
    name of its own.
    """

    def __init__(self, ids, texts):
        """``ids``: equal for equal words of a text; ``texts``: number of each word's text, ascending."""
        import numpy as np

        n = len(ids)
        self.text = texts
        self.first = np.searchsorted(texts, texts, "left")
        self.end = np.searchsorted(texts, texts, "right")
        name, order = self._named(np.arange(n), texts.astype(np.int64) * (int(ids.max(initial=0)) + 1) + ids)
        self.names, self.sizes = [name], []
        while True:
            size = np.bincount(name, minlength=n)[name]  # a name is the place of its group in the order
            self.sizes.append(size.astype(np.int32))
            open_ = np.flatnonzero(size[order] > 1)  # places of the order not yet told apart
            if not len(open_):
                break
            step = 1 << len(self.names) - 1
            at = order[open_]
            then = np.where(at + step < self.end[at], name[np.minimum(at + step, n - 1)] + 1, 0)
            by = np.lexsort((then, name[at]))
            at, then = at[by], then[by]
            order = order.copy()
            order[open_] = at
            old = name[at]
            new = np.ones(len(at), bool)
            new[1:] = (old[1:] != old[:-1]) | (then[1:] != then[:-1])
            name = name.copy()
            name[at] = open_[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
            self.names.append(name)
        self.order = order

    @staticmethod
    def _named(at, keys):
        import numpy as np

        order = np.argsort(keys, kind="stable")
        new = np.ones(len(keys), bool)
        new[1:] = keys[order][1:] != keys[order][:-1]
        name = np.empty(len(keys), np.int32)
        name[order] = np.maximum.accumulate(np.where(new, at, 0))
        return name, order

    def forward(self, i, j):
        """Number of equal words from i and j (i < j, one text) on.

        No stretch of the last step occurs twice, so each step is met once at most."""
        import numpy as np

        i, j = i.copy(), j.copy()
        start, last, end = i.copy(), len(self.text) - 1, self.end[i]
        for k in range(len(self.names) - 1, -1, -1):
            name = self.names[k]
            go = (j < end) & (name[np.minimum(i, last)] == name[np.minimum(j, last)])
            i[go] += 1 << k
            j[go] += 1 << k
        return i - start

    def backward(self, i, j):
        """Number of equal words just before i and j (i < j, one text)."""
        i, j = i.copy(), j.copy()
        start, least = i.copy(), self.first[i]
        for k in range(len(self.names) - 1, -1, -1):
            name, m = self.names[k], 1 << k
            go = i - m >= least
            go[go] = name[i[go] - m] == name[j[go] - m]
            i[go] -= m
            j[go] -= m
        return start - i

    def candidates(self):
        """(p, x): places of equal blocks, for all periods x - p that a run can have."""
        import numpy as np

        n = len(self.text)
        longest = int((self.end - self.first).max(initial=0))
        inside = np.arange(n) - self.first
        tree = WaveletMatrix(inside[self.order], max(1, (longest - 1).bit_length()))
        out = []
        for k, (name, size) in enumerate(zip(self.names, self.sizes, strict=True)):
            m = 1 << k
            if EXPONENT * m > longest:
                break
            p = np.flatnonzero((size > 1) & (inside & m - 1 == 0))
            if m == 1:  # the window is the next word alone
                p = p[(p + 1 < self.end[p]) & (name[np.minimum(p + 1, n - 1)] == name[p])]
                out.append((p, p + 1))
                continue
            lo = name[p].astype(np.int64)
            hi = lo + size[p]
            before = tree.below(lo, hi, inside[p] + m)
            count = tree.below(lo, hi, inside[p] + 2 * m) - before
            some = np.flatnonzero(count)
            p, lo, hi, before, count = p[some], lo[some], hi[some], before[some], count[some]
            base = self.first[p]
            one = base + tree.smallest(lo, hi, before)
            last = base + tree.smallest(lo, hi, before + count - 1)
            few = count < 3
            out += [(p[few], one[few]), (p[few], last[few])]
            many = np.flatnonzero(~few)
            if len(many):
                p, one, last = p[many], one[many], last[many]
                d = base[many] + tree.smallest(lo[many], hi[many], before[many] + 1) - one
                shift = lambda a: (a - self.backward(a, a + d), a + d + self.forward(a, a + d))
                (left, right), (left2, right2) = shift(p), shift(one)
                for x in (left2 - left, right2 - right):
                    ok = (x > 0) & (p + x < self.end[p])
                    out.append((p[ok], p[ok] + x[ok]))
        return np.concatenate([a for a, _ in out] or [np.zeros(0, np.int64)]), np.concatenate([b for _, b in out] or [np.zeros(0, np.int64)])

    def runs(self):
        """(text, start, length, period) arrays of all runs, sorted by text, start, period."""
        import numpy as np

        if not len(self.text):
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        p, x = self.candidates()
        start = p - self.backward(p, x)
        q = x - p
        length = x + self.forward(p, x) - start
        ok = np.flatnonzero(length >= np.maximum(LEAST, EXPONENT * q))
        start, length, q = start[ok], length[ok], q[ok]
        by = np.lexsort((q, length, start))
        start, length, q = start[by], length[by], q[by]
        least = np.ones(len(by), bool)
        least[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
        start, length, q = start[least], length[least], q[least]
        by = np.lexsort((q, start))
        start, length, q = start[by], length[by], q[by]
        return self.text[start], start - self.first[start], length, q


def texts_runs(texts: list[bytes]):
    """(number of words, runs, collapsed text) of each text."""
    import numpy as np
    import pyarrow as pa

    split = [t.split() for t in texts]  # bytes: at the six ASCII blanks
    counts = np.array([len(w) for w in split])
    words = [w for ws in split for w in ws]
    ids = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    text, start, length, period = Words(ids, np.repeat(np.arange(len(texts)), counts)).runs()
    runs: list[list] = [[] for _ in texts]
    keep: dict[int, bytearray] = {}
    for t, s, n, q in zip(text.tolist(), start.tolist(), length.tolist(), period.tolist(), strict=True):
        runs[t].append({"start": s, "length": n, "period": q})
        kept = keep.setdefault(t, bytearray(b"\x01") * len(split[t]))
        kept[s + q : s + n] = bytes(n - q)
    collapsed = [b" ".join([w for w, k in zip(ws, keep[t], strict=True) if k] if t in keep else ws) for t, ws in enumerate(split)]
    return counts.tolist(), runs, collapsed


def grouped(texts: list[bytes], limit: int) -> Iterator[list[int]]:
    """Numbers of the texts, short ones first, in groups of about ``limit`` words (a word being 6 bytes)."""
    group, size = [], 0
    for k in sorted(range(len(texts)), key=lambda k: len(texts[k])):
        if group and size + len(texts[k]) > 6 * limit:
            yield group
            group, size = [], 0
        group.append(k)
        size += len(texts[k])
    if group:
        yield group


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = PIECE_WORDS) -> DataFrame:
    """(key, n_words, runs array<struct<start,length,period>> by start and period, collapsed) for every row; ``collapsed``
    are the words outside the repetitions (the part of a run after its first period), joined by blanks."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for group in grouped(texts, limit):
                counts, runs, collapsed = texts_runs([texts[k] for k in group])
                cols = [batch.column(0).take(pa.array(group)), pa.array(counts, pa.int64()), pa.array(runs, kind)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(collapsed, pa.binary()).cast(pa.string())], names=[key, "n_words", "runs", "collapsed"])

    src = docs.select(F.col(key), text_of(text).alias("text"))
    kinds = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return src.mapInArrow(run, f"`{key}` {src.schema[0].dataType.simpleString()}, {kinds}")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in every tenth document by the checksum of its id, the words from ``a`` on repeat with period ``p``.

    Other texts stay as they are; those with planted words are their words joined by blanks."""
    words = docs.select("doc_id", text_of().alias("text"), F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    chosen = F.col("h") % 10 == 0
    words = words.withColumn("w", F.when(chosen, blank_words(F.col("text"))).otherwise(F.array().cast("array<string>")))
    words = words.withColumn("g", F.expr("h div 10")).withColumn("n", F.size("w"))
    words = words.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    words = words.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = "transform(sequence(cast(a as int), n - 1), i -> element_at(w, cast(a + (i - a) % p as int) + 1))"
    whole = F.array_join(F.expr(f"concat(slice(w, 1, cast(a as int)), {tail})"), " ")
    return words.select("doc_id", F.when(F.col("n") > 0, whole).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_runs(planted(table(spark, sf_dir, "documents", "doc_id", "text"))))
