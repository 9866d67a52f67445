"""Phrase collocation mining (operator 13): Rabin-Karp fingerprints counted level by level.

Words are hashed by prefix polynomials over the bytes of a text, n-grams by prefix polynomials over
the words' hashes, both as NumPy arrays: a fingerprint of any n-gram is one difference of two
prefix sums. For n = 1, 2, 3, 4 in turn, each task sums up its fingerprints and a shuffle adds them, each with

* a pointer to one occurrence: the number of the text segment with the smallest number among those that hold it
  (small numbers win often, so few segments are pointed to);
* the sum of a second, independent fingerprint over all occurrences.

Fingerprints of the support are marked in a bitmap of fixed size (``FILTER_BITS``), which the next level reads: an
n-gram can only be frequent if both (n-1)-grams in it are. The bitmap may let too much through, never too little, so
it saves work and decides nothing. Then the segments pointed to, and no others, meet their
fingerprints, and only there phrases become strings. Each string's second fingerprint times the count must be the
sum of them all; where it isn't, different phrases share a fingerprint, and the counts of all that do are taken again
from the texts themselves (``recounted``).

Scores are exact: products are decimals. Every task's memory is bounded by ``PIECE_BYTES`` (about 150
times that) and ``FLUSH`` fingerprints: texts are cut between words into segments, and the grams that begin before a cut
are read beyond it, so nothing is lost there. Only a single word of more than ``SEGMENT_BYTES`` stays whole.

Edge cases: null and empty texts have no words; a null lang is ``und`` (and joins a literal ``und``); repeated rows
count as often as they stand there; ties are broken by the cut, and in ranks by count and phrase; an empty table
or one without frequent phrases gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, text_of
from .scratch import Scratch

LONGEST, SUPPORT, SHARE, TOP = 4, 30, 80, 2000
#: Bits of a bitmap: 4 MB, whatever the size of the input.
FILTER_BITS = 25
PIECE_BYTES = 250_000
SEGMENT_BYTES = 64_000
FLUSH = 300_000
#: A lang's phrases are ranked in so many parts first.
RANK_PARTS = 16

#: In decimals: the product may pass 64 bits.
EXACT_SCORE = "cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"

_BETWEEN = re.compile(rb"[ \t.,;:!?\n-\r]")
_MORE_WORDS = re.compile(rb"(?:[ \t]*[^ \t.,;:!?\n-\r]+){0,%d}" % (LONGEST - 1))
#: Odd factors: (of bytes, of words) for the fingerprint and for the second one.
_BASES = ((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93), (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F))


class Segment(NamedTuple):
    """A stretch of a text. Words that begin at ``own`` or later only end grams; ``at`` is the pointer to it."""

    text: bytes
    own: int
    lang: str
    at: int


def segments(texts: list[bytes], langs: list[str], keys: list[int], limit: int = SEGMENT_BYTES) -> Iterator[Segment]:
    """The texts cut between words after about ``limit`` bytes each, numbered by the text's key and the place."""
    for text, lang, key in zip(texts, langs, keys, strict=True):
        start = 0
        while start < len(text):
            cut = len(text)
            if cut - start > limit and (m := _BETWEEN.search(text, start + limit)):
                cut = m.start()
            end = cut if cut == len(text) else _MORE_WORDS.match(text, cut).end()
            yield Segment(text[start:end], cut - start, lang, zlib.crc32(b"%d %d" % (key, start)))
            start = cut


def pieces(found: Iterator[Segment], limit: int = PIECE_BYTES) -> Iterator[list[Segment]]:
    """Lists of segments of about ``limit`` bytes."""
    out, size = [], 0
    for s in found:
        if out and size + len(s.text) > limit:
            yield out
            out, size = [], 0
        out.append(s)
        size += len(s.text)
    if out:
        yield out


def _mix(x):
    """A finaliser that spreads all bits (splitmix64)."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int):
    import numpy as np

    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


class Hasher:
    """Powers and byte values; made once per task. ``bits``: kept of a fingerprint (fewer in tests, for collisions)."""

    def __init__(self, bits: int = 64) -> None:
        import numpy as np

        self.mask = np.uint64((1 << 64) - (1 << 64 - bits))
        self.fold = np.arange(256, dtype=np.uint8)
        self.fold[65:91] += 32
        self.kind = np.zeros(256, np.uint8)
        self.kind[[32, 9]] = 1
        self.kind[[*b".,;:!?\n\x0b\x0c\r"]] = 2
        values = np.arange(1, 257, dtype=np.uint64)
        self.values = [_mix(values * np.uint64(base))[self.fold] for base, _ in _BASES]
        self.known: dict = {}

    def prefix(self, values, base: int):
        """(prefix sums of value x power, inverse powers): the hash of [a, b) is (sums[b] - sums[a]) x inverse[a]."""
        import numpy as np

        n = len(values) + 1
        if base not in self.known or len(self.known[base][0]) < n:
            self.known[base] = _powers(base, n), _powers(pow(base, -1, 1 << 64), n)
        up, down = self.known[base]
        sums = np.zeros(n, np.uint64)
        np.cumsum(values * up[: n - 1], out=sums[1:])
        return sums, down


class Grams:
    """Words, pieces and n-gram fingerprints of one list of segments."""

    def __init__(self, hasher: Hasher, found: list[Segment]):
        import numpy as np

        self.hasher, self.raw = hasher, np.frombuffer(b"\n".join([*(s.text for s in found), b""]), np.uint8)
        kind = hasher.kind[self.raw]
        word = np.zeros(len(kind) + 2, bool)
        word[1:-1] = kind == 0
        self.starts = np.flatnonzero(word[1:-1] & ~word[:-2])
        self.ends = np.flatnonzero(word[1:-1] & ~word[2:]) + 1
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.starts]
        offsets = np.cumsum([0, *(len(s.text) + 1 for s in found)])
        self.segment = np.searchsorted(offsets, self.starts, "right") - 1
        self.own = self.starts - offsets[self.segment] < np.array([s.own for s in found], np.int64)[self.segment]
        self.langs = [s.lang for s in found]
        salts = {x: lang_salt(x) for x in set(self.langs)}
        self.salt = np.array([salts[x] for x in self.langs], np.uint64)[self.segment]
        self.at = np.array([s.at for s in found], np.int64)[self.segment]
        self.sums: dict[int, tuple] = {}

    def _hashes(self, which: int, n: int):
        import numpy as np

        if which not in self.sums:
            base, word_base = _BASES[which]
            sums, down = self.hasher.prefix(self.hasher.values[which][self.raw], base)
            size = (self.ends - self.starts).astype(np.uint64)
            words = _mix((sums[self.ends] - sums[self.starts]) * down[self.starts] + size)
            self.sums[which] = self.hasher.prefix(words, word_base)
        sums, down = self.sums[which]
        count = max(0, len(self.starts) + 1 - n)
        return _mix((sums[n : n + count] - sums[:count]) * down[:count] ^ self.salt[:count] + np.uint64(n))

    def prints(self, n: int):
        """Fingerprints of the n-grams at each word but the last n - 1."""
        return self._hashes(0, n) & self.hasher.mask

    def checks(self, n: int, at):
        """32 bits of the second fingerprints of the n-grams at the words ``at``."""
        import numpy as np

        return (self._hashes(1, n)[at] >> np.uint64(32)).astype(np.int64)

    def passing(self, n: int, filters: list):
        """Whether the n-gram at each word lies in a piece, has only (n-1)-grams that pass, and passes ``filters[n - 1]`` if there."""
        import numpy as np

        count = max(0, len(self.starts) + 1 - n)
        ok = self.piece[:count] == self.piece[n - 1 : n - 1 + count]
        if n > 1:
            less = self.passing(n - 1, filters)
            ok &= less[:count] & less[1 : 1 + count]
        if n <= len(filters):
            some = np.flatnonzero(ok)
            ok[some] = marked(filters[n - 1], self.prints(n)[some] >> np.uint64(64 - FILTER_BITS))
        return ok

    def found(self, n: int, filters: list):
        """Words of this piece where an n-gram that passes begins."""
        import numpy as np

        ok = self.passing(n, filters)
        return np.flatnonzero(ok & self.own[: len(ok)])

    def text(self, at: int, n: int) -> str:
        raw = [self.hasher.fold[self.raw[self.starts[j] : self.ends[j]]].tobytes() for j in range(at, at + n)]
        return b" ".join(raw).decode("utf-8")


def marked(bits, places):
    """Which of the (unsigned) places are set."""
    import numpy as np

    return (bits[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1) > 0


def lang_salt(lang: str) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _cut(batch, sizes: tuple[int, int]) -> Iterator[list[Segment]]:
    """Lists of segments of a batch of (text, lang, key), a few rows held as Python objects at a time."""
    import pyarrow as pa

    def rows():
        for at in range(0, batch.num_rows, 100):
            part = batch.slice(at, 100)
            columns = [part.column(0).cast(pa.binary()), part.column(1), part.column(2)]
            yield from segments(*(c.to_pylist() for c in columns), sizes[0])

    return pieces(rows(), sizes[1])


def print_counts(docs: DataFrame, n: int, shared, sizes: tuple[int, int], bits: int = 64) -> DataFrame:
    """(print, n, checks, at): each n-gram's fingerprint whose parts pass the ``shared`` (broadcast) filters, how often it
    occurs, the sum of the second fingerprints and the pointer to one occurrence."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        hasher, held, size = Hasher(bits), [], 0

        def flush():
            prints, checks, at = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(prints)
            prints = prints[order]
            first = np.flatnonzero(np.diff(prints, prepend=~prints[:1]))
            counts = np.diff(first, append=len(prints))
            cols = [prints[first].view(np.int64), counts, np.add.reduceat(checks[order], first), np.minimum.reduceat(at[order], first)]
            return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["print", "n", "checks", "at"])

        for batch in batches:
            for found in _cut(batch, sizes):
                g = Grams(hasher, found)
                here = g.found(n, shared.value)
                held.append((g.prints(n)[here], g.checks(n, here), g.at[here]))
                size += len(here)
                del g  # before the next one is made
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    counts = docs.mapInArrow(run, "print bigint, n bigint, checks bigint, at bigint").groupBy("print")
    return counts.agg(F.sum("n").alias("n"), F.sum("checks").alias("checks"), F.min("at").alias("at"))


def bitmap(places: Column, df: DataFrame):
    """The set bits: at most 2^FILTER_BITS / 64 rows reach the driver."""
    import numpy as np

    words = df.select(F.shiftright(places, 6).cast("int").alias("word"), (places % 64).cast("int").alias("bit"))
    rows = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    out = np.zeros(1 << FILTER_BITS - 6, np.uint64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def print_place(name: str = "print") -> Column:
    return F.shiftrightunsigned(name, 64 - FILTER_BITS)


def pointed(docs: DataFrame, prints: DataFrame, sizes: tuple[int, int]) -> DataFrame:
    """(at, text, own, lang, prints): the segments that the fingerprints' pointers name, each with its fingerprints."""
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(F.shiftrightunsigned("at", 32 - FILTER_BITS), prints))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        kinds = {"at": pa.int64(), "text": pa.binary(), "own": pa.int64(), "lang": pa.string()}
        for batch in batches:
            for found in _cut(batch, sizes):
                named = marked(wanted.value, np.array([s.at for s in found], np.uint64) >> np.uint64(32 - FILTER_BITS))
                rows = [s._asdict() for s, ok in zip(found, named.tolist(), strict=True) if ok]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in kinds.items()], names=list(kinds))

    texts = docs.mapInArrow(run, "at bigint, text binary, own bigint, lang string")
    # a segment holds a bounded number of grams
    return texts.join(prints.groupBy("at").agg(F.collect_list("print").alias("prints")), "at")


def strings(found: DataFrame, bits: int = 64) -> DataFrame:
    """(size, print, lang, phrase, check) of the grams in ``pointed`` segments whose fingerprints are listed."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        hasher = Hasher(bits)
        kinds = {"size": pa.int32(), "print": pa.int64(), "lang": pa.string(), "phrase": pa.string(), "check": pa.int64()}
        for batch in batches:
            for k in range(batch.num_rows):
                at, text, own, lang, listed = (c[k].as_py() for c in batch.columns)
                g = Grams(hasher, [Segment(text, own, lang, at)])
                listed = np.array(listed, np.int64).view(np.uint64)
                rows = []
                for n in range(1, LONGEST + 1):
                    here = g.found(n, [])
                    prints = g.prints(n)[here]
                    here = here[np.isin(prints, listed)]
                    # a second fingerprint tells phrases of one fingerprint apart
                    both = np.stack([g.prints(n)[here].view(np.int64), g.checks(n, here)], axis=1)
                    _, first = np.unique(both, axis=0, return_index=True)
                    rows += [(n, int(p), lang, g.text(int(here[j]), n), int(c)) for j, (p, c) in zip(first, both[first], strict=True)]
                cols = list(zip(*rows, strict=True)) or [[] for _ in kinds]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds.values(), strict=True)], names=list(kinds))

    return found.select("at", "text", "own", "lang", "prints").mapInArrow(run, "size int, print bigint, lang string, phrase string, check bigint").distinct()


def recounted(docs: DataFrame, doubtful: DataFrame, sizes: tuple[int, int], bits: int = 64) -> DataFrame:
    """(lang, phrase, n) of all phrases whose fingerprints are ``doubtful`` (size, print), counted by their texts."""
    doubts = docs.sparkSession.sparkContext.broadcast(bitmap(print_place(), doubtful))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hasher = Hasher(bits)
        kinds = {"size": pa.int32(), "print": pa.int64(), "lang": pa.string(), "phrase": pa.string(), "n": pa.int64()}
        for batch in batches:
            for found in _cut(batch, sizes):
                g, counts = Grams(hasher, found), Counter()
                for n in range(1, LONGEST + 1):
                    prints = g.prints(n)
                    here = g.found(n, [])
                    here = here[marked(doubts.value, prints[here] >> (64 - FILTER_BITS))]
                    counts.update((n, p, g.langs[g.segment[j]], g.text(j, n)) for j, p in zip(here.tolist(), prints[here].view("int64").tolist(), strict=True))
                cols = list(zip(*((*k, c) for k, c in counts.items()), strict=True)) or [[] for _ in kinds]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds.values(), strict=True)], names=list(kinds))

    found = docs.mapInArrow(run, "size int, print bigint, lang string, phrase string, n bigint")
    return found.join(doubtful, ["size", "print"], "left_semi").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def phrase_counts(docs: DataFrame, scratch: Scratch, support: int = SUPPORT, sizes: tuple[int, int] = (SEGMENT_BYTES, PIECE_BYTES), bits: int = 64) -> DataFrame:
    """(lang, phrase, n): all phrases of 1 to ``LONGEST`` words of that support. ``docs`` has (text, lang, key), without nulls."""
    context = docs.sparkSession.sparkContext
    filters: list = []
    levels = []
    for n in range(1, LONGEST + 1):
        counts = print_counts(docs, n, context.broadcast(filters), sizes, bits).where(F.col("n") >= support)
        levels.append(scratch.write(counts.withColumn("size", F.lit(n))))
        filters = [*filters, bitmap(print_place(), levels[-1])]
        if not filters[-1].any():
            break
    prints = reduce(DataFrame.union, levels)
    found = scratch.write(strings(pointed(docs, prints, sizes), bits))
    agrees = F.expr("cast(n as decimal(19,0)) * cast(check as decimal(10,0)) % 4294967296 = checks % 4294967296")
    known = scratch.write(prints.join(found, ["size", "print"]).where(agrees).select("size", "print", "lang", "phrase", "n"))
    doubtful = scratch.write(prints.join(known, ["size", "print"], "left_anti").select("size", "print"))
    sure = known.select("lang", "phrase", "n")
    if doubtful.isEmpty():
        return sure
    return sure.union(recounted(docs, doubtful, sizes, bits).where(F.col("n") >= support))


def collocations(docs: DataFrame, support: int = SUPPORT, share: int = SHARE, top: int = TOP, sizes: tuple[int, int] = (SEGMENT_BYTES, PIECE_BYTES), bits: int = 64) -> DataFrame:
    """Each lang's ``top`` phrases: (lang, rank, phrase, a, l, r, n, score). A ``doc_id``, if there, keeps the pointers of copies apart."""
    key = F.xxhash64(*[c for c in ("doc_id", "text", "lang") if c in docs.columns])
    src = docs.select(text_of().alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"), key.alias("key"))
    scratch = Scratch(docs.sparkSession, "phrases")
    known = scratch.write(phrase_counts(src, scratch, support, sizes, bits))
    totals = src.groupBy("lang").agg(F.sum(F.regexp_count("text", F.lit(r"[^ \t.,;:!?\n-\r]+"))).alias("n"))
    known = known.select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    many = known.where(F.size("w") > 1)
    part = lambda name, count: known.select("lang", F.col("phrase").alias(name), F.col("a").alias(count))
    cuts = many.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("first"), F.expr("array_join(slice(w, k + 1, size(w)), ' ')").alias("rest"))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    best = cuts.withColumn("score", F.expr(EXACT_SCORE)).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    inner = many.where(F.size("w") > 2).select("lang", "a", F.col("w").alias("v"), F.explode(F.sequence(F.lit(2), F.size("w") - 1)).alias("size"))
    inner = inner.select("lang", "a", F.explode(F.expr("transform(sequence(1, size(v) - size + 1), i -> array_join(slice(v, i, size), ' '))")).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    swallowed = F.expr(f"cast(100 as decimal(3,0)) * cast(longer as decimal(19,0)) >= cast({share} as decimal(10,0)) * cast(a as decimal(19,0))")
    left = best.join(inner, ["lang", "phrase"], "left").where(~F.coalesce(swallowed, F.lit(False)))
    best_first = F.desc("best.score"), F.desc("a"), F.col("phrase")
    # a lang may hold most phrases: its parts are ranked first, then only their best together
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).orderBy(*best_first)
    ranked = left.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best_first))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


SQL = f"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM t),
tot AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
g AS (SELECT lang, k, w[i:i+k-1] AS v FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, {LONGEST + 1}) AS s(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, v, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= {SUPPORT}),
c AS (SELECT * FROM f WHERE k > 1),
cut AS (SELECT lang, v, a, unnest(range(1, k)) AS j FROM c),
s AS (SELECT cut.lang, cut.v, cut.a, j, x.a AS l, y.a AS r, CAST(CAST(2000000 AS HUGEINT) * cut.a // (x.a + y.a) AS BIGINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.v = cut.v[1:j] JOIN f y ON y.lang = cut.lang AND y.v = cut.v[j+1:]),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, v ORDER BY score, j) = 1),
sub AS (SELECT lang, v[i:i+m-1] AS v, max(a) AS longer FROM (
  SELECT lang, v, a, m, unnest(range(1, k - m + 2)) AS i FROM c, range(2, {LONGEST}) AS z(m) WHERE m < k) GROUP BY ALL),
o AS (SELECT b.*, array_to_string(b.v, ' ') AS phrase FROM best b LEFT JOIN sub USING (lang, v)
  WHERE sub.longer IS NULL OR CAST(100 AS HUGEINT) * sub.longer < CAST({SHARE} AS HUGEINT) * b.a)
SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM o JOIN tot USING (lang) QUALIFY rank <= {TOP}
"""
