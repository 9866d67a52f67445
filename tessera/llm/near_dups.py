"""Near-duplicate detection with SetSketch registers (operator 10).

A document's set is its distinct 5-word shingles (64-bit hashes of the folded word sequence). A
sketch has ``BANDS * ROWS`` registers; register i holds the smallest of the shingles' exponential
variates of hash function i on an exponentially spaced, truncated scale, floor(1 - log_b(x)). So
sketches merge by maxima, and equal registers are the likelier the more alike two sets are.

1. Equal sets are one node (their 64-bit digest); thousands of copies cost a grouped minimum.
2. ROWS registers make a band. Nodes that agree on a band share a bucket. With 40 bands of 5, two
   sets of similarity 0.85 miss each other in all bands with probability 6e-11.
3. A bucket doesn't give all its pairs. First every node meets one or two leaders, the earliest
   document among them, and links are closed to components. Then only nodes of different components
   meet: in buckets of up to ``SMALL`` nodes as pairs, in larger ones in bounded blocks, where nodes
   outside the bucket's largest component meet the others. While that would be too much work, more
   leader rounds with drawn leaders go first.
4. A pair's similarity is estimated jointly from both sketches by maximum likelihood, given the
   exact set sizes; pairs for which the contract's threshold is unlikely by more than
   ``SIGMAS`` standard deviations go no further. The others are verified on the full sets.
5. Verified links are closed to components; the label is the smallest doc_id.

Edge cases: null or blank text has an empty set, is linked with nothing and kept; fewer than five
words are one shingle; rows that repeat (or share a set) are one node, every row gets a result row;
component_id ignores null ids (it is null if a component has no other); ``kept`` compares null-safe;
an empty table gives an empty result. Hash equality stands for shingle equality: 64 bits.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_of
from .components import components
from .scratch import Scratch

SHINGLE = 5
BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
#: Base of the register scale, its top, and the rate of the exponential variates.
BASE, TOP, RATE = 1.001, 65535, 20.0
#: Buckets of at most so many nodes give all pairs.
SMALL = 24
#: Comparisons left to the exhaustive step; above, leader rounds go on while each takes off at least
#: the share WORTH of them.
REST_WORK = 50_000_000
WORTH = 0.2
#: Side of a block of the last, exhaustive step.
BLOCK = 256
SIGMAS = 6.0
#: Ids that may be broadcast to pick texts for verification (8 bytes each); above, a shuffle join.
MAX_BROADCAST_IDS = 1_000_000
SIMILAR = (85, 100)
#: Bytes of text that are hashed together; longer texts are hashed in pieces of that size.
BATCH_BYTES = 1 << 21
#: Nodes of a bucket that meet the bucket's own row in one part.
PART = 256

_MASK = (1 << 64) - 1


def _mix(x):
    """Bijective mixing of uint64 arrays."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _seeded(n: int, seed: int):
    """n fixed pseudo-random odd uint64 numbers."""
    import numpy as np

    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_POWER = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2^64


class Shingler:
    """Distinct shingle hashes of texts. A shingle's hash is a polynomial over its bytes, read off
    prefix sums, so a batch costs a few array passes however long its shingles are."""

    def __init__(self, width: int = SHINGLE):
        self.width = width
        self.byte = _seeded(256, 7)
        self.up = self.down = None

    def _powers(self, n: int) -> None:
        import numpy as np

        if self.up is None or len(self.up) < n:
            n = max(n, 1 << 20)
            for name, base in (("up", _POWER), ("down", pow(_POWER, -1, 1 << 64))):
                factors = np.full(n + 1, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype=np.uint64))

    def each(self, texts: list[bytes]) -> Iterator:
        """The set of each text, in turn; memory is bounded by BATCH_BYTES of text and the largest set."""
        at = 0
        while at < len(texts):
            if len(texts[at]) > BATCH_BYTES:
                yield self.long_set(texts[at])
                at += 1
                continue
            end, size = at, 0
            while end < len(texts) and end < at + 200 and size + len(texts[end]) <= BATCH_BYTES:
                size += len(texts[end])
                end += 1
            yield from self.sets(texts[at:end])
            at = end

    def long_set(self, text: bytes):
        """The set of one text, hashed in pieces that end between words and share ``width`` - 1 words."""
        import numpy as np

        found, words, at = np.zeros(0, np.uint64), [], 0
        while at < len(text):
            blank = _BLANK.search(text, at + BATCH_BYTES)
            end = blank.start() if blank else len(text)
            words += text[at:end].split()
            at = end
            if len(words) >= self.width:
                found = np.union1d(found, self.sets([b" ".join(words)])[0])
                words = words[len(words) - self.width + 1 :]
        return found if len(found) else self.sets([b" ".join(words)])[0]

    def sets(self, texts: list[bytes]) -> list:
        import numpy as np

        folded = [b" ".join(t.translate(_LOWER).split()) for t in texts]
        data = np.frombuffer(b"\n".join(folded) + b"\n", np.uint8)
        self._powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.byte[data] * self.up[: len(data)], dtype=np.uint64, out=sums[1:])
        gaps = np.flatnonzero((data == 32) | (data == 10))
        out, at = [], 0
        sizes = np.fromiter(map(len, folded), np.int64, len(folded))
        firsts = np.cumsum(sizes + 1) - sizes - 1
        lasts = np.searchsorted(gaps, firsts + sizes)
        for first, size, last in zip(firsts.tolist(), sizes.tolist(), lasts.tolist()):
            if not size:
                out.append(np.zeros(0, np.uint64))
            else:
                ends = gaps[at : last + 1]
                starts = np.concatenate([[first], ends[:-1] + 1])
                w = min(self.width, len(ends))
                a, b = starts[: len(ends) - w + 1], ends[w - 1 :]
                with np.errstate(over="ignore"):
                    out.append(np.unique(_mix((sums[b] - sums[a]) * self.down[a] ^ (b - a).astype(np.uint64))))
            at = last + 1
        return out


def registers(shingles):
    """uint16 registers of a set: minima of REGISTERS hash functions on the truncated exponential scale."""
    import numpy as np

    times = _seeded(REGISTERS, 11).astype(np.uint32) | np.uint32(1)
    plus = (_seeded(REGISTERS, 13) >> np.uint64(32)).astype(np.uint32)
    low = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(h), 256):
        v = h[at : at + 256, None] * times + plus
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x2C1B3C6D)
        np.minimum(low, v.min(0), out=low)
    x = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1.0 - np.log(x) / np.log(BASE)), 0, TOP).astype(np.uint16)


def band_keys(regs):
    import numpy as np

    rows = regs.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for j in range(ROWS):
            key = _mix((key ^ rows[:, j]) * np.uint64(_POWER) + np.uint64(j + 1))
    return key.view(np.int64)


def digest(shingles) -> int:
    """64-bit digest of a set: a sum of mixed hashes, so it needs no order."""
    import numpy as np

    with np.errstate(over="ignore"):
        total = _mix(shingles * np.uint64(0xD1342543DE82EF95) + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64)
        return int(_mix(np.array([total + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


def unlikely(regs_a, regs_b, n_a, n_b, threshold=SIMILAR):
    """True where the joint likelihood of two sketches speaks against similarity >= threshold by SIGMAS.

    For set shares u, v = n_a, n_b over their sum, a register is larger in a with probability
    p(u - v J), in b with p(v - u J), p(x) = -log_b(1 - x (b - 1) / b).
    """
    import numpy as np

    more, less = (regs_a > regs_b).sum(1), (regs_a < regs_b).sum(1)
    same = regs_a.shape[1] - more - less
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    limit = np.minimum(u / v, v / u)

    def loglik(j):
        j = np.minimum(j, limit)
        p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
        up, down = p(u - v * j), p(v - u * j)
        tiny = 1e-12
        return more[:, None] * np.log(up + tiny) + less[:, None] * np.log(down + tiny) + same[:, None] * np.log(np.clip(1 - up - down, tiny, 1))

    bound = threshold[0] / threshold[1]
    best = loglik(np.linspace(0, bound, 35)[None, :]).max(1)
    at = loglik(np.linspace(bound, 1, 16)[None, :]).max(1)
    return (best - at > SIGMAS**2 / 2) | (limit[:, 0] < bound - 1e-9)


# -- the steps -------------------------------------------------------------------------------------------
def sketches(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, n, node, bands, regs, more columns of docs): node, bands and regs are null for an empty set."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        shingler = Shingler()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            n, node, bands, regs = [], [], [], []
            for s in shingler.each(texts):
                n.append(len(s))
                r = registers(s) if len(s) else None
                node.append(digest(s) if len(s) else None)
                bands.append(None if r is None else band_keys(r))
                regs.append(None if r is None else r.tobytes())
            made = [pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(regs, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *made, *batch.columns[2:]], names=["doc_id", "n", "node", "bands", "regs", *more]
            )

    src = docs.select("doc_id", text_of().alias("text"), *more)
    kind, _, *kinds = (f.dataType.simpleString() for f in src.schema)
    passed = "".join(f", `{c}` {k}" for c, k in zip(more, kinds))
    return src.mapInArrow(run, f"doc_id {kind}, n bigint, node bigint, bands array<bigint>, regs binary{passed}")


def likely_pairs(pairs: DataFrame, sigs: DataFrame, threshold: tuple[int, int] = SIMILAR) -> DataFrame:
    """The (a, b) whose sketches leave the threshold possible."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in (2, 3))
            na, nb = (batch.column(k).to_numpy().astype(np.float64) for k in (4, 5))
            yield batch.filter(pa.array(~unlikely(ra, rb, na, nb, threshold))).select([0, 1])

    side = lambda x: sigs.select(F.col("node").alias(x), F.col("regs").alias(f"r{x}"), F.col("n").alias(f"n{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    bound = threshold[0] / threshold[1]
    both = both.where((F.col("na") >= F.col("nb") * bound) & (F.col("nb") >= F.col("na") * bound))
    return both.select("a", "b", "ra", "rb", "na", "nb").mapInArrow(run, "a bigint, b bigint")


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(node, set binary) of the nodes in ``ids`` (node, first_doc): hashed anew from one text each."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        shingler = Shingler()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            nodes = batch.column(0).to_pylist()
            made = lambda rows: pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in rows], pa.int64()), pa.array([s for _, s in rows], pa.binary())], names=["node", "set"]
            )
            rows, size = [], 0
            for k, s in zip(nodes, shingler.each(texts)):
                if len(s) and digest(s) == k:
                    rows.append((k, s.tobytes()))
                    size += s.nbytes
                if size > BATCH_BYTES:
                    yield made(rows)
                    rows, size = [], 0
            yield made(rows)

    small = ids.count() <= MAX_BROADCAST_IDS
    pick = F.broadcast(ids) if small else ids
    texts = docs.select("doc_id", text_of().alias("text")).join(pick, F.col("doc_id").eqNullSafe(F.col("first_doc")))
    return texts.select("node", "text").mapInArrow(run, "node bigint, set binary").dropDuplicates(["node"])


def similar(x, y, threshold: tuple[int, int] = SIMILAR) -> bool:
    """The contract's rule on two sorted arrays of distinct hashes."""
    import numpy as np

    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    common = int((y[at] == x).sum())
    return threshold[1] * common >= threshold[0] * (len(x) + len(y) - common)


def verified(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int] = SIMILAR) -> DataFrame:
    """The (a, b) with 100 * intersection >= 85 * union on the full sets (for 85/100)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            sets = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            keep = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), threshold) for x, y in sets]
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    side = lambda x: sets.select(F.col("node").alias(x), F.col("set").alias(f"s{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb")
    return both.mapInArrow(run, "a bigint, b bigint")


def with_bucket(members: DataFrame, per_key: DataFrame) -> DataFrame:
    """Bucket members (key, size, node, ...) joined with the row of their bucket in ``per_key`` (key, size, ...). A
    bucket of more than PART nodes is dealt over parts, each with a copy of that row, so that a hot key doesn't fill a task."""
    parts = F.ceil(F.col("size") / PART).cast("int")
    left = members.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int")).drop("size")
    right = per_key.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return left.join(right, ["key", "part"]).drop("part")


def leader_pairs(buckets: DataFrame, round_no: int) -> DataFrame:
    """Pairs of bucket members with leaders of other components; ``buckets``: (key, size, node, first, comp).

    Round 0: a node meets, of all its buckets' earliest documents, the earliest (copies mostly are
    copies of it), and one node drawn by hash. Later rounds: nodes outside a bucket's largest
    component meet a drawn member of that component and a drawn member of the bucket.
    """
    draw = F.xxhash64("node", "key", F.lit(round_no))
    by_comp = buckets.groupBy("key", "size", "comp").agg(
        F.count(F.lit(1)).alias("c"), F.min(F.struct("first", "node")).alias("early"), F.min(F.struct(draw.alias("d"), F.col("node"))).alias("drawn")
    )
    lead = by_comp.groupBy("key", "size").agg(
        F.count(F.lit(1)).alias("comps"),
        F.min("early").alias("early"),
        F.min_by(F.struct("comp", F.col("drawn.node").alias("node")), F.struct(-F.col("c"), "drawn")).alias("main"),
        F.min_by(F.struct("comp", F.col("drawn.node").alias("node")), "drawn").alias("any"),
    )
    met = with_bucket(buckets, lead.where("comps > 1"))
    if round_no == 0:
        each = met.groupBy("node").agg(F.min("early").getField("node").alias("x"), F.min_by("any.node", F.xxhash64("any.node")).alias("y"))
        pairs = each.select("node", F.explode(F.array("x", "y")).alias("lead")).where("node <> lead")
    else:
        outside = met.where(F.col("comp") != F.col("main.comp")).select("node", "comp", F.explode(F.array("main", "any")).alias("l"))
        pairs = outside.where(F.col("comp") != F.col("l.comp")).select("node", F.col("l.node").alias("lead"))
    return pairs.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()


def small_pairs(buckets: DataFrame) -> DataFrame:
    """All pairs of different components within the buckets of up to SMALL nodes."""
    lists = buckets.where(F.col("size") <= SMALL).groupBy("key").agg(F.collect_list(F.struct("node", "comp")).alias("m"))
    lists = lists.where(F.size(F.array_distinct("m.comp")) > 1)
    one = lists.select("m", F.explode("m").alias("x"))
    other = F.filter("m", lambda y: (y["node"] > F.col("x.node")) & (y["comp"] != F.col("x.comp")))
    return one.select(F.col("x.node").alias("a"), F.explode(F.transform(other, lambda y: y["node"])).alias("b")).distinct()


def apart(members: DataFrame) -> int:
    """Comparisons that the exhaustive step would make: nodes outside a large bucket's main component
    times its nodes."""
    by_comp = members.where(F.col("size") > SMALL).groupBy("key", "size", "comp").agg(F.count(F.lit(1)).alias("c"))
    each = by_comp.groupBy("key", "size").agg(F.max("c").alias("most"))
    return each.agg(F.coalesce(F.sum((F.col("size") - F.col("most")) * F.col("size")), F.lit(0))).first()[0]


def rest_links(buckets: DataFrame, sigs: DataFrame, sets_of: Callable[[DataFrame], DataFrame], threshold: tuple[int, int] = SIMILAR) -> DataFrame:
    """Verified links (a, b) between components that still share a large bucket. Nodes outside the
    bucket's largest component meet all nodes of other components, block by block; a pair is looked at
    in its first common band only. A block verifies in itself, the likeliest pairs of a node first, and
    gives one link for each node and component it reaches, so pairs never become rows."""
    buckets = buckets.select("key", "size", "node", "comp")
    by_comp = buckets.groupBy("key", "size", "comp").agg(F.count(F.lit(1)).alias("c"))
    main = by_comp.groupBy("key", "size").agg(F.count(F.lit(1)).alias("comps"), F.max("c").alias("most"), F.max_by("comp", F.struct("c", "comp")).alias("main"))
    met = with_bucket(buckets, main.where("comps > 1"))
    blocks_in = F.ceil(F.col("size") / BLOCK)
    blocks_out = F.ceil((F.col("size") - F.col("most")) / BLOCK)
    spot = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), n).cast("int")
    rows = sigs.select("node", "regs", "n", "bands").join(sets_of(met.select("node").distinct()), "node")
    inside = met.select("key", "node", "comp", spot(blocks_in, 1).alias("i"), F.explode(F.sequence(F.lit(0), (blocks_out - 1).cast("int"))).alias("j"))
    outside = met.where("comp <> main").select("key", "node", "comp", spot(blocks_out, 2).alias("j"), F.explode(F.sequence(F.lit(0), (blocks_in - 1).cast("int"))).alias("i"))
    inside, outside = inside.join(rows, "node"), outside.join(rows, "node")
    inside = inside.toDF(*inside.columns)  # columns of its own, for the cogroup

    def meet(key, left, right):
        import numpy as np
        import pandas as pd

        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        unpack = lambda d: np.frombuffer(b"".join(d["regs"]), np.uint16).reshape(-1, REGISTERS)
        ra, rb = unpack(left), unpack(right)
        ba, bb = np.stack(left["bands"].to_numpy()), np.stack(right["bands"].to_numpy())
        na, nb = left["n"].to_numpy(float), right["n"].to_numpy(float)
        a, b, out = left["node"].tolist(), right["node"].tolist(), []
        other = right["comp"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in right["set"]]
        bound = threshold[0] / threshold[1]
        for k, own in enumerate(left["comp"].tolist()):
            same = bb == ba[k]
            first = np.where(same.any(1), bb[np.arange(len(bb)), same.argmax(1)], 0) == key[0]
            on = np.flatnonzero(first & (other != own) & (na[k] >= bound * nb) & (nb >= bound * na[k]))
            if not len(on):
                continue
            on = on[~unlikely(np.repeat(ra[k : k + 1], len(on), 0), rb[on], np.full(len(on), na[k]), nb[on], threshold)]
            on = on[np.argsort(-(rb[on] == ra[k]).sum(1), kind="stable")]
            x, reached = np.frombuffer(left["set"].iloc[k], np.uint64), set()
            for j in on.tolist():
                if other[j] not in reached and similar(x, sets[j], threshold):
                    reached.add(other[j])
                    out.append((min(a[k], b[j]), max(a[k], b[j])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    blocks = outside.groupBy("key", "i", "j").cogroup(inside.groupBy("key", "i", "j"))
    return blocks.applyInPandas(meet, "a bigint, b bigint").distinct()


def labelled(docs: DataFrame, *extra: str, threshold: tuple[int, int] = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, comp, component_id, more columns of docs) for every row of ``docs``: comp
    names the component even where its ids are null; it and component_id are null for an empty set."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dups")
    per_doc = scratch.write(sketches(docs, *extra))
    first = scratch.write(per_doc.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_doc")))
    sigs = scratch.write(per_doc.where("node is not null").select("node", "n", "bands", "regs").dropDuplicates(["node"]))

    entries = sigs.join(first.withColumnRenamed("first_doc", "first"), "node").select("node", "first", F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = scratch.write(entries.join(shared, "key"))

    def sets_of(nodes: DataFrame) -> DataFrame:
        return scratch.write(full_sets(docs, nodes.join(first, "node")))

    def confirmed(likely: DataFrame) -> DataFrame:
        likely = scratch.write(likely)
        return verified(likely, sets_of(likely.select(F.explode(F.array("a", "b")).alias("node")).distinct()), threshold)

    def placed(comps: DataFrame) -> DataFrame:
        found = buckets.join(comps, "node", "left")
        return scratch.write(found.select("key", "node", "first", "size", F.coalesce("comp", "node").alias("comp")))

    # round 0: every node meets a leader or two
    links = scratch.write(confirmed(likely_pairs(leader_pairs(buckets.withColumn("comp", F.col("node")), 0), sigs, threshold)))
    comps = components(links, scratch)
    members = placed(comps)

    # more rounds, while too many nodes of large buckets are apart and the rounds help
    round_no, before, work = 1, 0, apart(members)
    while work > REST_WORK and (round_no == 1 or work < (1 - WORTH) * before):
        again = leader_pairs(members.where(F.col("size") > SMALL), round_no)
        links = scratch.write(links.union(confirmed(likely_pairs(again, sigs, threshold))))
        comps = components(links, scratch)
        round_no, before, members = round_no + 1, work, placed(comps)
        work = apart(members)

    # the rest: all pairs between components, in small buckets as rows, in large ones in blocks
    more = confirmed(likely_pairs(small_pairs(members), sigs, threshold))
    if work:
        more = more.union(rest_links(members.where(F.col("size") > SMALL), sigs, sets_of, threshold))
    links = scratch.write(links.union(more))
    comps = components(links, scratch)

    named = first.join(comps, "node", "left").select("node", "first_doc", F.coalesce("comp", "node").alias("comp"))
    smallest = named.groupBy("comp").agg(F.min("first_doc").alias("component_id"))
    named = named.join(smallest, "comp").select("node", "comp", "component_id")
    out = per_doc.select("doc_id", F.col("n").alias("n_shingles"), "node", *extra).join(named, "node", "left")
    return out.select("doc_id", "n_shingles", "comp", "component_id", *extra)


def near_duplicates(docs: DataFrame, threshold: tuple[int, int] = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``; threshold: similarity of a link,
    as a fraction of 0.8 at least (the bands are laid out for that)."""
    component = F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return labelled(docs, threshold=threshold).select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, threshold: tuple[int, int] = SIMILAR) -> DataFrame:
    """One row of each group of near-duplicates, columns unchanged: that of the smallest id, null ids
    last; of different texts with that id, or with null ids only, that of the smallest digest. Rows
    without words are linked with nothing: of those only equal rows are reduced to one.

    A row is known by the digest of its id and text (and, without words, of its other columns); rows
    alike in that give one, by the order of their other columns. They are reduced where they are
    read, before the shuffle, so a row repeated any number of times doesn't fill a task.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.to_json(F.struct(*others)) if others else F.lit("")
    doc_id = F.col("doc_id").cast("string")
    known = F.concat(
        F.coalesce(F.concat(F.length(doc_id).cast("string"), F.lit(":"), doc_id), F.lit("-")),
        F.coalesce(F.concat(F.lit("="), "text"), F.lit("-")),
        F.when(text_of().rlike(r"[^\x20\x09-\x0D]"), F.lit("")).otherwise(F.concat(F.lit("="), rest)),
    )
    key = F.unhex(F.sha2(known, 256)).alias("key")
    found = labelled(docs.select("doc_id", "text", key), "key", threshold=threshold)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).getField("key")
    keep = found.where("comp is not null").groupBy("comp").agg(first.alias("key")).select("key")
    keep = keep.union(found.where("comp is null").select("key"))
    rows = docs.select(key, F.struct("*").alias("row"), rest.alias("rest")).groupBy("key").agg(F.min_by("row", "rest").alias("row"))
    return rows.join(keep, "key", "left_semi").select("row.*")


def op10_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
