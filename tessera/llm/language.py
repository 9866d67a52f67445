"""Language identification (operator 12) by prediction by partial matching.

For each language the training texts give a byte context tree: how often each byte follows each
context of 0 to ``ORDER`` bytes. The counts of the longest contexts are gathered in the tasks and added
by a shuffle over all training texts; the shorter contexts follow from them by grouping on their last
bytes. The tree is of variable order: a context, or a byte behind it, is kept where it makes up
at least one in ``share`` of the language's bytes, which bounds the tree by the share alone, whatever the size of
the corpus. A byte that isn't kept behind its context costs the context's escape and is looked for
behind the next shorter one, down to all 256 bytes alike; escapes take one count for each byte seen behind
the context, plus what was left out of the tree, so the lengths are those of a proper code.

The statistics are then frozen: a text's code length is a sum over its bytes that depends on nothing but the
``ORDER`` bytes before each. Costs are laid out in one table for each order, with a column for each
language, and added for all bytes of a batch at once. The language of the shortest code wins; the
score is its share of 2^-length over all languages.

Bytes are folded first: ASCII letters to lower case, any stretch of other ASCII characters to one blank.

Edge cases: a null text, or one without a letter, is ``und`` with score 0, as are all texts if there is nothing
to learn from; rows with a null lang or text teach nothing; an empty lang is a language like any other; a null
doc_id is never held out; ties go to the smaller name; long texts are coded whole, ``WINDOW`` bytes at a time; repeated
rows count as often as they stand there; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Lookup
from .common import table, text_of
from .scratch import Scratch

ORDER = 4
#: Up to 8 languages; see ``share_of`` for more.
SHARE = 20_000
MAX_LANGS = 50
WINDOW = 1_000_000
PIECE_BYTES = 4_000_000
FLUSH = 2_000_000
UNDETERMINED = "und"
#: Stands before every text; no UTF-8 text holds it.
_START = 0xFF


def share_of(langs: int) -> int:
    """Contexts kept for each order and language: the whole model stays within 26 MB for 8 languages and 55 MB for 50."""
    return max(500, min(SHARE, SHARE * 64 // max(1, langs) ** 2))


def held_out(key: Column) -> Column:
    """One in four documents, by the checksum of the id, is never learnt from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def symbols(texts: list[bytes], order: int = ORDER):
    """(bytes, text of each byte): the folded texts side by side, each behind ``order`` start marks."""
    import numpy as np

    fold = np.full(256, 32, np.uint8)
    fold[97:123] = np.arange(97, 123)
    fold[65:91] = fold[97:123]
    fold[128:] = np.arange(128, 256)
    mark = bytes([_START]) * order
    data = fold[np.frombuffer(mark + mark.join(texts), np.uint8)]
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 32) | (data[:-1] != 32)
    sizes = np.array([len(t) + order for t in texts])
    return data[keep], np.repeat(np.arange(len(texts), dtype=np.int32), sizes)[keep]


def windows(data, text, order: int = ORDER, size: int = WINDOW) -> Iterator[tuple]:
    """(gram, text) of every byte that is no start mark: the byte in the lowest place, those before it above."""
    import numpy as np

    for at in range(order, len(data), size):
        part = data[at - order : at + size]
        gram = np.zeros(len(part) - order, np.int64)
        for k in range(order, -1, -1):
            gram = gram << 8 | part[order - k : len(part) - k]
        real = part[order:] != _START
        yield gram[real], text[at : at + size][real]


def sliced(texts: list[bytes], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """[first, end) of consecutive texts of about ``limit`` bytes."""
    first, size = 0, 0
    for k, t in enumerate(texts):
        if k > first and size + len(t) > limit:
            yield first, k
            first, size = k, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def gram_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) of (text, lang): every byte with the ``order`` bytes before it, counted."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        place = 8 * (order + 1)
        names: list[str] = []
        codes: dict[str, int] = {}
        held, size = [], 0

        def merged():
            keys = np.concatenate([k for k, _ in held])
            counts = np.concatenate([c for _, c in held])
            keys, group = np.unique(keys, return_inverse=True)
            return keys, np.bincount(group, counts, len(keys)).astype(np.int64)

        def batch_of(keys, counts):
            lang = pa.DictionaryArray.from_arrays(pa.array(keys >> place, pa.int32()), pa.array(names, pa.string())).cast(pa.string())
            return pa.RecordBatch.from_arrays([lang, pa.array(keys & (1 << place) - 1), pa.array(counts)], names=["lang", "gram", "n"])

        for batch in batches:
            texts, langs = batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()
            for x in langs:
                if x not in codes:
                    codes[x] = len(names)
                    names.append(x)
            for a, b in sliced(texts):
                code = np.array([codes[x] for x in langs[a:b]], np.int64)
                for gram, text in windows(*symbols(texts[a:b], order), order):
                    keys, counts = np.unique(gram | code[text] << place, return_counts=True)
                    held.append((keys, counts))
                    size += len(keys)
                    if size >= FLUSH:
                        held = [merged()]
                        size = len(held[0][0])
                        if size >= FLUSH // 2:
                            yield batch_of(*held[0])
                            held, size = [], 0
        if size:
            yield batch_of(*merged())

    return docs.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def context_trees(docs: DataFrame, scratch: Scratch, order: int = ORDER) -> tuple[list[str], DataFrame | None]:
    """(languages, nodes) learnt from (text, lang). A node (lang, k, context, total, kinds, bytes) is a kept context of k bytes,
    with its count, the number of bytes seen behind it, and the kept ones among them with their counts."""
    counts = scratch.write(gram_counts(docs, order))
    sums = counts.groupBy("lang").agg(F.sum("n").alias("n_bytes"))
    langs = sorted(r.lang for r in sums.select("lang").limit(MAX_LANGS + 1).collect())
    if len(langs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not langs:
        return [], None
    levels = F.array(*[F.struct(F.lit(k).alias("k"), F.expr(f"gram & {(1 << 8 * (k + 1)) - 1}L").alias("gram")) for k in range(order + 1)])
    levels = counts.select("lang", "n", F.explode(levels).alias("x")).groupBy("lang", "x.k", "x.gram").agg(F.sum("n").alias("n"))
    least = F.col("n_bytes") / share_of(len(langs))
    kept = F.when(F.col("n") >= least, F.struct(F.expr("cast(gram & 255 as int)").alias("byte"), "n"))
    # at most MAX_LANGS rows of sums; a context has at most 256 bytes
    nodes = levels.join(F.broadcast(sums), "lang").groupBy("lang", "k", F.shiftright("gram", 8).alias("context"), "n_bytes").agg(
        F.sum("n").alias("total"), F.count("*").alias("kinds"), F.collect_list(kept).alias("bytes")
    )
    return langs, nodes.where(F.col("total") >= least).drop("n_bytes")


class Model:
    """Frozen code lengths, in bits: for each order one table of grams and one of escapes, a column for each language."""

    def __init__(self, langs: list[str], nodes, order: int = ORDER):
        """``nodes``: an Arrow table of the nodes of ``context_trees``."""
        import numpy as np

        self.langs, self.order = langs, order
        code = {x: k for k, x in enumerate(langs)}
        lang = np.array([code[x] for x in nodes["lang"].to_pylist()], np.int64)
        level, context = nodes["k"].to_numpy(), nodes["context"].to_numpy()
        total, kinds = nodes["total"].to_numpy(), nodes["kinds"].to_numpy()
        kept = nodes["bytes"].combine_chunks()
        size = np.diff(kept.offsets.to_numpy())
        items = kept.flatten()
        byte, n = items.field("byte").to_numpy(), items.field("n").to_numpy()
        node = np.repeat(np.arange(len(lang)), size)
        # kept bytes take n of total + kinds; the escape takes all the rest, at least one count
        escape = -np.log2((total + kinds - np.bincount(node, n, len(lang))) / (total + kinds))
        cost = -np.log2(n / (total + kinds)[node])
        gram = context[node] << 8 | byte
        self.contexts, self.escapes, self.grams, self.costs = [], [], [], []
        for k in range(order + 1):
            at = np.flatnonzero(level == k)
            keys, row = np.unique(context[at], return_inverse=True)
            escapes = np.zeros((len(keys), len(langs)), np.float32)
            escapes[row, lang[at]] = escape[at]
            self.contexts.append(Lookup(keys, np.arange(len(keys))))
            self.escapes.append(escapes)
            at = np.flatnonzero(level[node] == k)
            keys, row = np.unique(gram[at], return_inverse=True)
            costs = self._escaped(keys, k)  # for the languages that don't keep this gram
            costs[row, lang[node[at]]] = cost[at]
            self.grams.append(Lookup(keys, np.arange(len(keys))))
            self.costs.append(costs)

    def _escaped(self, grams, k: int):
        """Bits of the grams if order k doesn't know them: its escape and the next shorter context."""
        import numpy as np

        row = self.contexts[k].get(grams >> 8 & (1 << 8 * k) - 1)
        out = self.bits(grams, k - 1)
        known = np.flatnonzero(row >= 0)
        out[known] += self.escapes[k][row[known]]
        return out

    def bits(self, grams, k: int | None = None):
        """Bits of each gram's lowest byte behind at most ``k`` bytes, a row for each gram and a column for each language."""
        import numpy as np

        k = self.order if k is None else k
        if k < 0:
            return np.full((len(grams), len(self.langs)), 8, np.float32)
        row = self.grams[k].get(grams & (1 << 8 * (k + 1)) - 1)
        out = np.empty((len(grams), len(self.langs)), np.float32)
        known = row >= 0
        out[known] = self.costs[k][row[known]]
        rest = np.flatnonzero(~known)
        if len(rest):
            out[rest] = self._escaped(grams[rest], k)
        return out

    def code_lengths(self, texts: list[bytes]):
        """Bits of each text (row) in each language (column)."""
        import numpy as np

        out = np.zeros((len(texts), len(self.langs)))
        size = max(1, 4 * WINDOW // len(self.langs))
        for gram, text in windows(*symbols(texts, self.order), self.order, min(WINDOW, size)):
            if not len(text):
                continue
            at = np.flatnonzero(np.diff(text, prepend=-1))
            out[text[at]] += np.add.reduceat(self.bits(gram), at, axis=0, dtype=np.float64)
        return out


def learn(docs: DataFrame, order: int = ORDER) -> Model | None:
    """The frozen model of (text, lang) rows; None if there is no row with both."""
    src = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    scratch = Scratch(docs.sparkSession, "language")
    langs, nodes = context_trees(src, scratch, order)
    # at most share_of(langs) nodes for each order and language
    model = Model(langs, nodes.toArrow(), order) if langs else None
    scratch.clear()
    return model


def predict(docs: DataFrame, model: Model | None, *extra: str) -> DataFrame:
    """(extra..., lang_pred, score, code_lengths in bits by language) for every row; only the text is looked at."""
    src = docs.select(*[F.col(x) for x in extra], text_of().alias("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("readable"))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        kind = pa.map_(pa.string(), pa.float64())
        for batch in batches:
            texts = batch.column(len(extra)).cast(pa.binary()).to_pylist()
            readable = batch.column(len(extra) + 1).to_numpy(zero_copy_only=False)
            for a, b in sliced(texts):
                ok = readable[a:b] & (model is not None)
                langs = np.full(b - a, UNDETERMINED, object)
                score, lengths = np.zeros(b - a), [[] for _ in range(a, b)]
                if ok.any():
                    at = np.flatnonzero(ok)
                    bits = model.code_lengths([texts[a + k] for k in at])
                    best = bits.argmin(axis=1)
                    langs[at] = np.array(model.langs, object)[best]
                    score[at] = 1 / np.exp2(bits[np.arange(len(at)), best][:, None] - bits).sum(axis=1)
                    for k, row in zip(at.tolist(), bits.tolist(), strict=True):
                        lengths[k] = list(zip(model.langs, row, strict=True))
                cols = [batch.column(k).slice(a, b - a) for k in range(len(extra))]
                cols += [pa.array(langs, pa.string()), pa.array(score), pa.array(lengths, kind)]
                yield pa.RecordBatch.from_arrays(cols, names=[*extra, "lang_pred", "score", "code_lengths"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema[: len(extra)]]
    return src.mapInArrow(run, ", ".join([*kinds, "lang_pred string, score double, code_lengths map<string,double>"]))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    model = learn(docs.where("NOT held_out"))
    return predict(docs, model, "doc_id", "held_out").select("doc_id", "held_out", "lang_pred", "score")
