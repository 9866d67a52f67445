"""Toxic spans by a linear-chain conditional random field (operator 5).

1. Labels come from ``labels.toxic`` of training rows only (crc32 of doc_id as text, modulo 4, is not
   2). Spark counts, over all training rows with distinct texts, in how many toxic and other texts a
   word stands; all words with a significant log-odds ratio form the lexicon, which goes to the tasks.
2. Tokens are labelled by distant supervision: lexicon words in toxic texts are toxic, all others are
   not. The field has two tags, transition weights, and emission weights for the log-odds class of
   the word and its neighbours, capitals and attached symbols. It is fitted by maximum likelihood
   (exact forward-backward gradients) in one task on a hash sample of about ``TRAIN_DOCS`` training
   rows, as is the logistic layer from a text's marginals to its label.
3. Every whole text is cut into chains (sentences; runs of ``CHAIN`` words where no sentence ends).
   Forward-backward gives each word's marginal; their sum, maximum and rate give the text's score,
   and words over 0.5 the offending offsets. Chains without any feature all share the result of
   their length.

lang, source and doc_id are no inputs of a score. Edge cases: null text is the empty text, and empty
texts get a score from the logistic layer like all others; a training table without toxic (or
without other) rows gives the training share of toxic rows, smoothed, to every text; null labels are
left out; rows repeat their result; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_of

#: Bound of the fit: sample size in expectation.
TRAIN_DOCS = 4000
#: A lexicon word stands in so many distinct toxic texts at least, with this log-odds ratio and z value.
LEAST_TEXTS, LEAST_LOG_ODDS, LEAST_Z = 3, 1.5, 3.5
#: Labels that may be broadcast (12 bytes each); above, texts and labels are shuffled.
MAX_BROADCAST_LABELS = 1_000_000
CHAIN = 64
CUT = 0.3
CLASSES = 6  # log-odds classes of lexicon words; 0: no lexicon word
FEATURES = 3 * CLASSES + 2  # own class, previous, next, capitals, symbol

WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
#: The same words in Java's spelling, for the lexicon.
WORD_SQL = r"[\p{L}\p{Nl}\p{No}]+(?:['’][\p{L}\p{Nl}\p{No}]+)*"
ENDS = re.compile(r"[.!?\n]+")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of the labelled rows that may be learnt from; of equal texts with one label, one.

    The deduplication moves ids and digests only; the kept ids are broadcast to the documents while
    there are at most ``MAX_BROADCAST_LABELS`` of them, so texts aren't shuffled then.
    """
    marks = labels.where("toxic is not null").select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic")).distinct()
    marks = marks.where(~held_out("label_id"))
    few = marks.count() <= MAX_BROADCAST_LABELS
    marks = F.broadcast(marks) if few else marks
    rows = docs.select("doc_id", text_of().alias("text")).join(marks, F.col("doc_id") == F.col("label_id"))
    kept = rows.groupBy(F.xxhash64("text"), "toxic").agg(F.min("doc_id").alias("kept_id")).select("kept_id", F.col("toxic").alias("kept_toxic")).distinct()
    kept = F.broadcast(kept) if few else kept
    texts = docs.select("doc_id", text_of().alias("text"))
    return texts.join(kept, F.col("doc_id") == F.col("kept_id")).select("text", F.col("kept_toxic").alias("toxic"))


def lexicon(train: DataFrame) -> DataFrame:
    """(word, odds): words that stand in toxic texts significantly more often than in others."""
    n1, n0 = train.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    found = F.regexp_extract_all(F.lower("text"), F.lit(WORD_SQL), F.lit(0))
    words = train.select("toxic", F.explode(F.array_distinct(found)).alias("word"))
    counts = words.groupBy("word").agg(F.sum("toxic").alias("d1"), F.sum(1 - F.col("toxic")).alias("d0")).where(F.col("d1") >= LEAST_TEXTS)
    odds = F.log((F.col("d1") + 0.5) / (n1 - F.col("d1") + 0.5)) - F.log((F.col("d0") + 0.5) / (n0 - F.col("d0") + 0.5))
    error = F.sqrt(1 / (F.col("d1") + 0.5) + 1 / (F.col("d0") + 0.5))
    scored = counts.select("word", odds.alias("odds"), (odds / error).alias("z"))
    return scored.where((F.col("odds") >= LEAST_LOG_ODDS) & (F.col("z") >= LEAST_Z)).select("word", "odds")


def classes_of(words: list[tuple[str, float]]) -> dict[str, int]:
    return {w: 1 + min(CLASSES - 2, int(odds - LEAST_LOG_ODDS)) for w, odds in words}


# -- the field -------------------------------------------------------------------------------------------
def forward_backward(unary, edges, lengths, counts=None):
    """Marginals of tag 1 and pair sums of chains of unequal length, padded to a matrix.

    unary: [chain, place] score of tag 1 against tag 0; edges: 2 x 2 scores; counts: how often each
    chain counts in the pair sums, once if not given. Returns (p, pairs, logz).
    """
    import numpy as np

    n, wide = unary.shape
    e = np.exp(edges)
    on = np.arange(wide) < lengths[:, None]
    emit = np.stack([np.ones_like(unary), np.exp(np.clip(unary, -30, 30))], 2)
    alpha, scale = np.empty((n, wide, 2)), np.ones((n, wide))
    a = emit[:, 0]
    for t in range(wide):
        if t:
            a = np.where(on[:, t, None], alpha[:, t - 1] @ e * emit[:, t], alpha[:, t - 1])
        s = np.where(on[:, t], a.sum(1), 1.0)
        scale[:, t] = s
        alpha[:, t] = a / s[:, None]
    beta = np.ones((n, wide, 2))
    pairs = np.zeros((2, 2))
    times = np.ones((n, 1)) if counts is None else np.asarray(counts, float)[:, None]
    for t in range(wide - 2, -1, -1):
        nxt = emit[:, t + 1] * beta[:, t + 1] / scale[:, t + 1, None]
        beta[:, t] = np.where(on[:, t + 1, None], nxt @ e.T, 1.0)
        pairs += ((alpha[:, t] * on[:, t + 1, None] * times).T @ nxt) * e
    p = alpha * beta
    p = p[:, :, 1] / p.sum(2)
    return np.where(on, p, 0.0), pairs, np.log(scale).sum()


def features_of(codes, caps, marks, on):
    """Feature numbers [chain, place, 5], -1 for none."""
    import numpy as np

    pad = np.zeros((len(codes), 1), codes.dtype)
    before, after = np.hstack([pad, codes[:, :-1]]), np.hstack([codes[:, 1:], pad])
    f = np.stack([codes, CLASSES + before, 2 * CLASSES + after, np.where(caps, 3 * CLASSES, -1), np.where(marks, 3 * CLASSES + 1, -1)], 2)
    return np.where(on[:, :, None], f, -1)


def unary_of(f, weights):
    import numpy as np

    return np.append(weights, 0.0)[f].sum(2)


class Chains:
    """Chains of a batch of texts that have any feature, and the lengths of the others."""

    def __init__(self, texts: list[str], classes: dict[str, int], everything: bool = False):
        import numpy as np

        get = classes.get
        self.text, self.at, self.words, self.codes = [], [], [], []
        self.plain: list[tuple[int, int]] = []  # (text, length) of chains without a feature
        self.n_words = np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            low = text.lower()
            if len(low) != len(text):  # a letter whose lower case is longer: keep the offsets
                low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
            first = 0
            for piece in ENDS.split(low):
                at = low.find(piece, first) if piece else first
                first = at + len(piece)
                words = WORD.findall(piece)
                if not words:
                    continue
                self.n_words[k] += len(words)
                codes = [get(w, 0) for w in words]
                if any(codes) or everything:
                    places = [at + m.start() for m in WORD.finditer(piece)]
                    for b in range(0, len(words), CHAIN):
                        self.text.append(k)
                        self.codes.append(codes[b : b + CHAIN])
                        self.at.append(places[b : b + CHAIN])
                        self.words.append([text[p : p + len(w) + 1] for p, w in zip(places[b : b + CHAIN], words[b : b + CHAIN])])
                else:
                    full, rest = divmod(len(words), CHAIN)
                    self.plain += [(k, CHAIN)] * full + [(k, rest)] * (rest > 0)
        self.lengths = np.array([len(c) for c in self.codes], np.int64)

    def matrices(self, rows):
        """Padded arrays of the chains ``rows``: feature numbers and lengths."""
        import numpy as np

        lengths = self.lengths[rows]
        wide = int(lengths.max())
        codes = np.zeros((len(rows), wide), np.int64)
        caps, marks = np.zeros((len(rows), wide), bool), np.zeros((len(rows), wide), bool)
        for r, k in enumerate(rows):
            codes[r, : lengths[r]] = self.codes[k]
            # shape features belong to lexicon words only, so that chains without one are all alike
            for j, c in enumerate(self.codes[k]):
                if c:
                    w = self.words[k][j]
                    caps[r, j] = len(w) > 1 and w[: len(w) - (not w[-1:].isalpha())].isupper()
                    marks[r, j] = w[-1] in "!*$%#&"
        return features_of(codes, caps, marks, np.arange(wide) < lengths[:, None]), lengths

    def groups(self, size: int = 2048):
        """Chains of like length together, so that padding is small."""
        import numpy as np

        order = np.argsort(self.lengths, kind="stable")
        for at in range(0, len(order), size):
            yield order[at : at + size]


def plain_table(weights, edges):
    """(sum, maximum) of the marginals of chains without features, by length."""
    import numpy as np

    out = [(0.0, 0.0)]
    for n in range(1, CHAIN + 1):
        codes = np.zeros((1, n), np.int64)
        no = np.zeros((1, n), bool)
        f = features_of(codes, no, no, ~no)
        p, _, _ = forward_backward(unary_of(f, weights), edges, np.array([n]))
        out.append((float(p.sum()), float(p.max())))
    return np.array(out)


def marginals(texts: list[str], classes: dict[str, int], weights, edges, table=None):
    """(sums, maxima, word counts, offending offsets) of the texts."""
    import numpy as np

    chains = Chains(texts, classes)
    total, top = np.zeros(len(texts)), np.zeros(len(texts))
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    owner = np.array(chains.text, np.int64)
    for rows in chains.groups():
        f, lengths = chains.matrices(rows)
        p, _, _ = forward_backward(unary_of(f, weights), edges, lengths)
        np.add.at(total, owner[rows], p.sum(1))
        np.maximum.at(top, owner[rows], p.max(1))
        for r, j in zip(*np.nonzero(p >= 0.5)):
            k = rows[r]
            start = chains.at[k][j]
            spans[chains.text[k]].append((start, start + len(chains.words[k][j]) - (not chains.words[k][j][-1].isalpha())))
    if chains.plain:
        table = plain_table(weights, edges) if table is None else table
        k, n = np.array(chains.plain).T
        np.add.at(total, k, table[n, 0])
        np.maximum.at(top, k, table[n, 1])
    return total, top, chains.n_words, [sorted(s) for s in spans]


def layer_inputs(total, top, n_words):
    import numpy as np

    return np.column_stack([np.ones(len(total)), np.log1p(total), top, np.log1p(100 * total / np.maximum(n_words, 1))])


def fit(texts: list[str], toxic: list[int], classes: dict[str, int], steps: int = 40) -> dict:
    """Weights of the field (Rprop on the exact gradient) and of the logistic layer (Newton steps)."""
    import numpy as np

    chains = Chains(texts, classes)
    y_doc = np.array(toxic, float)
    weights, edges = np.zeros(FEATURES), np.zeros((2, 2))
    groups = []
    for rows in chains.groups():
        f, lengths = chains.matrices(rows)
        y = (f[:, :, 0] > 0) & (y_doc[np.array(chains.text)[rows]][:, None] > 0)
        inner = np.arange(f.shape[1] - 1) + 1 < lengths[:, None]
        seen = np.array([[((y[:, :-1] == a) & (y[:, 1:] == b) & inner).sum() for b in (0, 1)] for a in (0, 1)], float)
        groups.append((f, lengths, y, seen, None))
    # chains without features: all of their tags are 0, and those of one length are alike, so one counts for all
    if chains.plain:
        n = np.array([x for _, x in chains.plain])
        take, counts = np.unique(n, return_counts=True)
        wide = int(take.max())
        on = np.arange(wide) < take[:, None]
        no = np.zeros((len(take), wide), bool)
        f = features_of(np.zeros((len(take), wide), np.int64), no, no, on)
        groups.append((f, take, no, np.array([[float((n - 1).sum()), 0.0], [0.0, 0.0]]), counts))
    step, last = np.full(FEATURES + 4, 0.1), np.zeros(FEATURES + 4)
    for _ in range(steps):
        grad, grad_e = -0.01 * weights, -0.01 * edges
        for f, lengths, y, seen, counts in groups:
            p, pairs, _ = forward_backward(unary_of(f, weights), edges, lengths, counts)
            diff = np.repeat(((y - p) * (1 if counts is None else counts[:, None]))[:, :, None], f.shape[2], 2)
            on = f >= 0
            grad = grad + np.bincount(f[on], weights=diff[on], minlength=FEATURES)
            grad_e = grad_e + seen - pairs
        g = np.concatenate([grad, grad_e.ravel()])
        turn = g * last
        step = np.clip(np.where(turn > 0, step * 1.2, np.where(turn < 0, step * 0.5, step)), 1e-4, 1.0)
        g = np.where(turn < 0, 0, g)
        move = np.sign(g) * step
        weights, edges, last = weights + move[:FEATURES], edges + move[FEATURES:].reshape(2, 2), g
    x = layer_inputs(*marginals(texts, classes, weights, edges)[:3])
    layer = np.zeros(x.shape[1])
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(x @ layer, -30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + 0.05 * np.eye(len(layer))
        layer = layer + np.clip(np.linalg.solve(h, x.T @ (y_doc - q) - 0.05 * layer), -4, 4)
    return {"weights": weights.tolist(), "edges": edges.tolist(), "layer": layer.tolist()}


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """Lexicon and weights; small and bounded, so it travels to the driver and in the tasks' closures."""
    rows = training_rows(docs, labels)
    n, toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = (toxic + 1) / (n + 2)
    if not toxic or toxic == n:
        return {"prior": prior, "classes": {}}
    classes = classes_of([(r.word, r.odds) for r in lexicon(rows).collect()])
    share = min(1.0, TRAIN_DOCS / n)
    sample = rows.where(F.pmod(F.xxhash64("text", "toxic"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        texts, toxic = [], []
        for b in batches:
            texts += b.column(0).to_pylist()
            toxic += b.column(1).to_pylist()
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array([json.dumps(fit(texts, toxic, classes))])], names=["model"])

    got = sample.repartition(1).sortWithinPartitions("text", "toxic").mapInArrow(run, "model string").first()
    return {"prior": prior, "classes": classes} | (json.loads(got["model"]) if got else {})


def score_texts(docs: DataFrame, model: dict, key: str = "doc_id") -> DataFrame:
    """(key, score, spans array<struct<start,end>>) for every row."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        known = "layer" in model
        if known:
            weights, edges, layer = (np.array(model[k]) for k in ("weights", "edges", "layer"))
            plain = plain_table(weights, edges)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column(1).to_pylist()
                if known:
                    total, top, n, spans = marginals(texts, model["classes"], weights, edges, plain)
                    score = 1 / (1 + np.exp(-np.clip(layer_inputs(total, top, n) @ layer, -30, 30)))
                else:
                    score, spans = np.full(len(texts), model["prior"]), [[] for _ in texts]
                found = [[{"start": a, "end": b} for a, b in s] for s in spans]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score), pa.array(found, span)], names=[key, "score", "spans"])

    src = docs.select(F.col(key), text_of().alias("text"))
    return src.mapInArrow(run, f"`{key}` {src.schema[0].dataType.simpleString()}, score double, spans array<struct<start:bigint,end:bigint>>")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = score_texts(docs, train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic")))
    return scored.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"),
        F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))).alias("spans"),
    )
