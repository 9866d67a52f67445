"""Benchmark decontamination (operator 4).

Every window of 13 consecutive benchmark words (a shorter item is one window) is known by hashes of
its inner n-grams; that hash set is broadcast with the windows when its measured size is within
``MAX_BROADCAST_GRAMS``, and shuffled, as hashes only, to the documents' grams otherwise. A document is cut into
words once and probed at every ``step``-th word only, with grams of ``n + 1 - step`` words: any
window of n words holds one whole probed gram, wherever it begins (n = 13: grams of 7 words at every
7th word). Grams whose hash meets the set are then verified: the whole window around them is
compared word by word, so a hash collision cannot count. Hits of one document are gathered by
document, never by window, so a passage that many documents share is no hot key. All of it is
built-in functions.

Edge cases: null or wordless texts have no words and are clean; null or wordless items have no
windows; items may repeat (same id and text: one item); documents are told apart by (doc_id, text),
rows that repeat both are one result row; a null doc_id is an id of its own; an empty benchmark
leaves every document clean; extra columns are ignored, or passed by ``drop_contaminated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import alnum_words, table, text_of

WINDOW = 13
#: Grams broadcast at most (one takes about 200 bytes with its window), counted once for each item that holds them.
MAX_BROADCAST_GRAMS = 250_000


def probe_step(n: int) -> int:
    """Probes every so many words, with grams of n + 1 - step words."""
    return n // 2 + 1


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(words, n, item): every window of every item, once."""
    w = items.select(F.col("item_id").cast("string").alias("item"), alnum_words(text_of()).alias("w"))
    w = w.where(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(window)))
    w = w.select("item", "n", F.explode(F.expr("transform(sequence(0, size(w) - n), i -> slice(w, i + 1, n))")).alias("words"))
    return w.select("words", "n", "item").distinct()


def window_grams(windows: DataFrame) -> DataFrame:
    """(hash, len, offset, window_words, other columns): a window's grams at each offset that a probe can fall on."""
    step = F.expr("n div 2 + 1")
    more = [c for c in windows.columns if c not in ("n", "words")]
    w = windows.select("n", "words", *more, step.alias("step"), F.explode(F.sequence(F.lit(0), step.cast("int") - 1)).alias("offset"))
    gram = F.expr("slice(words, offset + 1, cast(n + 1 - step as int))")
    return w.select(F.xxhash64(gram).alias("hash"), F.col("n").alias("len"), "offset", F.col("words").alias("window_words"), *more)


def find_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, n_words, hits array<struct<start,n>>, items array<string>) for every document."""
    pairs = item_windows(items, window)
    # one small aggregate: which window lengths occur, and how many grams there are, counted once for each item
    facts = pairs.agg(F.collect_set("n").alias("lengths"), F.sum(F.expr("n div 2 + 1")).alias("grams")).first()
    d = docs.select("doc_id", F.xxhash64(text_of()).alias("text_key"), alnum_words(text_of()).alias("w"))
    probes = []
    for n in sorted(facts["lengths"]):
        step = probe_step(n)
        g = n + 1 - step
        probes.append(F.expr(
            f"if(size(w) < {n}, array(), transform(sequence(0, greatest(size(w), {g}) - {g}, {step}),"
            f" i -> named_struct('hash', xxhash64(slice(w, i + 1, {g})), 'at', i, 'n', {n})))"
        ))
    if (facts["grams"] or 0) <= MAX_BROADCAST_GRAMS:
        return _broadcast_hits(d, probes, pairs)
    return _shuffled_hits(d, probes, pairs)


def _broadcast_hits(d: DataFrame, probes: list[Column], pairs: DataFrame) -> DataFrame:
    """The windows and their items go to every task, where probes are verified beside the document's words."""
    windows = pairs.groupBy("words", "n").agg(F.collect_set("item").alias("items"))
    # one more entry for the document itself, so that clean documents stay
    own = F.array(F.struct(F.lit(None).cast("bigint").alias("hash"), F.lit(-1).alias("at"), F.size("w").alias("n")))
    probe = d.select("doc_id", "text_key", "w", F.explode(F.concat(*probes, own)).alias("p"))
    probe = probe.select("doc_id", "text_key", "w", "p.hash", "p.at", "p.n")
    start = F.col("at") - F.col("offset")
    whole = (F.col("len") == F.col("n")) & (start >= 0) & (
        F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("n")) == F.col("window_words")
    )
    met = probe.join(F.broadcast(window_grams(windows)), "hash", "left").where((F.col("at") < 0) | whole)
    return met.groupBy("doc_id", "text_key").agg(
        F.max(F.when(F.col("at") < 0, F.col("n"))).cast("long").alias("n_words"),
        F.array_sort(F.collect_set(F.when(F.col("at") >= 0, F.struct(start.alias("start"), "n")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def _shuffled_hits(d: DataFrame, probes: list[Column], pairs: DataFrame) -> DataFrame:
    """The same for a benchmark of any size. Probes and grams meet as bare hashes; documents with a place where a
    window may stand are met once more for its words, which are held against the windows' words; items come last,
    by (document, window). Clean documents never take part in a join, so there is no key for "no hash"."""
    windows = pairs.select("words", "n").distinct()
    grams = window_grams(windows).select("hash", F.col("len").alias("n"), "offset").distinct()
    probe = d.select("doc_id", "text_key", F.size("w").alias("size"), F.explode(F.concat(*probes)).alias("p"))
    probe = probe.select("doc_id", "text_key", "size", "p.hash", "p.at", "p.n").join(grams, ["hash", "n"])
    probe = probe.withColumn("start", F.col("at") - F.col("offset")).where((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.col("size")))
    places = probe.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "n")).alias("places"))
    places = places.select(F.col("doc_id").alias("at_id"), F.col("text_key").alias("at_key"), "places")
    there = d.join(places, F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("text_key") == F.col("at_key")))
    there = there.select("doc_id", "text_key", F.explode(F.expr("transform(places, p -> struct(p.start, p.n, slice(w, p.start + 1, p.n) as words))")).alias("p"))
    hits = cut_lineage(there.select("doc_id", "text_key", "p.start", "p.n", "p.words").join(windows, ["words", "n"], "left_semi"))
    found = hits.select("doc_id", "text_key", "words").distinct().join(pairs.select("words", "item"), "words")
    rows = (
        d.select("doc_id", "text_key", F.size("w").alias("n_words"))
        .unionByName(hits.select("doc_id", "text_key", F.struct("start", "n").alias("hit")), allowMissingColumns=True)
        .unionByName(found.select("doc_id", "text_key", "item"), allowMissingColumns=True)
    )
    return rows.groupBy("doc_id", "text_key").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.array_sort(F.collect_set("hit")).alias("hits"),
        F.array_sort(F.collect_set("item")).alias("items"),
    )


def covered(hits: Column) -> Column:
    """Words inside the union of sorted (start, n) windows."""
    step = lambda acc, h: F.struct(
        (acc["total"] + F.greatest(F.lit(0), h["start"] + h["n"] - F.greatest(acc["end"], h["start"]))).alias("total"),
        F.greatest(acc["end"], h["start"] + h["n"]).alias("end"),
    )
    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
    return F.aggregate(hits, zero, step, lambda acc: acc["total"].cast("long"))


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """The contract's rule: at least a twentieth of the words are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def judge(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    found = find_hits(docs, items, window).withColumn("n_hit", covered(F.col("hits")))
    return found.withColumn("contaminated", contaminated(F.col("n_hit"), F.col("n_words")))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, columns unchanged. Only the few contaminated
    (doc_id, text) keys are joined back."""
    bad = judge(docs, items, window).where("contaminated").select(F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key"))
    rows = docs.select(F.struct("*").alias("row"))
    clean = rows.join(bad, F.col("row.doc_id").eqNullSafe(F.col("bad_id")) & (F.xxhash64(text_of("row.text")) == F.col("bad_key")), "left_anti")
    return clean.select("row.*")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judge(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


_WORDS = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bn AS (SELECT item, w, least(len(w), {WINDOW}) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, n, w[i:i+n-1] AS g FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bn)),
dw AS (SELECT doc_id, i, n, w[i:i+n-1] AS g FROM (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bn) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, dw.n, item FROM dw JOIN bw ON dw.g = bw.g),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN its USING (doc_id)
"""
