"""Quality rules compiled into one projection (operator 2).

``compile_rules`` turns a threshold table into a single boolean expression over a few counts, and
``measure`` gives those counts with built-in functions only; Spark runs both as one projection over
the documents, without a shuffle.

Words are runs of anything but the six ASCII blanks. Windows of three words are sorted with their
positions inside the row, so equal windows are neighbours; the covered words then follow from the
distances between sorted positions. Nothing is compared pairwise.

Edge cases: null text is a text without words and fails; empty text likewise; ratios with a zero
denominator count as 0; rows are judged one by one, so repeated rows repeat their verdict and an
empty table gives an empty result; other columns may have any names, they are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANK, blank_words, table, text_of

#: Frequent short words of English, German, French and Spanish prose.
STOP_WORDS = (
    "the of and to in is it that for on with as was by this are from be at or an not have which "
    "der die das und von zu ist mit den im für des dem ein eine sich auf nicht auch "
    "le la les de et un une des du que qui en dans pour par sur est au aux avec il elle "
    "el los las y del se por con no una su para es al lo como "
).split()


@dataclass(frozen=True)
class Threshold:
    """A document fails if ``scale * metric`` lies outside [low, high] times ``per``."""

    name: str
    metric: str
    per: str | None = None
    scale: int = 1
    low: float | None = None
    high: float | None = None


#: Base rules of the contract.
BASE_RULES = (
    Threshold("too few words", "n_words", low=50),
    Threshold("repeated windows", "n_repeat_words", per="n_words", scale=100, high=50),
)
#: The method's further rules: word length, symbols, stop words and line ratios.
RULES = (
    Threshold("word length", "word_chars", per="n_words", low=2, high=15),
    Threshold("symbols", "n_symbols", per="n_words", scale=10, high=1),
    Threshold("stop words", "n_stop_words", per="n_words", scale=100, low=2),
    Threshold("duplicate lines", "n_dup_lines", per="n_lines", scale=10, high=5),
    Threshold("bullet lines", "n_bullet_lines", per="n_lines", scale=10, high=9),
    Threshold("ellipsis lines", "n_ellipsis_lines", per="n_lines", scale=10, high=3),
)


def compile_rules(rules: tuple[Threshold, ...], counts: Column) -> Column:
    """True where any rule fails, as one expression over the fields of ``counts``."""

    def fails(r: Threshold) -> Column:
        value = counts[r.metric] * r.scale
        per = counts[r.per] if r.per else F.lit(1)
        sides = [value < per * r.low if r.low is not None else None, value > per * r.high if r.high is not None else None]
        return reduce(lambda a, b: a | b, [s for s in sides if s is not None])

    return reduce(lambda a, b: a | b, [fails(r) for r in rules])


def measure(docs: DataFrame, text: str = "text", counts: str = "_counts") -> DataFrame:
    """``docs`` with a struct of counts in a new column."""
    t, w, s, p, lines = (f"{counts}_{x}" for x in ("text", "words", "sorted", "places", "lines"))
    q = lambda c: f"`{c}`"
    stop = ", ".join(f"'{x}'" for x in dict.fromkeys(STOP_WORDS))
    out = docs.withColumn(t, text_of(text))
    out = out.withColumns({
        w: blank_words(F.col(t)),
        lines: F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\f\r"))) > 0),
    })
    # sort (window, position) so that equal windows meet
    out = out.withColumn(s, F.expr(
        f"if(size({q(w)}) < 4, array(), sort_array(transform(sequence(0, greatest(size({q(w)}), 3) - 3), i -> "
        f"named_struct('w', concat_ws(' ', get({q(w)}, i), get({q(w)}, i + 1), get({q(w)}, i + 2)), 'p', i))))"
    ))
    out = out.withColumn(p, F.expr(
        f"sort_array(filter(transform({q(s)}, (x, i) -> if(x.w = get({q(s)}, i - 1).w or x.w = get({q(s)}, i + 1).w, x.p, -1)), p -> p >= 0))"
    ))
    n_lines = F.size(lines).cast("long")
    out = out.withColumn(counts, F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (n_lines - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        F.expr(f"if(size({q(p)}) = 0, 0L, 3L + aggregate(transform({q(p)}, (x, i) -> if(i = 0, 0, least(3, x - get({q(p)}, i - 1)))), 0L, (a, x) -> a + x))").alias("n_repeat_words"),
        F.expr(f"size(filter({q(w)}, x -> x in ({stop})))").cast("long").alias("n_stop_words"),
        n_lines.alias("n_lines"),
        F.size(F.filter(lines, lambda x: F.ltrim(x).substr(1, 1).isin("-", "*", "•"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).cast("long").alias("n_ellipsis_lines"),
    ))
    return out.drop(t, w, s, p, lines)


def judge(docs: DataFrame, rules: tuple[Threshold, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with ``_counts`` and ``_verdict`` (base_failed, kept)."""
    base = compile_rules(BASE_RULES, F.col("_counts"))
    out = measure(docs, text).withColumn("_base", base)
    kept = ~(F.col("_base") | compile_rules(rules, F.col("_counts")))
    return out.withColumn("_verdict", F.struct(F.col("_base").alias("base_failed"), kept.alias("kept"))).drop("_base")


def keep_good(docs: DataFrame, rules: tuple[Threshold, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` whose text passes all rules, columns unchanged (whatever their names)."""
    rows = judge(docs.select(F.struct("*").alias("row")), rules, "row.text")
    # as an array of no or one row, not as a filter: a filter would be pushed below the projections and
    # take their expressions along, one copy for each use
    return rows.select(F.inline(F.filter(F.array("row"), lambda r: F.col("_verdict.kept"))))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select(
        "doc_id", *[F.col(f"_counts.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "_verdict.base_failed", "_verdict.kept", "_counts.n_stop_words", "_counts.n_lines",
    )


def _rule_sql(r: Threshold) -> str:
    value, per = f"{r.metric} * {r.scale}", r.per or "1"
    sides = ([f"{value} < {per} * {r.low}"] if r.low is not None else []) + ([f"{value} > {per} * {r.high}"] if r.high is not None else [])
    return "(" + " OR ".join(sides) + ")"


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{BLANK}+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
tri AS (SELECT doc_id, i, w[i:i+2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM tri) WHERE n > 1),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
c AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(length(array_to_string(w, '')), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(hit.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(list_filter(w, lambda x: x IN ({", ".join(f"'{x}'" for x in dict.fromkeys(STOP_WORDS))}))) AS BIGINT) AS n_stop_words,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(list_filter(l, lambda x: substr(ltrim(x), 1, 1) IN ('-', '*', chr(8226)))) AS BIGINT) AS n_bullet_lines,
         CAST(len(list_filter(l, lambda x: rtrim(x) LIKE '%...' OR rtrim(x) LIKE '%' || chr(8230))) AS BIGINT) AS n_ellipsis_lines
  FROM w LEFT JOIN hit USING (doc_id)),
b AS (SELECT *, {" OR ".join(map(_rule_sql, BASE_RULES))} AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR {" OR ".join(map(_rule_sql, RULES))}) AS kept, n_stop_words, n_lines
FROM b
"""
