"""Multi-party perspective rotation (operator 9).

For every participant of a conversation the dialogue is rendered once with that speaker as
``assistant`` and all others as named users; the mask marks the assistant's texts, as character
spans of the rendered text. System turns are context in every perspective and no participant.

A conversation is rendered in blocks of ``TURNS`` turn numbers, so no task ever gathers a whole long
conversation: usually a block is the whole dialogue. A block's rows are cut into parts of ``MAX_ROWS``
by their rank in (turn, role, text); at_turn is the block's first turn number, null turns have a block
of their own with a null at_turn, part counts from 0. Blocks in the order of (at_turn, part), null first,
make up the dialogue; mask spans count from the beginning of their block's text. The rule is the same at
every size, and in the SQL. Participants are joined to the finished blocks, so a turn's text is shuffled
once; only built-in functions are used.

Edge cases: rows that repeat in all four columns are one turn; rows that tie in (conv_id, turn) follow
by role, then text; a null role is "unknown", a null text empty, a null turn comes first, a null
conv_id is a conversation of its own; a conversation of system turns only has no participant and no
row; markers inside a text are broken up, so a text can't forge a turn; a very long text is a line like any
other and never cut; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import global_row_number
from .common import table

TURNS = 64
MAX_ROWS = 256
#: Keys over which the rows of a crowded block are dealt when they are picked.
SALTS = 32
SYSTEM = "system"


def matched(rows: DataFrame, crowded: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of ``rows`` by the blocks in ``crowded``, SALTS keys for each."""
    keys = crowded.select(F.col("conv_id").alias("k_conv"), F.col("chunk").alias("k_chunk"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("k_salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("turn", "role", "text"), F.lit(SALTS)))
    on = F.col("conv_id").eqNullSafe(F.col("k_conv")) & F.col("chunk").eqNullSafe(F.col("k_chunk")) & (F.col("salt") == F.col("k_salt"))
    return salted.join(keys, on, how).drop("salt")


def ranked(rows: DataFrame, crowded: DataFrame) -> DataFrame:
    """``rows`` of the blocks in ``crowded`` (conv_id, chunk), with their part: MAX_ROWS rows each, by
    the rank within the block. No step gathers a block: rows are picked by salted keys, ranked over
    ranges, and meet their block's first rank in stretches of MAX_ROWS rows."""
    order = [F.col(c) for c in ("conv_id", "chunk", "turn", "role", "text")]
    hot = global_row_number(matched(rows, crowded, "left_semi"), order).withColumn("stretch", F.floor(F.col("rn") / MAX_ROWS))
    pieces = hot.groupBy("conv_id", "chunk", "stretch").agg(F.min("rn").alias("low"))
    first = pieces.groupBy(F.col("conv_id").alias("k_conv"), F.col("chunk").alias("k_chunk")).agg(F.min("low").alias("first"))
    pieces = pieces.join(first, F.col("conv_id").eqNullSafe(F.col("k_conv")) & F.col("chunk").eqNullSafe(F.col("k_chunk")))
    pieces = pieces.select("k_conv", "k_chunk", F.col("stretch").alias("k_stretch"), "first")
    hot = hot.join(pieces, F.col("conv_id").eqNullSafe(F.col("k_conv")) & F.col("chunk").eqNullSafe(F.col("k_chunk")) & (F.col("stretch") == F.col("k_stretch")))
    return hot.select(*order, F.floor((F.col("rn") - F.col("first")) / MAX_ROWS).alias("part"))


def blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, chunk, part, lines array<struct<turn,role,text>>): at most MAX_ROWS lines."""
    chunk = F.floor(F.col("turn") / TURNS).cast("bigint").alias("chunk")
    rows = turns.select(
        "conv_id", "turn",
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"),
        chunk,
    ).distinct()
    # repeated rows count here, so some of these blocks may turn out to have one part, as all others have
    crowded = turns.groupBy("conv_id", chunk).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MAX_ROWS).select("conv_id", "chunk")
    whole = rows.withColumn("part", F.lit(0).cast("bigint"))
    if not crowded.isEmpty():
        whole = matched(whole, crowded, "left_anti").unionByName(ranked(rows, crowded))
    return whole.groupBy("conv_id", "chunk", "part").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("lines"))


def rotate(turns: DataFrame) -> DataFrame:
    """(conv_id, speaker, at_turn, part, n_turns, n_own, text, mask array<struct<start,end>>)."""
    made = blocks(turns)
    people = turns.select("conv_id", F.coalesce("role", F.lit("unknown")).alias("speaker")).where(F.col("speaker") != SYSTEM)
    people = people.distinct().withColumnRenamed("conv_id", "p_conv")
    rows = made.join(people, F.col("conv_id").eqNullSafe(F.col("p_conv")))
    head = lambda x: F.concat(
        F.lit("<|im_start|>"),
        F.when(x["role"] == F.col("speaker"), F.lit("assistant")).when(x["role"] == SYSTEM, F.lit("system")).otherwise(F.concat(F.lit("user name="), x["role"])),
        F.lit("\n"),
    )
    tail = "<|im_end|>\n"
    rows = rows.withColumn("pieces", F.transform("lines", lambda x: F.struct(head(x).alias("head"), x["text"].alias("text"), (x["role"] == F.col("speaker")).alias("own"))))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"))

    def add(acc, x):
        begin = acc["at"] + F.length(x["head"])
        end = begin + F.length(x["text"])
        spans = F.when(x["own"], F.concat(acc["spans"], F.array(F.struct(begin.alias("start"), end.alias("end"))))).otherwise(acc["spans"])
        return F.struct((end + len(tail)).alias("at"), spans.alias("spans"))

    return rows.select(
        "conv_id", "speaker", (F.col("chunk") * TURNS).alias("at_turn"), "part",
        F.size("lines").cast("long").alias("n_turns"),
        F.size(F.filter("pieces", lambda x: x["own"])).cast("long").alias("n_own"),
        F.array_join(F.transform("pieces", lambda x: F.concat(x["head"], x["text"], F.lit(tail))), "").alias("text"),
        F.aggregate("pieces", start, add, lambda acc: acc["spans"]).alias("mask"),
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rotate(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    span = lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))
    return out.withColumn("mask", F.array_join(F.transform("mask", span), ","))


SQL = f"""
WITH d AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS text,
                  CAST(floor(turn / {TURNS}.0) AS BIGINT) AS chunk FROM conversations),
r AS (SELECT *, (row_number() OVER (PARTITION BY conv_id, chunk ORDER BY turn NULLS FIRST, role, text) - 1) // {MAX_ROWS} AS part FROM d),
p AS (SELECT DISTINCT conv_id, role AS speaker FROM r WHERE role <> '{SYSTEM}'),
x AS (SELECT r.*, speaker, role = speaker AS own,
             '<|im_start|>' || CASE WHEN role = speaker THEN 'assistant' WHEN role = '{SYSTEM}' THEN 'system' ELSE 'user name=' || role END || chr(10) AS head
      FROM r JOIN p ON r.conv_id IS NOT DISTINCT FROM p.conv_id),
y AS (SELECT *, coalesce(sum(length(head) + length(text) + 11) OVER (PARTITION BY conv_id, speaker, chunk, part ORDER BY turn NULLS FIRST, role, text
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS a FROM x)
SELECT conv_id, speaker, chunk * {TURNS} AS at_turn, CAST(part AS BIGINT) AS part, count(*) AS n_turns, count(*) FILTER (own) AS n_own,
       string_agg(head || text || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS text,
       coalesce(string_agg(CAST(a AS BIGINT) || ':' || CAST(a + length(text) AS BIGINT), ',' ORDER BY turn NULLS FIRST, role, text) FILTER (own), '') AS mask
FROM y GROUP BY conv_id, speaker, chunk, part
"""
