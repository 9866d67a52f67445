"""Licence scan (operator 8): an Aho-Corasick automaton finds identifier tags and notice phrases, a
shunting-yard parser evaluates the and/or/with expressions behind the tags.

A text is folded to its words (ASCII letters lower-cased; everything but ASCII digits and letters
and non-ASCII characters is a gap), joined by single blanks; the automaton runs once over that
line, so a phrase is found wherever its words stand consecutively, overlapping places included.
Where it meets a tag ("SPDX-License-Identifier", "License:"), the raw text behind the tag is read
as an expression: identifiers joined by AND, OR, WITH and brackets, WITH binding closest, OR least.
Behind "License:" or "Licence:", which also introduce prose, an expression ends before the first
identifier that isn't on the lists in ``spdx``; a lone plain word of these lists ("Fair", "Info")
counts only if no other word follows.
AND asks for all its parts, so it takes the stricter class of its sides, OR offers a choice, so it
takes the milder one.

Score: 1 - product of (1 - weight) over the distinct labels, with weight 0.95 for a label of an
expression, 0.9 for a notice phrase; 0 without any.

Edge cases: null text is the empty text (no words, no labels, score 0); a tag without a readable
expression gives no label; an unbalanced bracket or a dangling operator ends the expression before
it; a very long text is read whole, in time that grows with its length; rows are handled one by one, other columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import spdx
from .common import table, text_of

#: The contract's phrases and labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Notice phrases of other common licences.
NOTICES = {
    "gnu general public license version 3": "gpl-3",
    "gnu general public license version 2": "gpl-2",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2": "mpl-2",
    "under the bsd license": "bsd",
    "bsd 3 clause license": "bsd-3-clause",
    "bsd 2 clause license": "bsd-2-clause",
    "under the isc license": "isc",
    "eclipse public license": "epl",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAGS = ("spdx license identifier", "license", "licence")
#: Group 1: behind an SPDX tag; group 2: behind a plain one, which begins a word.
TAG_RE = re.compile(
    r"SPDX-License-Identifier[ \t]*:[ \t]*([^\r\n]*)|(?<![^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])Licen[sc]e[ \t]*:[ \t]*([^\r\n]*)",
    re.IGNORECASE | re.ASCII,
)
TOKEN_RE = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+-]*)")

#: Strictness by the beginning of an identifier; unknown ones count as 2.
STRICTNESS = (("cc0", 0), ("unlicense", 0), ("mit", 1), ("isc", 1), ("bsd", 1), ("apache", 1), ("zlib", 1), ("cc-by-nc", 4),
              ("cc-by-nd", 4), ("cc-by-sa", 3), ("cc-by", 1), ("lgpl", 2), ("mpl", 2), ("epl", 2), ("gpl", 3), ("agpl", 4))
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def strictness(identifier: str) -> int:
    return next((v for k, v in STRICTNESS if identifier.startswith(k)), 2)


def read_expression(text: str, listed: bool = False) -> list[str]:
    """Postfix form (shunting yard) of the longest readable expression that ``text`` begins with;
    ``listed``: of known identifiers only."""
    out: list[str] = []
    ops: list[str] = []
    best: list[str] = []
    operand_next, at = True, 0
    while m := TOKEN_RE.match(text, at):
        token, at = m[1].lower(), m.end()
        if listed:
            token = token.rstrip(".")  # of the sentence
        if operand_next:
            if token == "(":
                ops.append(token)
                continue
            if token == ")" or token in _PRECEDENCE:
                break
            if listed and not (token in spdx.EXCEPTIONS if ops and ops[-1] == "with" else spdx.known(token)):
                break
            out.append(token)
            operand_next = False
        elif token == ")":
            while ops and ops[-1] != "(":
                out.append(ops.pop())
            if not ops:
                break
            ops.pop()
        elif token in _PRECEDENCE:
            while ops and ops[-1] != "(" and _PRECEDENCE[ops[-1]] >= _PRECEDENCE[token]:
                out.append(ops.pop())
            ops.append(token)
            operand_next = True
            continue
        else:
            break
        if "(" not in ops:
            best = out + ops[::-1]
    return best


PLAIN_RE = re.compile(r"[ \t(]*[A-Za-z]+[ \t)]+[^\W\d_]")


def tagged_expression(m: re.Match) -> list[str]:
    """Postfix form of the expression behind a match of TAG_RE."""
    if m[1] is not None:
        return read_expression(m[1])
    postfix = read_expression(m[2], listed=True)
    family = postfix and any(postfix[0].startswith(k) for k, _ in STRICTNESS)
    return [] if len(postfix) == 1 and not family and PLAIN_RE.match(m[2]) else postfix


def evaluate(postfix: list[str]) -> tuple[list[str], int]:
    """(identifiers, strictness class) of a postfix expression."""
    stack: list[tuple[list[str], int]] = []
    for token in postfix:
        if token not in _PRECEDENCE:
            stack.append(([token], strictness(token)))
            continue
        (right, b), (left, a) = stack.pop(), stack.pop()
        if token == "with":  # an exception eases its licence and is no licence itself
            stack.append(([*left[:-1], f"{left[-1]} with {right[0]}"], max(0, a - 1)))
        else:
            stack.append((left + right, min(a, b) if token == "or" else max(a, b)))
    return stack[0] if stack else ([], 0)


_FOLD = bytes(b if b > 0x7F or chr(b).isdigit() or "a" <= chr(b) <= "z" else b + 32 if "A" <= chr(b) <= "Z" else 32 for b in range(256))


def scan_texts(texts: list[bytes], automaton) -> list[dict]:
    out = []
    for raw in texts:
        words = raw.translate(_FOLD).split()
        line = b" ".join([b"", *words, b""]) if words else b""
        places, labels, strict = [], set(), 0
        tagged = False
        matches = [(end - len(phrase) + 1, phrase, label) for end, (phrase, label) in automaton.iter(line.decode("latin-1"))]
        word, at = {}, 0  # blanks before each start, counted once along the line
        for start in sorted({s for s, _, label in matches if label is not None}):
            word[start] = word.get(at, 0) + line.count(b" ", at, start)
            at = start
        for start, phrase, label in matches:
            if label is None:
                tagged = True
                continue
            places.append({"label": label, "word": word[start], "base": phrase.strip() in BASE_PHRASES})
            labels.add(label)
        miss = 0.1 ** len(labels)
        expressions = []
        if tagged:
            for m in TAG_RE.finditer(raw.decode("utf-8")):
                if postfix := tagged_expression(m):
                    ids, level = evaluate(postfix)
                    strict = max(strict, level)
                    expressions.append(" ".join(postfix))
                    for i in ids:
                        miss *= 1 if i in labels else 0.05
                        labels.add(i)
        for x in places:
            strict = max(strict, strictness(x["label"]))
        out.append({"n_words": len(words), "places": places, "expressions": expressions, "labels": sorted(labels),
                    "strictness": strict if labels else None, "score": 1 - miss if labels else 0.0})
    return out


SCHEMA = ("n_words bigint, places array<struct<label:string,word:bigint,base:boolean>>, expressions array<string>, "
          "labels array<string>, strictness int, score double")  # fmt: skip


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, places, expressions in postfix form, labels, strictness, score) for every row."""

    def run(batches: Iterator) -> Iterator:
        import ahocorasick
        import pyarrow as pa

        automaton = ahocorasick.Automaton()
        for phrase, label in [*BASE_PHRASES.items(), *NOTICES.items(), *((t, None) for t in TAGS)]:
            automaton.add_word(f" {phrase} ", (f" {phrase} ", label))
        automaton.make_automaton()
        place = pa.struct([("label", pa.string()), ("word", pa.int64()), ("base", pa.bool_())])
        kinds = {"n_words": pa.int64(), "places": pa.list_(place), "expressions": pa.list_(pa.string()), "labels": pa.list_(pa.string()),
                 "strictness": pa.int32(), "score": pa.float64()}
        for batch in batches:
            rows = scan_texts(batch.column(1).cast(pa.binary()).to_pylist(), automaton)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[k] for r in rows], t) for k, t in kinds.items())], names=[key, *kinds]
            )

    src = docs.select(F.col(key), text_of(text).alias("text"))
    return src.mapInArrow(run, f"`{key}` {src.schema[0].dataType.simpleString()}, {SCHEMA}")


def digest(found: DataFrame) -> DataFrame:
    base = F.filter("places", lambda p: p["base"])
    found = found.withColumn("base", base)
    starts = F.transform("base", lambda p: p["word"])
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("base", lambda p: p["label"]))), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score",
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan_licenses(table(spark, sf_dir, "documents", "doc_id", "text")))
