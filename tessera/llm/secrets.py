"""Secret scan with one combined automaton (operator 3).

The rules' regular expressions are parsed, reversed, joined into one nondeterministic automaton,
made deterministic by subset construction over byte classes, and minimised. The table goes to the
executors, which run it once over every byte, right to left: a state tells which rules have a match
that begins at this byte. From each such start, leftmost first and never inside the rule's previous
match, the rule's own small automaton finds the longest match; failing matches are dropped and not
retried. Many stretches of the byte stream are stepped together as array lanes; a lane that was
begun in a wrong state is stepped again until its states agree.

A pem span is the BEGIN line in the query, as in its SQL; with ``whole_keys``, as for ``redact``, it
runs to the end of the key's END line.

Edge cases: null text is the empty text and has no spans; offsets are code points, end exclusive;
rows are handled one by one, so repeated rows repeat their result; columns other than the key and
the text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import spans_text, table, text_of


@dataclass(frozen=True)
class Rule:
    """``scan`` finds a kind; a match counts if its last ``run`` class has ``least`` characters
    (``tail``: the class) or, without a tail class, if the whole match has them."""

    kind: str
    scan: str
    least: int = 0
    tail: str = ""


_WORD_CHARS = "[A-Za-z0-9+/_.=-]"
_KEYS = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"

#: The three contract rules first, in the order of their kinds, then public token formats.
RULES = (
    Rule("assign", _KEYS + r"[\"']?\x20*[:=]\x20*[\"']?" + _WORD_CHARS + "+", 12, _WORD_CHARS),
    Rule("access", "AKIA[A-Z0-9]+", 18),
    Rule("hex", "[0-9a-f]{16,}", 16),
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", "AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("bearer", r"[Bb]earer\x20+[A-Za-z0-9._~+/-]+", 27),
)
BASE_KINDS = ("assign", "access", "hex")
_MARKS = rb"[\x20\t\"',;+/>#*|(){}\[\]]"
_GAP = rb"(?:" + _MARKS + rb"|[\r\n]|\\+[nrt])*+"
_LINE_GAP = rb"(?=" + _MARKS + rb"*+(?:[\r\n]|\\+[nr]))" + _GAP
#: What follows a pem header up to and including its END line: "Name: value" lines, then lines of base64.
#: Line ends may be written "\n", lines quoted or indented; lines of 40 characters may be joined by blanks.
KEY_BODY = re.compile(
    _GAP + rb"(?:[A-Za-z][A-Za-z-]*+:[ \t][^\r\n\\]*+" + _LINE_GAP + rb")*+"
    rb"(?:(?:[A-Za-z0-9+/=]|\\/)++(?:" + _LINE_GAP + rb"|(?<=[A-Za-z0-9+/=]{40})[ \t]++))*+"
    rb"(?:[A-Za-z0-9+/=]|\\/)*+" + _GAP + rb"-----END [A-Z ]*PRIVATE KEY-----"
)


# -- regular expression -> tree ----------------------------------------------------------------------
# A tree is ("set", frozenset of bytes) | ("cat", [trees]) | ("alt", [trees]) | ("rep", tree, least, most|None)
def parse(pattern: str):
    pos = 0

    def peek() -> str:
        return pattern[pos] if pos < len(pattern) else ""

    def take() -> str:
        nonlocal pos
        c = pattern[pos]
        pos += 1
        return c

    def char() -> int:
        c = take()
        if c != "\\":
            return ord(c)
        c = take()
        if c == "x":
            return int(take() + take(), 16)
        return ord({"n": "\n", "t": "\t"}.get(c, c))

    def alternatives():
        parts = [sequence()]
        while peek() == "|":
            take()
            parts.append(sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def sequence():
        items = []
        while peek() and peek() not in "|)":
            items.append(repeated(atom()))
        return ("cat", items)

    def atom():
        if peek() == "(":
            take()
            inner = alternatives()
            if take() != ")":
                raise ValueError(f"unclosed group in {pattern!r}")
            return inner
        if peek() == "[":
            take()
            negated = peek() == "^"
            if negated:
                take()
            chosen: set[int] = set()
            while peek() != "]":
                low = char()
                if peek() == "-" and pattern[pos + 1] != "]":
                    take()
                    chosen |= set(range(low, char() + 1))
                else:
                    chosen.add(low)
            take()
            return ("set", frozenset(set(range(256)) - chosen if negated else chosen))
        return ("set", frozenset({char()}))

    def repeated(tree):
        while peek() and peek() in "?*+{":
            c = take()
            if c == "{":
                body = ""
                while peek() != "}":
                    body += take()
                take()
                low, comma, high = body.partition(",")
                tree = ("rep", tree, int(low), (int(high) if high else None) if comma else int(low))
            else:
                tree = ("rep", tree, int(c == "+"), 1 if c == "?" else None)
        return tree

    tree = alternatives()
    if pos != len(pattern):
        raise ValueError(f"can't read {pattern!r} at {pos}")
    return tree


def reverse(tree):
    kind = tree[0]
    if kind == "cat":
        return ("cat", [reverse(t) for t in reversed(tree[1])])
    if kind == "alt":
        return ("alt", [reverse(t) for t in tree[1]])
    if kind == "rep":
        return ("rep", reverse(tree[1]), *tree[2:])
    return tree


# -- trees -> nondeterministic automaton -> minimal deterministic automaton --------------------------
class Nfa:
    def __init__(self) -> None:
        self.free: list[list[int]] = []  # moves without a byte
        self.move: list[tuple[frozenset, int] | None] = []

    def state(self) -> int:
        self.free.append([])
        self.move.append(None)
        return len(self.free) - 1

    def add(self, tree, start: int) -> int:
        """Builds the tree from ``start``; returns its end state."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            if self.move[start] is not None:
                mid = self.state()
                self.free[start].append(mid)
                start = mid
            self.move[start] = (tree[1], end)
            return end
        if kind == "cat":
            for t in tree[1]:
                start = self.add(t, start)
            return start
        if kind == "alt":
            end = self.state()
            for t in tree[1]:
                first = self.state()
                self.free[start].append(first)
                self.free[self.add(t, first)].append(end)
            return end
        _, inner, least, most = tree
        for _ in range(least):
            start = self.add(inner, start)
        if most is None:
            loop = self.state()
            self.free[start].append(loop)
            first = self.state()
            self.free[loop].append(first)
            self.free[self.add(inner, first)].append(loop)
            end = self.state()
            self.free[loop].append(end)
            return end
        end = self.state()
        for _ in range(most - least):
            self.free[start].append(end)
            first = self.state()
            self.free[start].append(first)
            start = self.add(inner, first)
        self.free[start].append(end)
        return end

    def closed(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


@dataclass
class Dfa:
    classes: object  # 256 byte classes
    step: object  # [state, class] -> state
    accept: object  # state -> bit mask of rules


def compile_rules(trees: list, search: bool) -> Dfa:
    """Minimal automaton of all trees; with ``search`` a match may begin at any byte. State 0 is the start."""
    import numpy as np

    nfa = Nfa()
    starts, ends = [], {}
    for k, tree in enumerate(trees):
        first = nfa.state()
        starts.append(first)
        ends[nfa.add(tree, first)] = 1 << k
    # bytes that no set tells apart are one class
    sets = sorted({m[0] for m in nfa.move if m}, key=sorted)
    marks: dict[tuple, int] = {}
    classes = np.zeros(256, np.uint8)
    for b in range(256):
        classes[b] = marks.setdefault(tuple(b in s for s in sets), len(marks))
    byte_of = {int(c): b for b, c in enumerate(classes)}
    start = nfa.closed(starts)
    number, todo, step, accept = {start: 0}, [start], [], []
    while todo:
        here = todo.pop(0)
        accept.append(sum({ends[s] for s in here if s in ends}))
        row = []
        for c in range(len(marks)):
            b = byte_of[c]
            to = {m[1] for s in here if (m := nfa.move[s]) and b in m[0]}
            there = nfa.closed(to | set(starts) if search else to)
            if there not in number:
                number[there] = len(number)
                todo.append(there)
            row.append(number[there])
        step.append(row)
    step, accept = np.array(step, np.int64), np.array(accept, np.int64)
    # states are equal if they accept alike and step to equal states: refine until nothing splits
    block = np.unique(accept, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    order = np.full(block.max() + 1, -1)
    count = 0
    for s in range(len(block)):
        if order[block[s]] < 0:
            order[block[s]] = count
            count += 1
    block = order[block]
    first = np.array([np.flatnonzero(block == k)[0] for k in range(count)])
    return Dfa(classes, block[step[first]], accept[first])


# -- scanning --------------------------------------------------------------------------------------------
BORDER = 0xFF  # never a byte of UTF-8 text, and in no rule


def run_lanes(dfa: Dfa, data, lanes: int = 2048):
    """The state after each byte of ``data`` (uint8 array), many stretches stepped side by side."""
    import numpy as np

    n = len(data)
    width = dfa.step.shape[1]
    lanes = max(1, min(lanes, n // 64))
    steps = -(-n // lanes)
    symbols = np.full(lanes * steps, dfa.classes[BORDER], np.uint8)
    symbols[:n] = dfa.classes[data]
    symbols = np.ascontiguousarray(symbols.reshape(lanes, steps).T)
    jump = (dfa.step * width).ravel().astype(np.int32)  # states are kept multiplied by the width
    seen = np.empty((steps, lanes), np.int32)
    state = np.zeros(lanes, np.int32)
    for i in range(steps):
        state = jump[state + symbols[i]]
        seen[i] = state
    begun = np.zeros(lanes, np.int32)
    while True:
        right = np.concatenate([[0], seen[-1, :-1]]).astype(np.int32)
        wrong = np.flatnonzero(right != begun)
        if not len(wrong):
            break
        begun = right
        state = right[wrong]
        for i in range(steps):
            state = jump[state + symbols[i, wrong]]
            off = state != seen[i, wrong]
            if not off.any():
                break
            wrong, state = wrong[off], state[off]
            seen[i, wrong] = state
    return (seen.T.reshape(-1)[:n] // width).astype(np.int32)


class Scanner:
    """``whole_keys``: a pem span runs on over the key's body to the end of its END line; where none
    follows, it is the header only, as it always is without ``whole_keys``."""

    def __init__(self, rules: tuple[Rule, ...], whole_keys: bool = False):
        self.rules = rules
        self.whole = [whole_keys and r.kind == "pem" for r in rules]
        trees = [parse(r.scan) for r in rules]
        self.back = compile_rules([reverse(t) for t in trees], search=True)
        self.ahead = [self._plain(compile_rules([t], search=False)) for t in trees]
        self.tails = [frozenset(parse(r.tail)[1][0][1]) if r.tail else None for r in rules]

    @staticmethod
    def _plain(dfa: Dfa):
        dead = [bool((dfa.step[s] == s).all() and not dfa.accept[s]) for s in range(len(dfa.step))]
        table = [bytes_row.tolist() for bytes_row in dfa.step[:, dfa.classes]]
        return table, [bool(a) for a in dfa.accept], dead

    def longest(self, rule: int, text: bytes, start: int) -> int:
        table, accept, dead = self.ahead[rule]
        state, end = 0, -1
        for i in range(start, len(text)):
            state = table[state][text[i]]
            if dead[state]:
                break
            if accept[state]:
                end = i + 1
        return end

    def passes(self, rule: int, match: bytes) -> bool:
        r, tail = self.rules[rule], self.tails[rule]
        if tail is None:
            return len(match) >= r.least
        n = len(match)
        # the value ends the match; it begins after the key and its separator
        head = self.value_start(match)
        return n - head >= r.least

    @staticmethod
    def value_start(match: bytes) -> int:
        """First byte behind the key, ':' or '=', blanks and quotes of an assignment."""
        i = min(x for x in (match.find(b":"), match.find(b"=")) if x >= 0) + 1
        while match[i : i + 1] == b" ":
            i += 1
        return i + (match[i : i + 1] in (b'"', b"'"))

    def scan(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """For each text its (start, rule, end), in bytes, sorted."""
        import numpy as np

        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        firsts = np.cumsum(sizes + 1) - sizes - 1
        data = np.frombuffer(bytes([BORDER]).join(texts), np.uint8)
        if not len(data):
            return found
        marks = self.back.accept[run_lanes(self.back, data[::-1])][::-1]
        starts = np.flatnonzero(marks)
        doc = np.searchsorted(firsts, starts, side="right") - 1
        done: dict[tuple[int, int], int] = {}
        for d, at, mask in zip(doc.tolist(), (starts - firsts[doc]).tolist(), marks[starts].tolist()):
            for k in range(len(self.rules)):
                if mask >> k & 1 and at >= done.get((d, k), 0):
                    end = self.longest(k, texts[d], at)
                    if self.whole[k] and (body := KEY_BODY.match(texts[d], end)):
                        end = body.end()
                    done[d, k] = end
                    if self.passes(k, texts[d][at:end]):
                        found[d].append((at, k, end))
        for x in found:
            x.sort()
        return found


SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"
PIECE_BYTES = 4_000_000


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text", whole_keys: bool = False) -> DataFrame:
    """(key, spans): spans sorted by start, then by the order of the rules."""
    scanner = Scanner(rules, whole_keys)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            spans, at = [], 0
            while at < len(texts):
                size, n = 0, 0
                while at + n < len(texts) and (n == 0 or size + len(texts[at + n]) <= PIECE_BYTES):
                    size += len(texts[at + n])
                    n += 1
                for t, found in zip(texts[at : at + n], scanner.scan(texts[at : at + n])):
                    if found and not t.isascii():
                        found = [(len(t[:a].decode()), k, len(t[:b].decode())) for a, k, b in found]
                    spans.append([{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in found])
                at += n
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span))], names=[key, "spans"])

    src = docs.select(F.col(key), text_of(text).alias("text"))
    return src.mapInArrow(run, f"`{key}` {src.schema[0].dataType.simpleString()}, spans {SPAN_TYPE}")


def digest(found: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    out = found.withColumn("base", base)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select(
        "doc_id", *[count(k) for k in BASE_KINDS],
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``mark`` (overlapping spans by one) and
    ``n_chars`` counted anew; a private key goes as a whole, from its BEGIN to its END line; null texts
    stay null, other columns pass."""
    scanner = Scanner(rules, whole_keys=True)

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            raw = [t.encode() for t in part.fillna("")]
            out, at = [], 0
            while at < len(raw):
                size, n = 0, 0
                while at + n < len(raw) and (n == 0 or size + len(raw[at + n]) <= PIECE_BYTES):
                    size += len(raw[at + n])
                    n += 1
                for t, found in zip(raw[at : at + n], scanner.scan(raw[at : at + n])):
                    pieces, end = [], 0
                    for a, _, b in found:
                        if a >= end:
                            pieces += [t[end:a], mark.encode()]
                        end = max(end, b)
                    out.append(b"".join([*pieces, t[end:]]).decode())
                at += n
            yield pd.Series(out, dtype=object).where(part.notna().to_numpy(), None)

    clean = F.pandas_udf(run, "string")  # type: ignore[call-overload]
    cols = {"text": clean(F.col("text"))}
    out = docs.withColumns(cols)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_secrets(table(spark, sf_dir, "documents", "doc_id", "text")))


def _sql() -> str:
    """The same spans by DuckDB's regular expressions: matches and the gaps between them give offsets."""
    base = {"assign": r"(?:(?i:password|passwd|secret|token|api_?key))[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?[A-Za-z0-9+/_.=-]+", "hex": "[0-9a-f]+"}
    parts = []
    for k, r in enumerate(RULES):
        pattern = base.get(r.kind, r.scan)
        value = f"regexp_replace(m, '{base['assign'][:-len('[A-Za-z0-9+/_.=-]+')]}', '')" if r.tail else "m"
        parts.append(
            f"SELECT doc_id, {k} AS k, '{r.kind}' AS kind, m, strlen_cp, {value} AS v, {r.least} AS least, i, gaps, ms FROM ("
            f"SELECT doc_id, 0 AS strlen_cp, unnest(ms) AS m, generate_subscripts(ms, 1) AS i, ms, gaps FROM ("
            f"SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, regexp_split_to_array(t, '{pattern}') AS gaps FROM d))"
        )
    union = "\nUNION ALL\n".join(parts)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({union}),
s AS (
  SELECT doc_id, k, kind, length(m) AS n,
         CAST(list_sum([length(x) for x in gaps[1:i]]) + coalesce(list_sum([length(x) for x in ms[1:i-1]]), 0) AS BIGINT) AS a
  FROM m WHERE length(v) >= least),
g AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, k) FILTER (k < 3) AS base,
         string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, k) AS spans
  FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""


SQL = _sql()
