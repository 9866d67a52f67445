"""Personal data by weak supervision (operator 1), built-in functions only.

1. Base spans (e-mail, IP, card, phone) follow from regular expressions and checks, and always stay.
2. Further candidates (national ids, account numbers, birth dates, titled names, names, local phone
   numbers, spelled-out addresses) are found by wide regular expressions.
3. Labelers vote on every candidate, for (+1), against (-1) or not at all (0): a strict regular
   expression, a gazetteer, the words before, the words behind, and a list of words that speak
   against. Spark counts the vote patterns of all candidates of the corpus; there are at most
   kinds * 3^labelers of them, however large the corpus is.
4. Expectation-maximisation over that table estimates each labeler's reliability and each pattern's
   probability of being personal data.
5. A logistic span classifier (kind, votes, length and digit classes) is trained on the same table,
   weighted by counts, with those probabilities as soft labels. Its weights become one expression,
   and candidates with a probability of at least ``CUT`` and at least one vote for them are added.

Offsets of matches come from the gaps between them (``split`` and ``regexp_extract_all`` with one
pattern), summed in blocks, so a text with very many matches stays linear.

Edge cases: null text is the empty text and has no spans; offsets are code points, end exclusive;
a candidate that overlaps a base span is dropped; failing matches are dropped and not retried;
without any candidate there is nothing to fit and only base spans are returned; rows repeat their
result; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import spans_text, table, text_of

SPAN = "struct<start:int,end:int,match:string,left:string,right:string>"
AROUND = 48
CUT = 0.5
BLOCK = 256

#: The contract's kinds. Look-behinds and possessive repeats change no match; they spare
#: the engine attempts that must fail, and recursion on very long matches.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind to be looked for at all.
GATE = {"email": "[@]", "ip": r"[0-9]\.[0-9]", "card": "[0-9][0-9\x20-]{11}", "phone": r"\+[0-9]"}


def _passes(kind: str, match: Column) -> Column:
    digits = lambda: F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":  # a part of many digits may still be small: leading zeros don't count
        part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)?"
        return match.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        n = F.length(digits())
        return (n >= 13) & (n <= 19) & F.call_function("luhn_check", digits())
    if kind == "phone":
        n = F.length(digits())
        return (n >= 9) & (n <= 15)
    return F.lit(True)


FIRST_NAMES = (
    "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph "
    "Jessica Thomas Sarah Charles Karen Daniel Nancy Matthew Lisa Anthony Betty Mark Margaret Donald Sandra Steven "
    "Ashley Paul Kimberly Andrew Emily Joshua Donna Hans Anna Peter Ursula Klaus Monika Jean Marie Pierre Sophie "
    "Jose Maria Juan Carmen Antonio Ana Luis Laura"
).split()
ID_COUNTRIES = "AD AE AL AT AZ BA BE BG BH BR CH CR CY CZ DE DK DO EE ES FI FO FR GB GE GI GL GR GT HR HU IE IL IS IT KW KZ LB LI LT LU LV MC MD ME MK MR MT MU NL NO PK PL PS PT QA RO RS SA SE SI SK SM TN TR UA".split()


@dataclass(frozen=True)
class Candidate:
    """A wide pattern and, as regular expressions, the labelers' evidence for its matches."""

    kind: str
    pattern: str
    gate: str
    strict: str | None = None
    gazetteer: str | None = None
    before: str = ""
    behind: str = ""


CANDIDATES = (
    Candidate("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]-[0-9]{2}-[0-9]", r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)",
              before=r"(?i)\b(ssn|social|security|tax(payer)?|identity|insurance)\b", behind=r"(?i)\b(ssn|social security)\b"),
    Candidate("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}", r"^[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3}",
              "^(" + "|".join(ID_COUNTRIES) + ")", r"(?i)\b(iban|account|bank|konto|compte|cuenta)\b", r"(?i)\b(bic|swift|iban)\b"),
    Candidate("birth", r"(?<![0-9./-])[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}(?![0-9./-])", "[0-9][./-][0-9]", r"^(0?[1-9]|[12][0-9]|3[01])[./-](0?[1-9]|[12][0-9]|3[01])[./-]",
              before=r"(?i)(\bborn|birth|\bdob\b|geboren|née? le|nacid[oa])", behind=r"(?i)(birth|\bborn\b)"),
    Candidate("person", r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.?\x20[A-Z][a-z]+(?:\x20[A-Z][a-z]+)?", r"(Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)[.\x20]", r"\x20[A-Z][a-z]+\x20[A-Z][a-z]+$",
              r"\b(" + "|".join(FIRST_NAMES) + r")\b", r"(?i)\b(name|dear|contact|signed|called|patient)\b", r"(?i)^[,\x20]*(lives|resident|wrote|said|born|aged)\b"),
    Candidate("person", r"\b(?:" + "|".join(FIRST_NAMES) + r")\x20[A-Z][a-z]{2,}\b", r"\b(" + "|".join(FIRST_NAMES) + r")\x20[A-Z]", None,
              r"^(" + "|".join(FIRST_NAMES) + r")\b", r"(?i)\b(name|dear|contact|signed|called|patient|mr|mrs|by)\b", r"(?i)^[,\x20]*(lives|resident|wrote|said|born|aged)\b"),
    Candidate("localphone", r"(?<![0-9+(-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])", r"[0-9]{3}[)\x20.-]", r"^\(?[2-9]",
              before=r"(?i)\b(tel|phone|call|mobile|fax|cell|telefon|tél|contact)\b", behind=r"(?i)\b(ext|extension|phone|mobile)\b"),
    Candidate("spelled", r"\b[A-Za-z0-9._%+-]{2,40}\x20?[\[(]?\b(?:at|AT)\b[\])]?\x20?[A-Za-z0-9-]{2,40}\x20?[\[(]?\b(?:dot|DOT)\b[\])]?\x20?(?:com|org|net|edu|de|fr|es|io)\b", r"\b(dot|DOT)\b",
              r"[\[(](at|AT)[\])]", None, r"(?i)\b(mail|e-mail|email|contact|reach|write)\b", r"(?i)\b(mail|email)\b"),
)
AGAINST = r"(?i)\b(example|sample|dummy|placeholder|isbn|version|release|order|invoice|ticket|section|chapter|figure|build)\b"
LABELERS = ("strict", "gazetteer", "before", "behind", "against")


def match_spans(text: str, pattern: str, gate: str) -> str:
    """SQL for array<SPAN>: all leftmost non-overlapping matches in column ``text``, with surroundings."""
    p = pattern.replace("\\", "\\\\").replace("'", "\\'")
    g = gate.replace("\\", "\\\\").replace("'", "\\'")
    gaps, found = f"split({text}, '{p}', -1)", f"regexp_extract_all({text}, '{p}', 0)"
    inner = (
        f"transform(sequence(0, (size(x.ms) - 1) div {BLOCK}), b -> aggregate(slice(x.pairs, cast(b * {BLOCK} + 1 as int), {BLOCK}),"
        f" named_struct('at', 0, 'out', cast(array() as array<{SPAN}>)),"
        " (acc, y) -> named_struct('at', acc.at + length(y.g) + length(y.m), 'out', concat(acc.out, array(named_struct("
        "'start', acc.at + length(y.g), 'end', acc.at + length(y.g) + length(y.m), 'match', y.m,"
        f" 'left', right(y.g, {AROUND}), 'right', left(y.h, {AROUND})))))))"
    )
    shift = (
        "flatten(zip_with(blocks, aggregate(blocks, named_struct('at', 0, 'out', cast(array() as array<int>)),"
        " (acc, b) -> named_struct('at', acc.at + b.at, 'out', concat(acc.out, array(acc.at)))).out,"
        " (b, o) -> transform(b.out, s -> named_struct('start', s.start + o, 'end', s.end + o, 'match', s.match, 'left', s.left, 'right', s.right))))"
    )
    # one-element transforms name a value for use in the next step, so that it is computed once
    pairs = "zip_with(slice(x.gs, 1, size(x.ms)), zip_with(x.ms, slice(x.gs, 2, size(x.ms)), (m, h) -> struct(m, h)), (g, r) -> named_struct('g', g, 'm', r.m, 'h', r.h))"
    step1 = f"transform(array(named_struct('gs', {gaps}, 'ms', {found})), x -> named_struct('ms', x.ms, 'pairs', {pairs}))"
    step2 = f"transform({step1}, x -> if(size(x.ms) = 0, cast(array() as array<{SPAN}>), element_at(transform(array({inner}), blocks -> {shift}), 1)))"
    return f"if({text} rlike '{g}', element_at({step2}, 1), cast(array() as array<{SPAN}>))"


def base_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, base array<struct<kind,start,end>>)."""
    out = docs.select(key, text_of(text).alias("text"))
    out = out.select(key, "text", *[F.expr(match_spans("text", p, GATE[k])).alias(k) for k, p in BASE.items()])

    def checked(kind: str) -> Column:
        passing = F.filter(kind, lambda s: _passes(kind, s["match"]))
        return F.transform(passing, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    kinds = [checked(k) for k in BASE]
    return out.select(key, "text", F.concat(*kinds).alias("base"))


def candidates(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """``found`` with ``candidates``: (kind, start, end, votes, long, digits), none over a base span."""
    out = found.withColumns({f"c{i}": F.expr(match_spans("text", c.pattern, c.gate)) for i, c in enumerate(CANDIDATES)})

    def judged(i: int, c: Candidate) -> Column:
        vote = lambda says, no=0: F.when(says, F.lit(1)).otherwise(F.lit(no))

        def one(s):
            votes = [
                vote(s["match"].rlike(c.strict), -1) if c.strict else F.lit(0),
                vote(s["match"].rlike(c.gazetteer), -1) if c.gazetteer else F.lit(0),
                vote(s["left"].rlike(c.before)),
                vote(s["right"].rlike(c.behind)),
                F.when(s["left"].rlike(AGAINST), F.lit(-1)).otherwise(F.lit(0)),
            ]
            digits = F.length(F.regexp_replace(s["match"], "[^0-9]", ""))
            return F.struct(
                F.lit(c.kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                F.array(*votes).alias("votes"), F.least(F.floor(F.length(s["match"]) / 8), F.lit(3)).cast("int").alias("long"),
                F.floor(4 * digits / (F.length(s["match"]) + 1)).cast("int").alias("digits"),
            )

        return F.transform(f"c{i}", one)

    every = F.concat(*[judged(i, c) for i, c in enumerate(CANDIDATES)])
    apart = F.filter(every, lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return out.select(key, "base", apart.alias("candidates"))


def em(patterns: list[tuple[tuple[int, ...], float]], rounds: int = 60) -> tuple[list[float], list[list[list[float]]]]:
    """Probability of each vote pattern, and reliabilities [labeler][class][vote + 1], by EM.

    Starts from the majority of votes; smoothed, so a labeler without votes stays neutral."""
    p = [1 / (1 + math.exp(-1.5 * sum(v))) for v, _ in patterns]
    rates: list[list[list[float]]] = []
    for _ in range(rounds):
        total = sum(n for _, n in patterns)
        share = (sum(n * q for (_, n), q in zip(patterns, p)) + 1) / (total + 2)
        rates = []
        for k in range(len(LABELERS)):
            # a labeler is assumed better than chance to begin with
            sums = [[3.0, 4.0, 1.0], [1.0, 4.0, 3.0]]
            for (v, n), q in zip(patterns, p):
                sums[0][v[k] + 1] += n * (1 - q)
                sums[1][v[k] + 1] += n * q
            rates.append([[x / sum(row) for x in row] for row in sums])
        new = []
        for v, _ in patterns:
            odds = math.log(share / (1 - share)) + sum(math.log(rates[k][1][x + 1] / rates[k][0][x + 1]) for k, x in enumerate(v))
            new.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
        if max((abs(a - b) for a, b in zip(p, new)), default=0) < 1e-7:
            break
        p = new
    return p, rates


def _features(kind: str, votes: tuple[int, ...], long: int, digits: int) -> list[str]:
    return ["bias", f"kind={kind}", f"long={long}", f"digits={digits}", *(f"{n}={v}" for n, v in zip(LABELERS, votes) if v)]


def fit_classifier(rows: list[tuple[list[str], float, float]], rounds: int = 300) -> dict[str, float]:
    """Weighted logistic regression on soft labels: (features, weight, label) by gradient steps."""
    total = sum(w for _, w, _ in rows) or 1.0
    weights: dict[str, float] = {}
    for _ in range(rounds):
        grad: dict[str, float] = {}
        for feats, w, y in rows:
            z = sum(weights.get(f, 0.0) for f in feats)
            e = w / total * (y - 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            for f in feats:
                grad[f] = grad.get(f, 0.0) + e
        for f, g in grad.items():
            weights[f] = weights.get(f, 0.0) + 2.0 * (g - 0.001 * weights.get(f, 0.0))
    return weights


@dataclass
class Model:
    weights: dict[str, float]
    reliabilities: list[list[list[float]]]

    def probability(self, s: Column) -> Column:
        """The classifier as one expression over a candidate's fields."""
        z = F.lit(self.weights.get("bias", 0.0))
        for name, w in sorted(self.weights.items()):
            if name == "bias":
                continue
            field, _, value = name.partition("=")
            if field in LABELERS:
                hit = s["votes"][LABELERS.index(field)] == int(value)
            else:
                hit = s[field] == (value if field == "kind" else int(value))
            z = z + F.when(hit, F.lit(w)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def train(found: DataFrame) -> Model:
    """EM and the span classifier from the counts of all candidates' patterns."""
    each = found.select(F.explode("candidates").alias("c")).select("c.kind", "c.votes", "c.long", "c.digits")
    table_ = each.groupBy("kind", "votes", "long", "digits").agg(F.count(F.lit(1)).alias("n")).collect()  # a bounded number of patterns
    rows = sorted((r["kind"], tuple(r["votes"]), r["long"], r["digits"], r["n"]) for r in table_)
    by_votes: dict[tuple[int, ...], float] = {}
    for _, v, _, _, n in rows:
        by_votes[v] = by_votes.get(v, 0) + n
    patterns = sorted(by_votes.items())
    p, rates = em(patterns)
    label = {v: q for (v, _), q in zip(patterns, p)}
    return Model(fit_classifier([(_features(k, v, a, d), n, label[v]) for k, v, a, d, n in rows]), rates)


def find_private(docs: DataFrame, model: Model | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base, added, spans): arrays of (kind, start, end); ``spans`` holds base ones by kind, then
    the added ones by kind and start."""
    found = candidates(base_spans(docs, key, text), key)
    model = model or train(found)
    bare = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    chosen = F.filter("candidates", lambda s: F.exists(s["votes"], lambda v: v == 1) & (model.probability(s) >= CUT))
    added = F.array_sort(F.array_distinct(F.transform(chosen, bare)))
    return found.select(key, "base", added.alias("added")).withColumn("spans", F.concat("base", "added"))


def op1_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_private(table(spark, sf_dir, "documents", "doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *[count(k) for k in BASE], F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"))
