import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Row

from tessera.llm import phrases
from tessera.llm.phrases import collocations, op13_phrases, phrase_counts, pieces, segments
from tessera.llm.scratch import Scratch

LOWER = {c: c + 32 for c in range(65, 91)}
KINDS = "lang string, text string"


def grams(rows):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                counts.update((lang, tuple(words[i : i + n])) for i in range(len(words) - n + 1))
    return counts, totals


def brute(rows, support, top):
    counts, totals = grams(rows)
    many = {k: a for k, a in counts.items() if a >= support and len(k[1]) > 1}
    out = defaultdict(list)
    for (lang, p), a in many.items():
        if any(
            x == lang and len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            for (x, q), b in many.items()
        ):
            continue
        cuts = [(counts[lang, p[:k]], counts[lang, p[k:]], k) for k in range(1, len(p))]
        score, k, left, right = min((2000000 * a // (x + y), k, x, y) for x, y, k in cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return {
        (lang, r, p.decode(), -a, x, y, totals[lang], -s)
        for lang, found in out.items()
        for r, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1)
    }


def made(rng, n=300):
    words = ["of", "the", "The", "new", "york", "in\tthe", "a", "b  c", "é", "Σ", "x.y", "one,", "two!", "z\n", "\x0b", "é𝒳"]
    return [(rng.choice(["en", "fr", None, "und"]), " ".join(rng.choices(words, k=rng.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize(("support", "top", "sizes", "bits"), [
    (30, 2000, (64_000, 2_000_000), 64), (4, 25, (64_000, 2_000_000), 64), (4, 2000, (37, 300), 64), (4, 2000, (200, 2000), 9),
])
def test_equals_brute_force(spark, rng, support, top, sizes, bits):
    """With fingerprints of nine bits nearly everything collides; counting by the texts keeps the result right."""
    rows = made(rng)
    rows += rows[:50]
    got = collocations(spark.createDataFrame(rows, KINDS).repartition(3), support, top=top, sizes=sizes, bits=bits).collect()
    want = brute(rows, support, top)
    assert len(want) > 20 and {tuple(r) for r in got} == want and len(got) == len(want)


def test_all_langs_one_hot(spark, rng):
    rows = [("en", t) for _, t in made(rng, 200)]
    assert {tuple(r) for r in collocations(spark.createDataFrame(rows, KINDS), 5).collect()} == brute(rows, 5, 2000)


def test_long_texts_are_cut_between_words():
    text = ("alpha beta " * 50 + "gamma" * 30 + " delta. ").encode()
    cut = list(segments([text, b"", b"x"], ["en", "en", "fr"], [1, 2, 3], 40))
    assert b"".join(s.text[: s.own] for s in cut) == text + b"x" and len(cut) > 10 and len({s.at for s in cut}) == len(cut)
    assert all(len(s.text) <= 40 + 200 for s in cut)
    assert [s for p in pieces(iter(cut), 100) for s in p] == cut


def test_odd_rows(spark, odd_docs, no_docs):
    assert collocations(no_docs.selectExpr("text", "'en' AS lang")).collect() == []
    docs = odd_docs.selectExpr("*", "cast(null as string) AS lang", "1 AS phrase", "2 AS n")
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert {tuple(r) for r in collocations(docs).collect()} == brute(rows, 30, 2000)


def test_large_counts_are_exact(spark):
    """Products past 64 bits: the score's expression on made counts."""
    df = spark.createDataFrame([Row(a=9_000_000_000_000_000, l=9_000_000_000_000_001, r=9_000_000_000_000_007)])
    assert df.selectExpr(phrases.EXACT_SCORE).first()[0] == 2000000 * 9_000_000_000_000_000 // 18_000_000_000_000_008


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text").collect()]
    assert {tuple(r) for r in op13_phrases(spark, sf_dir).collect()} == brute(rows, 30, 2000)


def test_only_frequent_phrases_become_text(spark, rng):
    rows = [(lang or "und", t) for lang, t in made(rng, 100)]
    docs = spark.createDataFrame(rows, KINDS).selectExpr("text", "lang", "xxhash64(text) AS key")
    got = phrase_counts(docs, Scratch(spark, "phrases"), 20).collect()
    assert {(r.lang, r.phrase): r.n for r in got} == {(k, " ".join(p)): a for (k, p), a in grams(rows)[0].items() if a >= 20}
