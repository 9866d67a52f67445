import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import language
from tessera.llm.language import context_trees, learn, op12_language, predict, share_of, symbols
from tessera.llm.scratch import Scratch

KINDS = "doc_id bigint, text string, lang string"


def folded(text):
    out = bytearray()
    for b in text.encode():
        b = b + 32 if 65 <= b <= 90 else b
        b = b if 97 <= b <= 122 or b >= 128 else 32
        if not (b == 32 and out[-1:] == b" "):
            out.append(b)
    return b"\xff" * 4 + bytes(out)


class Brute:
    """The same code from its definition, with dictionaries."""

    def __init__(self, rows, order=4):
        self.order, self.follow, self.bytes = order, defaultdict(lambda: defaultdict(Counter)), Counter()
        for text, lang in rows:
            s = folded(text)
            for i in range(4, len(s)):
                self.bytes[lang] += 1
                for k in range(order + 1):
                    self.follow[lang][s[i - k : i]][s[i]] += 1
        self.least = {x: n / share_of(len(self.bytes)) for x, n in self.bytes.items()}

    def cost(self, lang, context, byte):
        counts = self.follow[lang].get(context)
        out = 0.0
        if counts and counts.total() >= self.least[lang]:
            whole = counts.total() + len(counts)
            kept = {b: n for b, n in counts.items() if n >= self.least[lang]}
            if byte in kept:
                return -math.log2(kept[byte] / whole)
            out = -math.log2((whole - sum(kept.values())) / whole)
        return out + (self.cost(lang, context[1:], byte) if context else 8)

    def length(self, lang, text):
        s = folded(text)
        return sum(self.cost(lang, s[i - 4 : i], s[i]) for i in range(4, len(s)))


def made(rng, n=120):
    words = {"en": ["the", "of", "thing", "one", "ing"], "fr": ["le", "du", "élan", "ou", "ça"], "de": ["der", "und", "für", "ein"]}
    rows = []
    for k in range(n):
        lang = rng.choice(["en", "en", "fr", "de"])
        rows.append((k, rng.choice([" ", ", ", "  \n"]).join(rng.choices(words[lang], k=rng.randint(1, 30))), lang))
    return rows


@pytest.mark.parametrize("share", [20_000, 60])
def test_code_lengths_equal_the_definition(spark, rng, monkeypatch, share):
    monkeypatch.setattr(language, "share_of", lambda n: share)
    monkeypatch.setitem(globals(), "share_of", lambda n: share)
    rows = made(rng)
    docs = spark.createDataFrame(rows, KINDS).repartition(3)
    model = learn(docs)
    brute = Brute([(t, x) for _, t, x in rows])
    probes = [t for _, t, _ in rows[:20]] + ["The élan, of 12 things!", "zzz ẞ", "a", "\xffÿ", "  x  "]
    got = predict(spark.createDataFrame(list(enumerate(probes)), "doc_id int, text string"), model, "doc_id").collect()
    for r in got:
        want = {x: brute.length(x, probes[r.doc_id]) for x in ("de", "en", "fr")}
        assert r.code_lengths.keys() == want.keys()
        assert all(math.isclose(r.code_lengths[x], want[x], rel_tol=1e-5, abs_tol=1e-4) for x in want)
        assert math.isclose(want[r.lang_pred], min(want.values()), rel_tol=1e-6)
        assert math.isclose(r.score, 1 / sum(2 ** (min(want.values()) - v) for v in want.values()), rel_tol=1e-3)


def test_costs_are_a_code(spark, rng):
    """Behind any context the probabilities of all bytes sum to one at most, in every language."""
    model = learn(spark.createDataFrame(made(rng), KINDS))
    for context in (b"\xff\xff\xff\xff", b" the", b"of t", b"qqqq", b"\xc3\xa9la"):
        grams = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)])
        assert (np.exp2(-model.bits(grams).astype(float)).sum(axis=0) <= 1 + 1e-6).all()


def test_tree_is_bounded_by_the_share(spark, rng, monkeypatch):
    monkeypatch.setattr(language, "share_of", lambda n: 40)
    langs, nodes = context_trees(spark.createDataFrame(made(rng), KINDS).select("text", "lang"), Scratch(spark, "trees"))
    for r in nodes.groupBy("lang", "k").agg(F.count("*").alias("n"), F.sum(F.size("bytes")).alias("m")).collect():
        assert r.n <= 40 and r.m <= 40
    assert langs == ["de", "en", "fr"]


def test_windows_do_not_matter(rng):
    """Long texts are coded in windows: the same grams whatever their size."""
    texts = [t.encode() for _, t, _ in made(rng, 9)] + [b"", b"  "]
    data, text = symbols(texts)
    whole = [np.concatenate(x) for x in zip(*language.windows(data, text), strict=True)]
    cut = [np.concatenate(x) for x in zip(*language.windows(data, text, size=7), strict=True)]
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True))
    assert len(whole[0]) == sum(len(folded(t.decode())) - 4 for t in texts)


def test_held_out_rows_and_other_columns_teach_nothing(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    lied = docs.withColumn("lang", F.when(out, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    lied.write.parquet(f"{tmp_path}/documents.parquet")
    a, b = ({r.doc_id: tuple(r) for r in op12_language(spark, d).collect()} for d in (sf_dir, str(tmp_path)))
    assert a == b


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op12_language(spark, d).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in test) >= 0.99 * len(test)


def test_odd_rows(spark, odd_docs, no_docs, rng, sf_dir):
    model = learn(spark.createDataFrame(made(rng) + [(1, None, "en"), (2, "x", None)], KINDS))
    assert model.langs == ["de", "en", "fr"]
    rows = predict(odd_docs.withColumn("score", F.lit("z")).withColumn("lang_pred", F.lit(1)), model, "doc_id").collect()
    texts = [r.text for r in odd_docs.collect()]
    assert len(rows) == len(texts)
    und = sum(t is None or not any(c.isalpha() for c in t) for t in texts)
    assert sum(r.lang_pred == "und" for r in rows) == und and all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert predict(no_docs, model, "doc_id").collect() == []
    assert learn(no_docs.selectExpr("text", "'en' AS lang")) is None
    assert {(r.lang_pred, r.score) for r in predict(odd_docs, None, "doc_id").collect()} == {("und", 0.0)}
