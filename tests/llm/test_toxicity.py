import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import toxicity


def brute_marginals(unary, edges):
    """Marginals of tag 1 by enumeration of all tag sequences."""
    n = len(unary)
    total, ones = 0.0, np.zeros(n)
    for code in range(2**n):
        y = [(code >> t) & 1 for t in range(n)]
        score = sum(unary[t] * y[t] for t in range(n)) + sum(edges[y[t], y[t + 1]] for t in range(n - 1))
        total += np.exp(score)
        ones += np.exp(score) * np.array(y)
    return ones / total, np.log(total)


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    edges = rng.normal(size=(2, 2))
    lengths = np.array([1, 4, 7])
    unary = rng.normal(size=(3, 7))
    p, _, logz = toxicity.forward_backward(unary, edges, lengths)
    want = [brute_marginals(unary[k, :n], edges) for k, n in enumerate(lengths)]
    for k, n in enumerate(lengths):
        assert np.allclose(p[k, :n], want[k][0]) and (p[k, n:] == 0).all()
    assert np.isclose(logz, sum(z for _, z in want))


def test_pair_sums_equal_enumeration():
    edges = np.array([[0.3, -0.2], [0.1, 0.8]])
    unary = np.array([[0.5, -1.0, 0.7]])
    _, pairs, _ = toxicity.forward_backward(unary, edges, np.array([3]))
    want, total = np.zeros((2, 2)), 0.0
    for code in range(8):
        y = [(code >> t) & 1 for t in range(3)]
        w = np.exp(sum(unary[0][t] * y[t] for t in range(3)) + edges[y[0], y[1]] + edges[y[1], y[2]])
        total += w
        for t in range(2):
            want[y[t], y[t + 1]] += w
    assert np.allclose(pairs, want / total)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"  # smaller tables hold too few toxic rows to judge by
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.op5_toxicity(spark, folder).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    scored = sorted((r.score, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic)
    pos = sum(y for _, y in scored)
    ranks = sum(i + 1 for i, (_, y) in enumerate(scored) if y)
    assert (ranks - pos * (pos + 1) / 2) / (pos * (len(scored) - pos)) > 0.9


def test_labels_of_held_out_rows_dont_matter(spark):
    docs = spark.createDataFrame([(i, "you idiot fool" if i % 3 == 0 else "fine words here") for i in range(300)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id bigint, toxic int")
    wrong = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.training_rows(docs, x).groupBy("text", "toxic").count().collect() for x in (labels, wrong))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_offsets_and_edge_cases(spark, odd_docs, no_docs, odd_texts):
    texts = [f"{w} Words. You IDIOT! {v} fine day" for w in ("Some", "More", "Other", "New") for v in ("a", "the", "that")] * 4
    train = [(i, t if i % 2 else t.replace("IDIOT", "friend")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, f"{t} {i}") for i, t in train], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(train))] + [(5, None)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    by_id = {i: f"{t} {i}" for i, t in train}
    for r in toxicity.score_texts(docs, model).collect():
        assert [by_id[r.doc_id][s.start : s.end] for s in r.spans] == (["IDIOT"] if r.doc_id % 2 else [])
    rows = toxicity.score_texts(odd_docs, model).collect()
    assert len(rows) == len(odd_texts) + 2 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_texts(no_docs, model).count() == 0
    one_class = toxicity.train(docs, labels.where("toxic = 0"))
    assert {r.score for r in toxicity.score_texts(odd_docs, one_class).collect()} == {one_class["prior"]}


def test_lexicon_keeps_every_word_that_passes(spark):
    words = [f"w{chr(97 + i // 676)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}" for i in range(6000)]
    rows = [(" ".join(words) + f" x{'x' * k}", 1) for k in range(4)] + [(f"clean {'y' * (k + 1)}", 0) for k in range(200)]
    got = {r.word for r in toxicity.lexicon(spark.createDataFrame(rows, "text string, toxic int")).collect()}
    assert got == set(words)


def test_chains_without_features_all_count():
    rng = np.random.default_rng(5)
    edges, unary = rng.normal(size=(2, 2)), rng.normal(size=(3, 6))
    lengths, counts = np.array([6, 2, 4]), np.array([3, 1, 2])
    many = np.repeat(np.arange(3), counts)
    once, each = toxicity.forward_backward(unary, edges, lengths, counts), toxicity.forward_backward(unary[many], edges, lengths[many])
    assert np.allclose(once[1], each[1]) and np.allclose(once[0][many], each[0])
    # lengths alternate, so that a sample of every k-th chain would hold one length only
    texts = ["one two. one two three four five." * 5000, "bad words here. bad day"]
    there, back = (toxicity.fit(t, y, {"bad": 3}) for t, y in ((texts, [0, 1]), ([texts[0][::-1], texts[1]], [0, 1])))
    assert np.allclose(there["weights"], back["weights"]) and np.allclose(there["edges"], back["edges"])


def test_lexicon_and_scorer_cut_words_alike(spark):
    """Quoted words, doubled quotes, digits and numerals: the lexicon's words are those the field looks up."""
    texts = ["he said 'blarg' and ‘blarg’", "rock'n'roll ''x'' it''s a_b c3po x² Ⅷ n’t’", "'", "it's Élan’s"]
    found = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("text", f"regexp_extract_all(lower(text), r\"{toxicity.WORD_SQL}\", 0) AS w")
    assert {r.text: r.w for r in found.collect()} == {t: toxicity.WORD.findall(t.lower()) for t in texts}
    rows = [(f"you 'blarg' {i} there", 1) for i in range(40)] + [(f"hello there {i}", 0) for i in range(400)]
    words = {r.word for r in toxicity.lexicon(spark.createDataFrame(rows, "text string, toxic int")).collect()}
    assert "blarg" in words and "'blarg'" not in words
