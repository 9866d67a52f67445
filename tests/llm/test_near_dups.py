import re

import numpy as np
import pytest

from tessera.llm import near_dups

UP = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs):
    sets = {i: shingles(t) for i, t in docs}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 85 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


@pytest.fixture
def family(rng):
    """Edited copies of one text without the text itself, so that no leader reaches them all, and others."""
    vocab = [f"w{i}" for i in range(500)]
    base = [rng.choice(vocab) for _ in range(150)]
    docs = []
    for i in range(160):
        t = list(base)
        for _ in range(rng.randint(0, 5)):
            t[rng.randrange(len(t))] = rng.choice(vocab)
        docs.append((1000 - i, rng.choice([" ", "\n "]).join(t)))
    docs += [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    return docs + [(2000, docs[0][1].upper()), (2001, "one two"), (2002, "ONE  two"), (2003, "one two three"), (2004, ""), (2005, None)]


@pytest.mark.parametrize("small", [24, 3])
def test_components_equal_brute_force(spark, family, monkeypatch, small):
    monkeypatch.setattr(near_dups, "SMALL", small)
    monkeypatch.setattr(near_dups, "BLOCK", 32)
    monkeypatch.setattr(near_dups, "REST_WORK", 50_000_000 if small == 24 else 1000)  # with and without more leader rounds
    if small == 3:
        monkeypatch.setattr(near_dups, "MAX_BROADCAST_IDS", 0)
        monkeypatch.setattr(near_dups, "PART", 4)  # large buckets meet their row in parts
    docs = spark.createDataFrame(family, "doc_id bigint, text string").repartition(3)
    assert result(near_dups.near_duplicates(docs)) == brute(family)


def test_whole_corpus(spark, corpus):
    docs = spark.createDataFrame(list(corpus.items()), "doc_id bigint, text string")
    assert result(near_dups.near_duplicates(docs)) == brute(corpus.items())


def test_sketches_merge_and_estimate(rng):
    gen = np.random.default_rng(3)
    a, b = (gen.integers(0, 1 << 63, 800, dtype=np.uint64) for _ in range(2))
    both = np.unique(np.concatenate([a, b]))
    assert (np.maximum(near_dups.registers(a), near_dups.registers(b)) == near_dups.registers(both)).all()
    close = np.concatenate([a[:780], b[:20]])
    pair = [near_dups.registers(x)[None, :] for x in (a, close, b)]
    size = np.array([800.0])
    assert not near_dups.unlikely(pair[0], pair[1], size, size)[0]
    assert near_dups.unlikely(pair[0], pair[2], size, size)[0]


def test_shingle_hashes_are_distinct_where_shingles_are(corpus):
    texts = list(corpus.values())
    got = near_dups.Shingler().sets([t.encode() for t in texts])
    assert [len(s) for s in got] == [len(shingles(t)) for t in texts]


def test_long_texts_are_hashed_in_pieces(monkeypatch, rng):
    texts = [" \n".join(f"W{rng.randint(0, 30)}" for _ in range(n)) for n in (0, 1, 3, 4, 5, 6, 40, 700)]
    texts += ["x" * 500, "  " + "y" * 300 + " \t z  ", " " * 400, "a b " + "q" * 200 + " c d e f"]
    whole = near_dups.Shingler().sets([t.encode() for t in texts])
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(near_dups, "BATCH_BYTES", size)
        pieces = list(near_dups.Shingler().each([t.encode() for t in texts]))
        assert [p.tolist() for p in pieces] == [w.tolist() for w in whole]


def test_edge_cases(odd_docs, no_docs, odd_texts):
    rows = near_dups.near_duplicates(odd_docs).collect()
    want = brute(enumerate(odd_texts))
    assert len(rows) == len(odd_texts) + 2
    assert all((r.n_shingles, r.component_id, r.kept) == want[r.doc_id] for r in rows if r.doc_id is not None)
    kept = near_dups.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and near_dups.keep_one(no_docs).count() == 0


def test_keep_one_rows(spark, odd_docs, odd_texts):
    """Exactly one row of each group, whatever its ids are."""
    rows = [tuple(r) for r in near_dups.keep_one(odd_docs).collect()]
    want = {i for i, (_, _, stays) in brute(enumerate(odd_texts)).items() if stays}
    assert sorted(r[0] for r in rows if r[0] is not None) == sorted(want)
    assert [r[1] for r in rows if r[0] is None] == ["no id"]

    long = [" ".join(f"{c}{i}" for i in range(80)) for c in "abcde"]
    near = [f"{t} end" for t in long]
    docs = [
        (1, long[0], "x"), (1, long[0], "x"), (1, long[0], "y"), (2, near[0], "x"),  # a source loaded twice
        (3, long[1], "x"), (3, near[1], "x"), (3, long[2], "x"),  # one id: two near copies and another text
        (0, near[3], "x"), (5, long[3], "x"), (5, "a text of its own", "x"),  # kept for its other text only
        (None, long[4], "x"), (None, near[4], "x"), (None, long[4], "x"),  # all ids null
        (None, near[0], "x"), (None, long[3], "x"),  # null ids, near copies of texts with ids
        (7, " ", "x"), (7, " ", "x"), (7, " ", "y"), (None, None, "x"), (None, None, "x"), (None, "", "x"),  # no words
    ]
    kept = [tuple(r) for r in near_dups.keep_one(spark.createDataFrame(docs, "doc_id bigint, text string, source string").repartition(4)).collect()]
    sure = [(1, long[0], "x"), (3, long[2], "x"), (0, near[3], "x"), (5, "a text of its own", "x"), (7, " ", "x"), (7, " ", "y"), (None, None, "x"), (None, "", "x")]
    left = list(kept)
    for r in sure:
        left.remove(r)
    assert sorted((r[0] or 0) for r in left) == [0, 3]
    assert {r[1] for r in left if r[0] == 3} < {long[1], near[1]} and {r[1] for r in left if r[0] is None} < {long[4], near[4]}
    again = near_dups.keep_one(spark.createDataFrame(docs[::-1], "doc_id bigint, text string, source string").repartition(2)).collect()
    assert sorted(map(repr, kept)) == sorted(repr(tuple(r)) for r in again)


def test_threshold_is_an_argument(spark):
    words = [f"w{i}" for i in range(104)]
    docs = [(1, " ".join(words)), (2, " ".join(words[:50] + ["x", "y"] + words[52:] + [f"v{i}" for i in range(8)]))]
    a, b = (shingles(t) for _, t in docs)
    assert 80 * len(a | b) <= 100 * len(a & b) < 85 * len(a | b)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert near_dups.keep_one(df).count() == 2 and [r.doc_id for r in near_dups.keep_one(df, (80, 100)).collect()] == [1]
    assert [r.kept for r in near_dups.near_duplicates(df, threshold=(80, 100)).orderBy("doc_id").collect()] == [True, False]
