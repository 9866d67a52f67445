import pytest

from tessera.llm import repeats


def brute(docs):
    """(n_bytes, removed, kept) by a table of all 100-byte strings."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            s = data[p : p + 100]
            if s in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(s)
        spans, p = [], 0
        while p < len(data):
            e = p
            while e < len(data) and gone[e]:
                e += 1
            if e > p:
                spans.append((p, e))
            p = max(e, p + 1)
        out[i] = (len(data), spans, bytes(x for x, g in zip(data, gone) if not g))
    return out


def result(df):
    return {r.doc_id: (r.n_bytes, [tuple(s) for s in r.removed], bytes(r.kept)) for r in df.collect()}


@pytest.fixture
def docs(rng):
    vocab = ["the", "of", "and", "aab", "bba", "éau", "x", ""] + ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    pool = [text(rng.randint(10, 60)) for _ in range(12)]
    out = []
    for i in range(200):
        t = " ".join(rng.choice(pool) if rng.random() < 0.5 else text(rng.randint(1, 40)) for _ in range(rng.randint(0, 5)))
        if rng.random() < 0.2 and t:
            k = rng.randrange(len(t))
            t = t[:k] + "#" + t[k + 1 :]
        out.append((i, t[rng.randrange(len(t) + 1) :] if rng.random() < 0.1 else t))
    return out + [(200, ""), (201, "a" * 1000), (202, "ab" * 400), (203, "a" * 99), (204, "b" * 100), (205, "b" * 100), (206, out[0][1]), (207, "Und " * 300)]


@pytest.mark.parametrize("partitions", ["3", "40"])
def test_equals_brute_force(spark, docs, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = result(repeats.remove_repeats(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute(docs)


def test_hot_passage_and_shuffled_texts(spark, rng, monkeypatch):
    """A passage in every document is spread over many partitions by the sort."""
    monkeypatch.setattr(repeats, "MAX_BROADCAST_KEYS", 0)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(150))
    docs = [(i, f"{rng.random()} {passage} {rng.random()}") for i in range(150)]
    assert result(repeats.remove_repeats(spark.createDataFrame(docs, "doc_id int, text string"))) == brute(docs)


def test_repeated_and_null_ids(spark, no_docs):
    a, b = "x" * 60 + "y" * 70, "z" * 130
    rows = repeats.remove_repeats(spark.createDataFrame([(None, b), (1, a), (1, a), (2, a), (3, None), (3, b)], "doc_id bigint, text string")).collect()
    got = sorted((str(r.doc_id), r.n_bytes, sum(s.end - s.start for s in r.removed)) for r in rows)
    # null comes first; equal rows are one document; the id with two texts stands for two documents
    own = brute([(0, b)])[0][1]
    removed_b = sum(e - s for s, e in own)
    assert got == [("1", 130, 0), ("1", 130, 0), ("2", 130, 130), ("3", 0, 0), ("3", 130, 130), ("None", 130, removed_b)]
    assert repeats.remove_repeats(no_docs).count() == 0


def test_odd_texts(odd_docs, odd_texts):
    rows = repeats.remove_repeats(odd_docs).collect()
    want = brute([(-1, "no id"), *enumerate(odd_texts)])
    assert len(rows) == len(odd_texts) + 2
    assert all((r.n_bytes, [tuple(s) for s in r.removed], bytes(r.kept)) == want[-1 if r.doc_id is None else r.doc_id] for r in rows)
