import hashlib
import re
import zlib

import numpy as np
import pytest

from tessera.llm.runs import WaveletMatrix, Words, digest, find_runs, op11_runs, planted, texts_runs


def brute_runs(w):
    """All runs by extending every (start, period) that can't be extended to the left."""
    found = {}
    n = len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)  # smaller periods come first
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def collapse(w, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def expected(doc_id, text):
    w = words_of(text)
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(w)
    best = max(((length, -s, -q) for s, length, q in runs), default=None)
    top = (-best[1], best[0], -best[2], 1000 * best[0] // -best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapse(w, runs)))


def found(texts):
    counts, runs, collapsed = texts_runs([t.encode() for t in texts])
    return [(n, [(r["start"], r["length"], r["period"]) for r in rs], c.decode()) for n, rs, c in zip(counts, runs, collapsed, strict=True)]


def same_as_brute(texts):
    for text, (n, runs, collapsed) in zip(texts, found(texts), strict=True):
        w = words_of(text)
        want = brute_runs(w)
        assert (n, runs, collapsed) == (len(w), want, collapse(w, want)), text


def test_random_small_alphabets(rng):
    texts = [" ".join(rng.choices("abcd"[: rng.randint(1, 4)], k=rng.randint(0, 90))) for _ in range(3000)]
    same_as_brute(texts)


def test_nested_periods(rng):
    """Powers of words that themselves hold powers, with a change here and there."""
    texts = []
    for _ in range(1500):
        w = rng.choices("ab", k=rng.randint(1, 3))
        for _ in range(rng.randint(1, 4)):
            w = w * rng.randint(1, 6) + rng.choices("abc", k=rng.randint(0, 2))
            if len(w) > 600:
                break
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = rng.choice("abc")
        texts.append(" ".join(w[:700]))
    same_as_brute(texts)


def test_all_binary_words():
    same_as_brute([" ".join(format(x, "b")) for x in range(1 << 14)])


def test_long_powers(rng):
    block = rng.choices([f"w{i}" for i in range(5)], k=301)
    texts = [" ".join(block * 7), " ".join((["x"] * 60 + ["y"]) * 9), "one " * 5000, " ".join((block + ["x"] * 300) * 4 + block), "same " * 5, "same " * 6]
    same_as_brute(texts)


def test_equal_texts_do_not_meet(rng):
    text = " ".join(rng.choices("abc", k=50))
    same_as_brute([text] * 20 + ["", " "])


def test_wavelet_matrix(rng):
    v = np.array(rng.choices(range(100), k=500))
    tree = WaveletMatrix(v, 7)
    lo = np.array([rng.randint(0, 499) for _ in range(300)])
    hi = np.array([rng.randint(a + 1, 500) for a in lo])
    x = np.array([rng.randint(0, 140) for _ in lo])
    assert tree.below(lo, hi, x).tolist() == [int((v[a:b] < c).sum()) for a, b, c in zip(lo, hi, x, strict=True)]
    rank = np.array([rng.randrange(b - a) for a, b in zip(lo, hi, strict=True)])
    assert tree.smallest(lo, hi, rank).tolist() == [int(np.sort(v[a:b])[r]) for a, b, r in zip(lo, hi, rank, strict=True)]


def test_suffix_array(rng):
    ids = np.array(rng.choices(range(3), k=200))
    texts = np.sort(np.array(rng.choices(range(4), k=200)))
    w = Words(ids, texts)
    suffix = lambda i: (texts[i], ids[i:][texts[i:] == texts[i]].tolist())
    assert w.order.tolist() == sorted(range(200), key=suffix)


@pytest.mark.parametrize("limit", [1, 200_000])
def test_rows_and_groups(spark, odd_docs, limit):
    rows = odd_docs.collect()
    got = digest(find_runs(planted(odd_docs), limit=limit)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((expected(r.doc_id, r.text) for r in rows), key=str)


def test_empty_table(no_docs):
    assert digest(find_runs(planted(no_docs))).collect() == []


def test_query_equals_brute_force(spark, sf_dir, corpus):
    got = op11_runs(spark, sf_dir).collect()
    assert {tuple(r) for r in got} == {expected(k, t) for k, t in corpus.items()} and len(got) == len(corpus)
    assert sum(r.n_runs > 0 for r in got) >= len(got) // 20
    assert dict(op11_runs(spark, sf_dir).dtypes)["exponent_milli"] == "bigint"
