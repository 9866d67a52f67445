import re

from tessera.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, covered = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered |= {p + k for p in places for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def counts(rows):
    return {r.doc_id: (*(r._counts[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), r._verdict.base_failed) for r in rows}


def test_counts_equal_brute_force(spark, corpus, rng):
    texts = dict(corpus) | {10_000 + i: "".join(rng.choice(["a", "b", " ", "\n", "\t", "\x0b", "é", "#", "a b c "]) for _ in range(rng.randint(0, 60))) for i in range(400)}
    rows = quality.judge(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()
    got = counts(rows)
    assert got == {i: brute(t) for i, t in texts.items()}
    assert all(not r._verdict.kept for r in rows if r._verdict.base_failed)


def test_clean_documents_stay_and_junk_goes(spark, sf_dir, corpus):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(labels[r.doc_id], r._counts.n_words, r._verdict.kept) for r in quality.judge(docs).collect() if r.doc_id in labels]
    good = [kept for q, n, kept in rows if q == 1 and n >= 50]
    bad = [kept for q, n, kept in rows if q == 0]
    assert sum(good) >= 0.95 * len(good)
    assert sum(bad) <= 0.4 * len(bad)


def test_keep_good_keeps_columns(odd_docs, no_docs):
    kept = quality.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == 0
    assert quality.keep_good(no_docs).count() == 0


def test_edge_cases(odd_docs, odd_texts):
    got = counts(quality.judge(odd_docs.select("doc_id", "text")).collect())
    assert all(got[i] == brute(t) for i, t in enumerate(odd_texts))
