import re

from tessera.llm import decontaminate

UP = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= ids
        out[doc] = (len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w))
    return out


def result(df):
    return {r.doc_id: (r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in df.collect()}


def test_hits_equal_brute_force(spark, rng):
    vocab = ["a", "B", "c", "É", "é", "Σ", "x1", "ς"]
    text = lambda n: rng.choice([" ", ", "]).join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 6, 12, 13, 14, 20]))) for i in range(12)] + [(90, None), (91, ""), (0, "a B")]
    docs = []
    for i in range(200):
        t = text(rng.randint(0, 40))
        if i % 3 == 0:
            t += " - " + (items[i % 12][1] or "") + " " + text(3)
        docs.append((i, t))
    docs.append((500, None))
    got = result(decontaminate.judge(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string")))
    assert got == brute(docs, items)


def test_shuffled_grams_give_the_same(spark, corpus, monkeypatch):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = spark.createDataFrame(list(corpus.items()), "doc_id bigint, text string")
    want = brute(corpus.items(), [(r.item_id, r.text) for r in items.collect()])
    assert result(decontaminate.judge(docs, items)) == want
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_GRAMS", 0)
    assert result(decontaminate.judge(docs, items)) == want


def test_any_size_of_benchmark(spark, rng, odd_docs, odd_texts, no_docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_GRAMS", 0)
    test_hits_equal_brute_force(spark, rng)
    test_drop_and_edge_cases(spark, odd_docs, no_docs, odd_texts)


def test_whole_texts_are_not_shuffled_by_hash(spark, monkeypatch, capsys):
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_GRAMS", 0)
    monkeypatch.setattr(decontaminate, "cut_lineage", lambda df: df.explain() or df)
    docs = spark.createDataFrame([(1, "a b c " * 9)], "doc_id int, text string")
    items = spark.createDataFrame([(1, "b c a b")], "item_id int, text string")
    decontaminate.find_hits(docs, items)
    lines = capsys.readouterr().out.split("\n")
    by_hash = [k for k, x in enumerate(lines) if "Exchange hashpartitioning(hash#" in x]
    assert by_hash
    for k in by_hash:  # what is projected below the exchange: keys, size, hash and place
        below = next(x for x in lines[k + 1 :] if "Project [" in x or "HashAggregate(keys=[" in x)
        assert " w#" not in below and "text#" not in below.split(" AS ")[0]


def test_a_window_of_many_items_counts_for_each(spark, monkeypatch):
    items = spark.createDataFrame([(k, "x y z") for k in range(300)], "item_id int, text string")
    docs = spark.createDataFrame([(1, "x y z " * 40), (2, "clean")], "doc_id int, text string")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert result(decontaminate.judge(docs, items)) == want
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_GRAMS", 599)  # 300 items, two grams each
    assert result(decontaminate.judge(docs, items)) == want


def test_drop_and_edge_cases(spark, odd_docs, no_docs, odd_texts):
    items = spark.createDataFrame([(1, "same text here"), (2, None), (3, "--")], "item_id int, text string")
    got = result(decontaminate.judge(odd_docs, items))
    assert got[7] == got[8] == (3, 3, ["1"], True) and got[None][1] == 0
    clean = decontaminate.drop_contaminated(odd_docs, items)
    assert clean.columns == odd_docs.columns
    assert sorted(r.doc_id for r in clean.collect() if r.doc_id is not None) == [i for i in range(len(odd_texts)) if i not in (7, 8)]
    assert decontaminate.judge(no_docs, items).count() == 0
    none = spark.createDataFrame([], "item_id int, text string")
    assert decontaminate.drop_contaminated(odd_docs, none).count() == odd_docs.count()
