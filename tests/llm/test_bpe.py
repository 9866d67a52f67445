from tokenizers import Tokenizer

from tessera.llm import bpe


def library(texts):
    t = Tokenizer.from_file(bpe.default_tokenizer())
    ids = [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]
    return [(x, t.decode(x, skip_special_tokens=False)) for x in ids]


def ours(spark, texts):
    rows = bpe.bpe_encode(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)).collect()
    return [(list(r.ids), r.decoded) for r in sorted(rows, key=lambda r: r.doc_id)]


def test_equals_the_library(spark, corpus, rng, odd_texts):
    texts = ["".join(rng.choice("aabeinrstho.!-é") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    texts += ["a" * n for n in range(120)] + ["!" * n for n in range(60)] + [".-" * n for n in range(60)] + ["ab" * 3000]
    texts += ["<|endoftext|>x<|startoftext|> y", "it's THE dog'll ΑΣ İ", "a\x00b", "½²x", *odd_texts, *corpus.values()]
    assert ours(spark, texts) == library(texts)


def test_every_latin_character(spark):
    texts = [f"a{chr(c)}b {chr(c)}c" for c in range(1, 0x530)]
    assert ours(spark, texts) == library(texts)


def test_speculation_settles_some_words_and_verification_catches_the_rest(rng):
    b = bpe.WordBpe(bpe.default_tokenizer())
    words = sorted({"".join(rng.choice("aeinrstho") for _ in range(rng.randint(1, 12))) for _ in range(3000)})
    flat, counts, exact = b.encode_words(words)
    assert 0 < exact < len(words)
    at = 0
    for w, n in zip(words, counts.tolist()):
        data = w.encode()
        merged = b.merge([*b.first_ids[list(data[:-1])].tolist(), int(b.last_ids[data[-1]])])
        assert flat[at : at + n].tolist() == merged
        at += n


def test_memory_may_be_cleared_at_any_time(spark, corpus, monkeypatch):
    texts = list(corpus.values())
    memory = bpe.Memory(bpe.WordBpe(bpe.default_tokenizer()))
    whole = bpe.encode_texts(memory, texts)[0].tolist()
    monkeypatch.setattr(bpe, "MAX_REMEMBERED", 10)
    pieces = [i for at in range(0, len(texts), 20) for i in bpe.encode_texts(memory, texts[at : at + 20])[0].tolist()]
    assert whole == pieces


def test_empty_table_and_other_columns(no_docs, odd_docs):
    assert bpe.bpe_encode(no_docs).count() == 0
    assert bpe.bpe_encode(odd_docs).columns == ["doc_id", "ids", "decoded"]
