import hashlib

import corpus_pipeline
from tests.llm import test_bpe, test_decontaminate, test_near_dups, test_quality, test_secrets


def test_stages_equal_brute_force(spark, sf_dir):
    """Each stage against its brute-force version, on what its predecessor kept."""
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = df.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near duplicates", "decontamination", "secrets", "bpe"]

    df = stages["quality"](spark, df, sf_dir).checkpoint()
    kept = {r.doc_id for r in df.collect()}
    assert df.columns == columns and kept and not any(test_quality.brute(docs[i].text)[5] for i in kept)

    df = stages["near duplicates"](spark, df, sf_dir).checkpoint()
    want = {i for i, (_, _, stays) in test_near_dups.brute([(i, docs[i].text) for i in kept]).items() if stays}
    assert df.columns == columns and {r.doc_id for r in df.collect()} == want

    df = stages["decontamination"](spark, df, sf_dir).checkpoint()
    bad = test_decontaminate.brute([(i, docs[i].text) for i in want], items)
    want = {i for i in want if not bad[i][3]}
    assert df.columns == columns and {r.doc_id for r in df.collect()} == want

    df = stages["secrets"](spark, df, sf_dir).checkpoint()
    rows = {r.doc_id: r for r in df.collect()}
    assert df.columns == columns and set(rows) == want
    for i, r in rows.items():
        assert r.n_chars == len(r.text) and (r.text == docs[i].text) == (not test_secrets.brute(docs[i].text))
        assert not test_secrets.brute(r.text)

    last = {r.doc_id: r for r in stages["bpe"](spark, df, sf_dir).collect()}
    ids = test_bpe.library([rows[i].text for i in sorted(rows)])
    for i, (x, text) in zip(sorted(rows), ids):
        assert last[i].n_tokens == len(x)
        assert last[i].ids_sha256 == hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest()
        assert last[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_run_writes_and_rereads_every_stage(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < out.count() < spark.read.parquet(f"{sf_dir}/documents.parquet").count()
