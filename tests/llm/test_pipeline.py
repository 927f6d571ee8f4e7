import __spark_entry__
import corpus_pipeline
from curvelab.llm import decontamination, minhash, quality, toxicity
from curvelab.llm.pieces import pieces, vocabulary_path

OPS = {f"op{n}_" for n in range(1, 14)}


def test_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(op) for n in names) for op in OPS)
    assert set(__spark_entry__.EXTRA_ORACLES) <= names


def test_stages_by_hand(spark, table, small):
    """Each stage's decision taken again, one document at a time, from the operators' scores and links."""
    docs, labels, items = table("documents"), table("labels"), table("benchmark")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = docs
    results = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, small)
        assert out.schema.names == docs.columns
        rows = out.collect()
        assert all(texts[r["doc_id"]] == r["text"] for r in rows)
        results.append((name, kept, {r["doc_id"] for r in rows}))
        kept = spark.createDataFrame(rows, docs.schema)
    (_, d, a), (_, e, b), (_, f, c), (_, g, clean) = results
    assert a == {r["doc_id"] for r in toxicity.score(d, toxicity.train(d, labels)).collect() if r["score"] < 0.5}
    assert b == {r["doc_id"] for r in quality.score(e, quality.train(e, labels)).collect() if r["score"] >= 0.7}
    assert c == {r["doc_id"] for r in minhash.near_duplicates(f).collect() if r["kept"]}
    assert clean == c - {r["doc_id"] for r in decontamination.find_passages(g, items).collect()}
    assert len(clean) < len(c) < len(b) <= len(a) <= len(texts)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, small).collect()
    library = pieces(vocabulary_path("word_bpe_49k.json")).library
    for doc in clean:
        n = len(library.encode(texts[doc], add_special_tokens=False).ids) + 1
        assert sum(r["length"] for r in packed if r["doc_id"] == doc) == n
    assert {r["doc_id"] for r in packed} == clean


def test_run_is_the_stages(spark, small):
    got = corpus_pipeline.run(spark, small)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(got.columns) and got.count() > 0


def test_stages_on_edge_documents(spark, edge_docs, small):
    docs = edge_docs.selectExpr("doc_id", "text", "lang", "part AS source", "n AS n_chars")
    for some in (docs, docs.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, some, small)
            assert out.count() >= 0
            some = out if set(docs.columns) <= set(out.columns) else some
