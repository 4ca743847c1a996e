import numpy as np
import public_tokenizers

import corpus_pipeline as P
from halyard.llm import decontaminate as D
from halyard.llm import order_minhash as O


def test_stages_on_edges(spark, make_docs, edge_rows, empty_docs, sf):
    for docs in (make_docs(edge_rows), empty_docs):
        columns = docs.columns
        for name, stage in P.STAGES:
            out = stage(spark, docs, sf)
            if name != P.STAGES[-1][0]:
                assert out.columns == columns
                docs = out
        assert out.columns == ["doc_id", "n_tokens", "ids", "exact"]
        out.collect()


def test_decisions_take_effect(spark, sf, tmp_path):
    before = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        stage(spark, before, sf).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert 0 < after.count() < before.count() or name == "language_id"
        before = after
    classes = O.near_duplicate_classes(spark, before)
    assert classes.select("class_key").distinct().count() == before.count()
    assert D.find(spark, before, spark.read.parquet(f"{sf}/benchmark.parquet")).count() == 0
    rows = P.run(spark, sf).collect()
    assert len(rows) == before.count() and all(r["exact"] and len(r["ids"]) == 4 * r["n_tokens"] for r in rows)
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    import tiktoken
    from halyard.llm import tree_bpe
    ranks = tree_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    oracle = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in rows[:30]:
        assert np.frombuffer(r["ids"], "<u4").tolist() == oracle.encode_ordinary(texts[r["doc_id"]])
