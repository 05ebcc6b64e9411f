import zlib

import corpus_pipeline as cp
import __spark_entry__ as entry
from ludex.llm import setsketch, tokens


def test_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert sum(n.startswith("op") for n in names) == 13


def test_stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in cp.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, sf_small).cache()
        assert docs.columns == columns and docs.count() > 0
        assert {r["doc_id"] for r in docs.collect()} <= {r["doc_id"] for r in before.collect()} <= ids
        if name == "near_dedup":
            assert setsketch.near_duplicates(docs).where("not kept").count() == 0
    encoder = tokens.Encoder(tokens.default_tokenizer())
    want = sorted((r["doc_id"], zlib.crc32(encoder.encode([r["text"] or ""], 2)[0].tobytes()))
                  for r in docs.collect())
    got = sorted((r["doc_id"], r["ids_crc32"]) for r in cp.STAGES[-1][1](spark, docs, sf_small)
                 .collect())
    assert got == want


def test_edges(spark, edge_docs, no_docs, sf_small):
    for docs in (edge_docs, no_docs):
        for _, stage in cp.STAGES[:-1]:
            docs = stage(spark, docs, sf_small).cache()
        assert cp.STAGES[-1][1](spark, docs, sf_small).count() == docs.count()
