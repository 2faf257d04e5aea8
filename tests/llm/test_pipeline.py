"""The pipeline and the registered queries on the smallest tables."""

import os

import corpus_pipeline
from mention_pulse.llm import common, pieces, pii, quality_rules, queries, simhash

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_pipeline_is_its_stages(spark):
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    docs = common.documents(spark, SF)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {r["doc_id"] for r in quality_rules.quality_rules(docs).filter("kept").collect()}
    rows = docs.filter(docs["doc_id"].isin(sorted(good)))
    one = {r["component_id"] for r in simhash.near_duplicates(rows).collect()}
    items = [r["text"].lower() for r in common.documents(spark, SF, "benchmark").collect()]
    leaked = {i for i in one if any(x in texts[i].lower() for x in items)}
    assert set(got) == one - leaked and len(got) < len(texts)
    for i, r in got.items():
        plain = pii.masked(texts[i], pii.base_spans(texts[i]))
        assert r["decoded"] == plain and r["ids"] == pieces.model(queries.public_tokenizers.path(queries.PIECE_BPE)).encode(plain)


def test_queries_have_whole_tables(spark):
    n = common.documents(spark, SF).count()
    for name, query in queries.queries().items():
        if name.split("_")[0] in ("op3", "op4", "op5", "op7", "op9"):
            assert query(spark, SF).count() == n, name
    conversations = common.documents(spark, SF, "conversations").select("conv_id").distinct().count()
    assert queries.queries()["op10_chat_format"](spark, SF).count() == conversations + 1
