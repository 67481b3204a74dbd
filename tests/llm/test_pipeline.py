import hashlib

import corpus_pipeline as cp
from tests.llm.helpers import documents, odd_documents
from tests.llm.test_byte_bpe import library  # noqa: F401
from tests.llm.test_decontaminate_whole import leaks
from tests.llm.test_pipeline_near_copies import kept as representatives
from tests.llm.test_substring_dedup import expected as passages
from tripmill.llm import quality
from tripmill.sources.staging import staged

SF = "/root/testdata/sf0.001"


def test_every_stage_against_brute_force(spark, library):  # noqa: F811
    docs = documents(spark)
    before = docs
    seen = {}
    for name, stage in cp.STAGES:
        after = staged(stage(spark, before, SF), "test")
        if name != "encode":
            assert after.schema.names == docs.schema.names
        seen[name] = before, after
        before = after

    def texts(frame):
        return {r["doc_id"]: r["text"] for r in frame.collect()}

    before, after = seen["quality"]
    assert 0.5 * before.count() < after.count() < before.count()
    before, after = seen["near_copies"]
    want = representatives(before, cp.NEAR_WORDS, cp.NEAR_PERCENT)
    assert texts(after) == {k: v for k, v in texts(before).items() if k in want} and len(want) < before.count()
    before, after = seen["repeated_passages"]
    rows = before.select("doc_id", "text").collect()
    assert texts(after) == {r["doc_id"]: e[0] for r, e in zip(rows, passages([r["text"] for r in rows]))}
    before, after = seen["benchmark"]
    items = texts(documents(spark, table="benchmark").withColumnRenamed("item_id", "doc_id"))
    assert texts(after) == {k: v for k, v in texts(before).items() if not any(leaks(v, b) for b in items.values())}
    before, after = seen["encode"]
    got = {r["doc_id"]: (list(r["ids"]), r["n_tokens"], r["text_sha256"]) for r in after.collect()}
    assert got == {
        k: (ids := library.encode_ordinary(v), len(ids), hashlib.sha256(v.encode()).hexdigest()) for k, v in texts(before).items()
    }


def test_odd_texts_and_empty_tables(spark, tmp_path):
    documents(spark, table="labels").write.parquet(f"{tmp_path}/labels.parquet")
    documents(spark, table="benchmark").write.parquet(f"{tmp_path}/benchmark.parquet")
    for texts in (None, []):
        docs = odd_documents(spark, texts)
        for name, stage in cp.STAGES:
            after = stage(spark, docs, str(tmp_path))
            assert after.count() <= docs.count()
            docs = after if name != "encode" else docs


def test_toxic_documents_go(spark):
    docs = documents(spark, "sf0.1")
    labels = documents(spark, "sf0.1", "labels").select("doc_id", quality.grade().alias("grade"))
    kept = cp.select_quality(spark, docs, "/root/testdata/sf0.1").join(labels, "doc_id").groupBy("grade").count()
    all_of = {r["grade"]: r["count"] for r in labels.join(docs, "doc_id").groupBy("grade").count().collect()}
    share = {r["grade"]: r["count"] / all_of[r["grade"]] for r in kept.collect()}
    assert share[2] > 0.99 and share.get(0, 0) < 0.1 and share.get(1, 0) < 0.1
