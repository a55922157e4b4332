import helpers
import corpus_pipeline
from lexis.llm import catalog, mixing

SF = "/root/testdata/sf0.001"


def test_registered():
    import __spark_entry__ as E

    names = set(E.queries())
    assert {"pipeline", *catalog.QUERIES} <= names and len(catalog.QUERIES) == 13
    assert set(catalog.ORACLES) <= set(E.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "mixing"]


def test_stages_take_effect(spark, documents, tmp_path):
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = (before.count(), docs.count())
        if name != "mixing":
            assert docs.columns == documents.columns
        if name == "near_dedup":
            own = helpers.components({r.doc_id: r.text for r in before.collect()})
            assert {r.doc_id for r in docs.collect()} == {i for i, (_, c) in own.items() if i == c}
        if name == "decontamination":
            bench = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
            leaked = {d for d, _ in helpers.leaks({r.doc_id: r.text for r in before.collect()}, bench)}
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()} - leaked
        if name == "mixing":
            want = {r.doc_id for r in mixing.mixture(before).where("kept").collect()}
            assert {r.doc_id for r in docs.collect()} == want
    assert seen["quality"][1] < seen["quality"][0] and seen["line_dedup"][0] == seen["line_dedup"][1]
    assert seen["near_dedup"][1] < seen["near_dedup"][0]


def test_empty_documents(spark, documents):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents.limit(0), SF).count() == 0
