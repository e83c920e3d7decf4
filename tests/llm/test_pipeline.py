import corpus_pipeline as C
from pyspark.sql import functions as F

from quarry.llm import nbsvm, neardup
from quarry.session import cut_lineage
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_neardup import brute as components
from tests.llm.test_packing import whole
from tests.llm.test_scans import brute_lines

FOLDER = "/root/testdata/sf0.001"


def texts_of(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_stages_against_brute_force(spark, small):
    docs = small("documents")
    columns = docs.columns
    labels = {r["doc_id"]: r["quality"] for r in small("labels").collect()}
    kept = cut_lineage(C.quality_classifier(spark, docs, FOLDER))
    assert kept.columns == columns
    scored = {r["doc_id"]: r["predicted"] for r in nbsvm.classify(docs, small("labels")).collect()}
    assert set(texts_of(kept)) == {i for i, p in scored.items() if p == 1}
    good = {i for i, q in labels.items() if q == 1}
    assert len(good & set(texts_of(kept))) >= 0.97 * len(good)

    lined = cut_lineage(C.line_dedup(spark, kept, FOLDER))
    assert lined.columns == columns and texts_of(lined) == brute_lines(texts_of(kept))
    assert lined.where((F.length("text") != F.col("n_chars")) & F.col("text").isNotNull()).count() == \
        kept.where((F.length("text") != F.col("n_chars")) & F.col("text").isNotNull()).count()

    single = cut_lineage(C.near_duplicates(spark, lined, FOLDER))
    assert single.columns == columns
    assert set(texts_of(single)) == {i for i, (_, c) in components(texts_of(lined), C.SHINGLE).items() if i == c}

    clean = cut_lineage(C.benchmark_decontamination(spark, single, FOLDER))
    items = [(r["item_id"], r["text"]) for r in small("benchmark").collect()]
    assert clean.columns == columns
    assert set(texts_of(clean)) == {i for i, v in contaminated(texts_of(single), items).items() if not v[4]}

    packed = C.pack(spark, clean, FOLDER).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in packed} == {i: len(whole(t)) for i, t in texts_of(clean).items()}


def test_names():
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "line_dedup", "near_duplicates", "benchmark_decontamination", "packing"]
    assert neardup.PERCENT == 80 and C.SHINGLE == 5 and C.ORACLE_SQL is None
