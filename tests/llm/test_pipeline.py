"""The pipeline, stage by stage, against what each stage must keep."""

import corpus_pipeline
from tests.llm.test_links import linked

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    before, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.materialize(stage(spark, before, DATA), "test")
        assert after.columns == docs.columns
        seen[name] = ({r.doc_id: r.text for r in before.collect()}, {r.doc_id for r in after.collect()})
        before = after
    texts, kept = seen["language ID"]
    assert kept == set(texts)
    texts, kept = seen["quality classifier"]
    assert all((i in kept) == (labels[i] == 1) for i in texts if i in labels)
    texts, kept = seen["MinHash near-dedup"]
    assert kept == {i for i, (_, _, keep) in linked(texts, 5).items() if keep}
    assert len(seen["benchmark decontamination"][1]) < len(seen["benchmark decontamination"][0])
    last = corpus_pipeline.STAGES[-1][1](spark, before, DATA)
    assert last.count() == before.count()


def test_repeated_ids_leave_one_row(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(30)
    twice = docs.union(docs.limit(5))
    out = corpus_pipeline.drop_near_duplicates(spark, twice, DATA)
    assert out.count() == out.select("doc_id").distinct().count()


def odd_documents(spark):
    """Rows of sf0.001, and nulls in every column, empty and very long texts, repeated rows, and columns with clashing names."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    long = " ".join(r.text for r in docs.limit(40).collect())
    odd = [(None, long, "en", "s", 9), (9001, None, "en", "s", 0), (9002, "", None, None, None), (9003, long * 3, None, None, None), (9004, " \n\t ", "xx", "", 3), (None, None, None, None, None)]
    rows = docs.union(docs.limit(3)).union(spark.createDataFrame(odd, docs.schema))
    from pyspark.sql import functions as F

    names = ["evidence", "host", "judged", "place", "dropped_id", "repeated_id", "leak_doc", "component_id", "of_id", "n", "size", "prior", "key", "quality_kept2"]
    return rows.select("*", *(F.lit("mine").alias(c) for c in names)), names


def test_odd_rows_go_through_every_stage(spark):
    docs, names = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.materialize(stage(spark, docs, DATA), "test")
        assert docs.columns == before.columns, name
        assert docs.where(" or ".join(f"{c} is distinct from 'mine'" for c in names)).count() == 0, name
        kept = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "language ID":
            assert not kept & {9001, 9002, 9004} and None in kept and 9003 in kept
        assert 0 < docs.count() <= before.count()
    out = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert out.count() == docs.count()


def test_empty_tables_go_through_every_stage(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, DATA), "test")
        assert docs.count() == 0
