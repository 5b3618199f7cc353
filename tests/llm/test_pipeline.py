"""The pipeline's stages against plain computations on a small table."""

from pyspark.sql import functions as F

import corpus_pipeline
from streammart.llm import toxicity
from streammart.llm.common import stored, table
from tests.llm import plain

FOLDER = "/root/testdata/sf0.001"


def test_stages_chain(spark):
    docs = table(spark, FOLDER, "documents")
    names = docs.columns
    model = toxicity.train(docs, table(spark, FOLDER, "labels"))
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stored(stage(spark, docs, FOLDER), name)
        assert docs.columns == names
        after = docs.collect()
        if name == "toxicity":
            scores = model.scores([r.text for r in before])
            assert sorted(after) == sorted(r for r, s in zip(before, scores) if s < 0.5)
        if name == "exact_dedup":
            keep = {k for k, _ in plain.exact_groups([(r.doc_id, r.text) for r in before]).values()}
            assert sorted(r.doc_id for r in after) == sorted(keep)
        if name == "near_dedup":
            assert {r.doc_id for r in after} == set(plain.near_components({r.doc_id: r.text for r in before}).values())
        if name == "mixing":
            total = sum(len(r.text.split()) for r in before)
            assert abs(sum(len(r.text.split()) for r in after) - total) <= len({r.source for r in before})
        before = after
    out = corpus_pipeline.STAGES[4][1](spark, docs, FOLDER).collect()
    assert sorted(r.decoded_sha256 for r in out) == sorted(plain.sha(r.text.encode()) for r in before)


def test_stages_on_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row_id string, score string"
    rows = [(None, None, None, None, None, "r", "s"), (1, "", "en", "a", 0, "r", "s"), (2, "x y", "en", "a", 3, "r", "s")]
    for data in ([], rows, rows + rows):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, FOLDER), name)
            if name == "byte_bpe":
                docs.collect()
            else:
                assert docs.columns == schema.replace(" long", "").replace(" string", "").split(", ")


def test_row_names_outlast_another_packing(spark, tmp_path):
    """A scan cut into other tasks gives the same rows the same names, so that a second scan joins to the first."""
    path = str(tmp_path / "docs")
    table(spark, FOLDER, "documents").repartition(5, "doc_id").write.parquet(path)
    named, name = [], "spark.sql.files.minPartitionNum"
    try:
        for cuts in ("1", "40"):
            spark.conf.set(name, cuts)
            named.append({r.doc_id: r[corpus_pipeline.ROW] for r in corpus_pipeline.numbered(spark.read.parquet(path)).collect()})
    finally:
        spark.conf.unset(name)
    assert named[0] == named[1]
    assert len(set(named[0].values())) == len(named[0]) == 200
    # Not a plain scan: written first, so that its rows are told apart.
    twice = spark.read.parquet(path).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    assert corpus_pipeline.numbered(twice).select(corpus_pipeline.ROW).distinct().count() == 400
