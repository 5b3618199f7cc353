"""Fits and stages where ids are null or repeated, and columns clash."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from streammart.llm import langid, mixing, toxicity
from streammart.llm.common import free_name
from tests.llm import plain


@pytest.mark.parametrize("doc_id", [0, 1])  # in neither held-out fold
def test_a_repeated_id_is_sampled_by_its_texts(spark, doc_id):
    """Rows that all have one id: the sample takes some of them, not all or none."""
    lang = F.when(F.col("id") % 2 == 0, "en").otherwise("fr")
    docs = spark.range(3000).select(F.lit(doc_id).cast("long").alias("doc_id"), lang.alias("lang"), F.concat(lang, F.lit(" "), "id").alias("text"))
    model = langid.train(docs, 200)
    assert model.languages == ["en", "fr"] and abs(model.weights).sum() > 0
    labels = spark.createDataFrame([(doc_id, 1)], "doc_id long, toxic int")
    assert abs(toxicity.train(docs, labels, 200).weights).sum() > 0


def test_null_ids_are_scored(spark):
    docs = spark.createDataFrame([(None, "one two"), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (3, 1)], "doc_id long, toxic int")
    assert len(toxicity.predictions(spark, docs, labels).collect()) == 2
    assert len(langid.predictions(spark, docs.withColumn("lang", F.lit("en"))).collect()) == 2


def test_the_fit_does_not_depend_on_partitions(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    one, many = toxicity.train(docs.coalesce(1), labels), toxicity.train(docs.repartition(7), labels)
    assert (one.weights == many.weights).all() and one.bias == many.bias


def test_the_label_join_has_one_plan_at_every_size(spark, monkeypatch):
    """However few labels there are, the texts are not joined by a broadcast."""
    plans = []
    real = toxicity.gathered
    monkeypatch.setattr(toxicity, "gathered", lambda rows, rate: plans.append(rows._jdf.queryExecution().executedPlan().toString()) or real(rows, rate))
    folder = "/root/testdata/sf0.001"
    toxicity.train(*(spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels")))
    assert "SortMergeJoin" in plans[0] and "BroadcastHashJoin" not in plans[0]


CLASHES = ["_row_number", "_size", "_taken", "_copy", "size", "taken", "copy", "score", "row_id", "pick"]


def test_stages_keep_clashing_columns(spark):
    rows = [(i, f"some words of text {i % 7} " * (3 + i % 2), "en", "ab"[i % 2], 9) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.concat(F.lit(f"{c} "), "doc_id") for c in CLASHES})
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        got = docs.collect()
        assert got and all(r[c] == f"{c} {r.doc_id}" for r in got for c in CLASHES)


def test_mixing_repeats_rows_whatever_their_columns_are_called(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", "mine")], "doc_id long, text string, source string, size string")
    docs = docs.withColumn("row_id", F.lit(7))
    taken = spark.createDataFrame([(7, 3, 7)], "row_id int, size long, taken long")
    assert sorted(r.text for r in mixing.repeated(docs, taken).collect()) == ["a", "a b c", "a b c"]


def test_free_names():
    assert free_name(["a", "_A"], "a") == "__a" and free_name([], "a") == "a"


def test_near_dedup_at_a_lower_similarity(spark):
    """The stage's threshold is a parameter; at 80 % it agrees with a comparison of all pairs."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for percent in (80, 85):
        kept = corpus_pipeline.drop_near_duplicates(spark, docs, "", percent=percent).collect()
        assert {r.doc_id for r in kept} == set(plain.near_components(texts, percent).values())


def test_bpe_columns_decode_like_lists():
    """Slices, null and empty lists; ids that are null or no ids are errors."""
    import pyarrow as pa
    import pytest

    from streammart.llm import bpe

    coder = bpe.codec(*bpe.multi_50k())
    texts = ["", "ab  cd\n", "漢字🎉", "x" * 500 + "ÿ\xff", "one two"]
    ids = coder.encode(texts)
    column = pa.array([[0], None, *ids, []], pa.list_(pa.int32()))
    assert coder.decode_column(column.slice(1)).to_pylist() == [b"", *[t.encode() for t in texts], b""]
    assert [coder.decode(i) for i in ids] == [t.encode() for t in texts]
    for bad in (None, -1, 10**6):
        with pytest.raises((KeyError, pa.ArrowInvalid, IndexError)):
            coder.decode_column(pa.array([[bad]], pa.list_(pa.int32())))


def test_bpe_round_trip_takes_one_worker_a_task(spark):
    """One Python step, with the rows and columns of ``decode`` after ``encode``; two would double the vocabularies in memory."""
    from streammart.llm import bpe

    schema = "doc_id long, ids string, text string, Decoded_bytes string, lang string, starts string"
    texts = ["", None, "ab  cd\n", "漢字🎉 Ωß", "x" * 3000, " \t", "one two", "one two"]
    docs = spark.createDataFrame([(i if i % 3 else None, "a", t, "b", None, "c") for i, t in enumerate(texts)], schema)
    ranks, pattern = bpe.multi_50k()
    for rows in (docs, docs.limit(0)):
        done = bpe.round_trip(rows)
        assert done._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
        chained = bpe.decode(bpe.encode(rows, ranks, pattern, keep_text=False), ranks, pattern, as_text=False)
        assert done.schema == chained.schema
        assert sorted(map(str, done.collect())) == sorted(map(str, chained.collect()))
    coded = bpe.round_trip(docs).collect()
    assert sorted(bytes(r.decoded_bytes) for r in coded) == sorted((t or "").encode() for t in texts)


def test_slices_give_back_unused_memory(monkeypatch):
    import pyarrow as pa

    from streammart.llm import bpe
    from streammart.llm.common import slices

    calls = []

    class Pool:
        def release_unused(self):
            calls.append(1)

    batches = [pa.RecordBatch.from_arrays([pa.array(list("abcde"))], ["t"])] * 2
    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    assert [b.num_rows for b in slices(batches, 3)] == [3, 2, 3, 2] and len(calls) == 1
    assert [b.num_rows for b in bpe._rows(batches, "t")] == [5, 5] and len(calls) == 2


def test_fingerprints_of_equal_rows_are_dealt_over_tasks(spark):
    """Many rows of two ids: several partitions hold them, and each is compared with what follows it in the order."""
    from pyspark.sql import functions as F

    from streammart.llm import fingerprints

    texts = {0: "first text of the two, somewhat long", 1: "and the second one, which is other", 2: "a lone text"}
    many = spark.range(0, 6000, numPartitions=4).select((F.col("id") % 2).alias("doc_id"))
    text = F.when(F.col("doc_id") == 0, texts[0]).otherwise(texts[1])
    docs = many.withColumn("text", text).union(spark.createDataFrame([(2, texts[2])], "doc_id long, text string"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        placed = fingerprints.neighbours(docs)
        sizes = [r["count"] for r in placed.filter("not ghost").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(sizes) == 6001 and len(sizes) == 8 and max(sizes) < 1500
    rows = fingerprints.digests(spark, docs).groupBy("doc_id", "edited_sha256", "near_next").count().collect()

    def expected(doc_id, following):
        return plain.sha(fingerprints.edited(texts[doc_id], texts[following]).encode())

    counts = {(r.doc_id, r.edited_sha256): r["count"] for r in rows}
    assert counts == {(2, expected(2, 1)): 1, (1, expected(1, 1)): 2999, (1, expected(1, 0)): 1, (0, expected(0, 0)): 2999, (0, expected(0, 2)): 1}
