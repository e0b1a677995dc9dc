"""Nulls in any column, empty and long texts, repeated rows, empty tables and clashing names, for every operator and stage."""

import pytest
from pyspark.sql import functions as F
from test_text_ops import DOCS

import corpus_pipeline
from quaywatch.llm import collisions, contamination, mixing, ngramjoin, packing, privacy, quality, registry, repeats, secrets, sharding

CLASH = ("row", "rows", "size", "n", "x", "cls", "block", "label", "digest", "shard", "target", "place", "_id", "_key", "_whole", "_time", "start", "end", "run", "kind", "leaf", "depth", "score", "item_id", "text_key", "root", "taken", "passes")
LONG = "long words " * 20_000


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, "a b c d e f g", "en", "s", 13), (1, "a b c d e f g", "en", "s", 13), (1, "other text under one id now", None, None, None), (None, "a b c d e f g", "en", "s", 13), (None, None, None, None, None),
        (None, None, None, None, None), (2, None, "en", "s", 0), (3, "", "en", None, 0), (4, " \n\t", "en", "t", 3), (5, LONG, "en", "t", 1), (6, LONG, "en", "u", 1), (7, "mail a@b.cd token=abcdef12", "en", "u", 1),
    ]
    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in CLASH})


@pytest.fixture(scope="module")
def side(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, None), (5, None, None), (7, 0, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "c d e f g"), (None, "mail"), (3, None), (4, ""), (1, "c d e f g")], "item_id long, text string")
    return labels, bench


def operators(labels, bench):
    return {
        "op1": (sharding.shards, True),
        "op3": (lambda d: contamination.find(d, bench), False),
        "op4": (mixing.decide, True),
        "op5": (repeats.passages, False),
        "op6": (packing.pack, False),
        "op7": (ngramjoin.join, True),
        "op8": (privacy.find, True),
        "op9": (secrets.scan_documents, True),
        "op10": (lambda d: quality.score(d, labels), True),
    }


@pytest.mark.parametrize("name", ["op1", "op3", "op4", "op5", "op6", "op7", "op8", "op9", "op10"])
def test_operator(odd, side, name):
    work, row_for_row = operators(*side)[name]
    got = work(odd).collect()
    if row_for_row:  # a row for each, with its id
        assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in odd.collect())
    if name == "op3":
        assert sorted((str(r.doc_id), str(r.item_id)) for r in got) == [("1", "1")] * 4 + [("None", "1")] * 2
    if name == "op6":
        assert sorted(str(i) for r in got for i, p in zip(r.doc_ids, r.pieces) if p == 0) == sorted(str(r.doc_id) for r in odd.collect())
    if name == "op5":  # of the long text, lines of 32 words of which the first stays, and of its copy all
        rows = sorted((r.doc_id, r.start, r.end, r.n_words, r.kept_doc_id) for r in got)
        assert [r[0] for r in rows] == [5, 6] and rows[1][1:] == (0, len(LONG.rstrip()), 40_000, 5) and rows[0][3] > 39_900
    assert work(odd.where("false")).collect() == []
    void = work(odd.withColumns({c: F.lit(None).cast(t) for c, t in odd.dtypes})).collect()
    if name == "op6":
        assert sum(len(r.doc_ids) for r in void) == odd.count()
    else:
        assert len(void) == {"op3": 0, "op5": 0}.get(name, odd.count())


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES])
def test_stage(spark, odd, side, stage, tmp_path):
    labels, bench = side
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    work = dict(corpus_pipeline.STAGES)[stage]
    got = work(spark, odd, str(tmp_path))
    n = got.count()
    if stage != "shard":
        assert got.columns == odd.columns
    if stage == "near_copies":  # of the linked rows 1, 1, None one; of 5 and 6 one; rows without words stay
        assert sorted(str(r.doc_id) for r in got.collect()) == ["1", "1", "2", "3", "4", "5", "7", "None", "None"]
    if stage == "decontaminate":
        assert n == 9
    if stage == "shard":
        assert n == odd.count()
    assert work(spark, odd.where("false"), str(tmp_path)).count() == 0
    labels.where("false").write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
    bench.where("false").write.mode("overwrite").parquet(f"{tmp_path}/benchmark.parquet")
    if stage in ("quality", "decontaminate"):
        assert work(spark, odd, str(tmp_path)).count() == odd.count()


def test_pipeline_over_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    for name, query in registry.queries().items():
        assert query(spark, str(tmp_path)).count() == 0, name


def test_vectors_of_one_hot_group(spark):
    """A third of all vectors are one vector; blocks are small, links are counted whole."""
    df = spark.range(300).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, F.array(F.lit(1.0), F.lit(2.0))).otherwise(F.array(F.cos("id"), F.sin("id") * 100)).cast("array<float>").alias("embedding"), F.lit(0).alias("label"))
    got = {r.vec_id: r for r in collisions.near_duplicates(df.where("vec_id % 3 = 0"), collisions.Search(block=16)).collect()}
    assert all(r.n_links == 99 and r.component_id == 0 and r.kept == (r.vec_id == 0) for r in got.values()) and len(got) == 100
    assert collisions.near_duplicates(df, collisions.Search(block=16)).count() == 300
