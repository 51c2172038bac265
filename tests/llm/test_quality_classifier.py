from pyspark.sql import functions as F

from tideline.llm import quality_classifier as qc
from tideline.llm import queries


def test_held_out_labels(spark):
    rows = queries.op9_quality_classifier(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    by = {r.quality: (r.n, r.hits) for r in rows.where("held_out").join(labels, "doc_id").groupBy("quality").agg(
        F.count("*").alias("n"), F.sum("predicted").alias("hits")).collect()}
    assert by[1][1] >= 0.98 * by[1][0] and by[0][1] <= 0.15 * by[0][0]
    assert rows.count() == 10_000
    assert rows.where("score is null or score < 0 or score > 1 or predicted <> int(score >= 0.3)").count() == 0


def test_reruns_agree(spark, data):
    once, again = (sorted(map(tuple, queries.op9_quality_classifier(spark, data).collect())) for _ in range(2))
    assert once == again


def test_the_dictionary_of_like_text_compresses_better():
    good = [f"the {w} of the day was in the house of the king".encode() for w in map(str, range(400))]
    bad = [f"BUY$$$ NOW!!! CHEAP### {w} %%% DEAL***".encode() for w in map(str, range(400))]
    model = qc.CompressionModel(qc.build_dictionary(bad), qc.build_dictionary(good))
    assert model.features("the night of the day was in the house of the queen " * 3)[0] > 0
    assert model.features("BUY$$$ NOW!!! CHEAP### things %%% DEAL***" * 3)[0] < 0
    assert model.features("") == model.features(None) == (0.0, 0.0, 0.0)


def test_edges(spark, edges, nothing):
    labels = spark.createDataFrame(
        [(5, 1), (8, 0), (9, 0), (None, 1), (7, None), (4, 0), (6, 1)], "doc_id bigint, quality int"
    )
    model = qc.fit(edges, labels)
    rows = qc.score(edges, model).collect()
    assert len(rows) == edges.count()
    assert all((r.score == 0.0) == (not r.text) or 0 <= r.score <= 1 for r in rows)
    assert qc.keep_good(edges, model).columns == edges.columns
    none = qc.fit(nothing, labels.limit(0))
    assert {r.score for r in qc.score(edges.where("text <> ''"), none).collect()} == {0.5}
    assert qc.score(nothing, model).count() == 0 and qc.keep_good(nothing, model).count() == 0
