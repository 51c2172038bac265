import numpy as np
from pyspark.sql import functions as F

from tideline.llm import language_id, queries
from tideline.llm.samples import held_out, labelled_rows


def test_held_out_languages_are_named(spark):
    rows = queries.op1_language_id(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    joined = rows.where("held_out").join(docs, "doc_id")
    n, right = joined.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 150 and right >= 0.98 * n
    assert rows.count() == 1000
    assert rows.where("score is null or score < 0 or score > 1").count() == 0


def test_counts_do_not_depend_on_neighbours():
    texts = ["abc def", None, "", "1234 !", "Ünï", "a", "abc def"]
    whole = language_id.ngram_counts(texts)
    for i, t in enumerate(texts):
        assert (language_id.ngram_counts([t])[0] == whole[i]).all()
    assert [bool(r.any()) for r in whole] == [True, False, False, False, True, True, True]
    # borders and letters: ␣a ab bc c␣ and so on
    assert language_id.ngram_counts(["ab"]).sum() == 2 + 3 + 2


def test_clusters_separate_what_is_separate():
    rng = np.random.default_rng(1)
    rows = np.concatenate([np.eye(3)[i] + rng.normal(0, 0.05, (30, 3)) for i in range(3)])
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    centroids = language_id.cluster(rows, 3)
    assert sorted(int(c.argmax()) for c in centroids) == [0, 1, 2]
    assert len(language_id.cluster(rows[:1], 3)) == 1


def test_far_texts_are_rejected(spark, docs_of):
    from tests.llm.conftest import doc

    rows = [doc(i, f"the cat and the dog number {'ab' * (i % 7)} is here with us", "en") for i in range(60)]
    rows += [doc(100 + i, f"der hund und die katze {'cd' * (i % 7)} sind hier bei uns", "de") for i in range(60)]
    model = language_id.fit(docs_of(rows))
    assert model.languages == ["de", "en"]
    found = model.predict([rows[5][1], rows[65][1], "жук ходит по лесу", "42", None])
    assert [f[0] for f in found[:2]] == ["en", "de"]
    assert found[2][3] and not found[0][3]
    assert found[3:] == [("und", 0.0, None, False)] * 2


def test_edges(spark, edges, nothing):
    model = language_id.fit(edges)
    found = language_id.identify(edges, model).collect()
    assert len(found) == edges.count()
    for r in found:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred == "en" and 0 < r.score <= 1
    empty = language_id.fit(nothing)
    assert {r.lang_pred for r in language_id.identify(edges, empty).collect()} == {"und"}
    assert language_id.identify(nothing, model).count() == 0


def test_learns_from_the_rest_only(spark):
    rows = [(i, "aaa bbb ccc", "x" if held else "y") for i in range(200) for held in [False]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    docs = docs.withColumn("lang", F.when(held_out("doc_id"), "hidden").otherwise("seen"))
    assert language_id.fit(docs).languages == ["seen"]


def test_every_language_is_learned(spark):
    rows = [(i, f"{chr(0x4E00 + i)} {chr(0x4E00 + i)}{chr(0x4E01 + i)}", f"l{i:04d}") for i in range(1200)]
    rows += [(5000 + i, "common words of a large language", "zz") for i in range(300)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), rows=1500)
    held = {r.doc_id for r in spark.createDataFrame(rows, "doc_id bigint, text string, lang string").where(held_out("doc_id")).collect()}
    assert model.languages == sorted({lang for i, _, lang in rows if i not in held})
    some = [r for r in rows[:1200] if r[0] not in held][:200]
    found = model.predict([t for _, t, _ in some])
    assert sum(f[0] == r[2] for f, r in zip(found, some)) > 150


def test_texts_without_letters_and_copies_take_no_place(spark):
    rows = [(i, "seen words here" if i % 10 == 0 else (None, "12 34", "")[i % 3], "few") for i in range(1000)]
    rows += [(7, "other words there again", "copied")] * 10_000 + [(8, "more of that sort", "copied")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit(frame, rows=60)
    assert model.languages == ["copied", "few"]
    assert [m[0] for m in model.predict(["seen words", "other words there"])] == ["few", "copied"]


def test_samples_are_bounded_by_ids(spark):
    docs = spark.createDataFrame([(i % 50, f"text {i}") for i in range(5000)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i % 50, int(i % 50 > 20)) for i in range(5000)], "doc_id bigint, good int")
    rows = labelled_rows(docs, labels, "good", 10, doc_id="doc_id", text="text").collect()
    assert sorted(r.y for r in rows) == [0] * 10 + [1] * 10
    assert len({r.key for r in rows}) == 20 and all(r.text == min(f"text {i}" for i in range(r.key, 5000, 50)) for r in rows)
