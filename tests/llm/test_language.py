import zlib

import pytest

from jobsift.llm.language import Model, fit, identify


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(docs):
    got = identify(docs).collect()
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert len(got) == len(lang)
    for g in got:
        assert g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 4 == 2) and 0 <= g.score <= 1
    out = [g for g in got if g.held_out]
    assert sum(g.lang_pred == lang[g.doc_id] for g in out) >= 0.97 * len(out)


def test_held_out_rows_teach_nothing(spark, docs):
    from pyspark.sql import functions as F

    from jobsift.llm.language import held_out

    turned = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    model = fit(turned)
    assert sorted(v for f in model.families.values() for v in f) == ["de", "en", "es", "fr"]


def test_families_come_first(docs):
    model = fit(docs)
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    assert sorted(model.pairs) == [("de", "en"), ("es", "fr")]
    assert model.predict(["the and of with that from this which"])[0][0] == "en"


def test_odd_rows(odd, none):
    got = identify(odd).collect()
    assert len(got) == odd.count()
    assert all(g.lang_pred is not None for g in got)
    assert all(g.lang_pred == "und" and g.score == 0 for g in got if g.doc_id in (3, 4, 5, 6))
    assert not any(g.held_out for g in got if g.doc_id is None)
    assert identify(none).count() == 0


def test_no_labels_and_one_language(spark):
    rows = [(i, f"some words {i}", None) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {(g.lang_pred, g.score) for g in identify(df).collect()} == {("und", 0.0)}
    one = spark.createDataFrame([(i, t, "en") for i, t, _ in rows], df.schema)
    assert {(g.lang_pred, g.score) for g in identify(one).collect()} == {("en", 1.0)}


def test_model_without_rows():
    import numpy as np

    assert Model(np.zeros((0, 2048), np.float32), np.array([], str)).predict(["text", None]) == [("und", 0.0)] * 2


def test_other_columns_change_nothing(docs):
    from pyspark.sql import functions as F

    plain = sorted((g.doc_id, g.lang_pred, g.score) for g in identify(docs).collect())
    wide = docs.withColumn("extra", F.lit(1)).withColumn("source", F.lit("elsewhere")).drop("n_chars")
    assert sorted((g.doc_id, g.lang_pred, g.score) for g in identify(wide).collect()) == plain


def test_the_most_frequent_languages_are_learnt(spark):
    rows = [(i, f"{v} words {i}", v) for i, v in enumerate(["aa", "bb"] * 20 + [f"stray{k}" for k in range(30)])]
    model = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most=2)
    assert sorted(v for f in model.families.values() for v in f) == ["aa", "bb"]


def test_copies_are_learnt_once(spark):
    rows = [(i, "the same words every time", "en") for i in range(300)] + [(1000 + i, f"autre texte {i}", "fr") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {g.lang_pred for g in identify(df).where("doc_id < 1000").collect()} == {"en"}
