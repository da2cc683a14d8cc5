from pyspark.sql import functions as F

from clickloom.llm.language_mixture import accepted, identify, predict


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").cache()
    share = judged.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert judged.count() > 100 and share > 0.98


def made(spark):
    en = "the and of that with this from which they have been were would there their about "
    de = "der die und nicht von mit dem sich auch werden eine einer über können durch wenn "
    rows = [(k, (en if k % 2 else de) * (1 + k % 5), "en" if k % 2 else "de", "x") for k in range(200)]
    rows += [(1000, None, "en", "x"), (1001, "", "en", "x"), (1002, "123 ### 456", "de", "x"), (1003, "é", None, "x"),
             (1004, (en * 6 + de * 2), "en", "x"), (1005, "the and of " * 20000, "en", "x"), (None, de, "de", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string").repartition(3)


def test_odd_texts_and_mixtures(spark):
    df = made(spark)
    got = {r.doc_id: r for r in identify(df).collect()}
    assert len(got) == 207
    assert all(got[k].lang_pred == ("en" if k % 2 else "de") for k in range(200))
    assert [(got[k].lang_pred, got[k].score) for k in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003].lang_pred in ("en", "de") and got[None].lang_pred == "de"
    assert got[1004].langs == ["de", "en"] and got[1004].lang_pred == "en" and 0.6 < got[1004].score < 0.9
    assert got[1005].lang_pred == "en" and all(0 <= r.score <= 1 for r in got.values())
    kept = accepted(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == set(got) - {1000, 1001, 1002}


def test_held_out_rows_and_labels_do_not_change_predictions(spark):
    df = made(spark)
    hidden = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    other = df.withColumn("lang", F.when(hidden, F.lit("zz")).otherwise(F.col("lang")))
    assert sorted(map(str, identify(df).collect())) == sorted(map(str, identify(other).collect()))


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "hello")], "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    assert [(r.lang_pred, r.score) for r in identify(df).collect()] == [("und", 0.0)]
    assert identify(df.limit(0)).count() == 0
    assert predict(df.limit(0), [], __import__("numpy").zeros((1, 0))).count() == 0


def test_accepted_rows_follow_the_judged_language_and_score(spark, monkeypatch):
    df = made(spark)
    judged = {r.doc_id: r for r in identify(df).collect()}
    for wanted, least in ((["de"], 0.0), (["en"], 0.9), (["fr"], 0.0), (None, 0.95)):
        got = {r.doc_id for r in accepted(df, wanted, least).collect()}
        assert got == {d for d, r in judged.items()
                       if r.lang_pred != "und" and (wanted is None or r.lang_pred in wanted) and r.score >= least}
    import corpus_pipeline
    monkeypatch.setattr(corpus_pipeline, "LANGUAGES", ["de"])
    got = {r.doc_id for r in corpus_pipeline.language(spark, df, "").collect()}
    assert got == {d for d, r in judged.items() if r.lang_pred == "de"} and 1001 not in got and 0 in got and 1 not in got
