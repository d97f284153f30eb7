"""Rows and texts that once left a result although they belong to the whole job."""

import corpus_pipeline
from skeinflow.llm import html_layout


def test_packing_stage_keeps_null_and_empty_texts(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None), (3, ""), (None, "more words"), (None, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["length"]) for r in corpus_pipeline.packing_stage(spark, docs, "").collect()), key=str)
    assert {i for i, _ in got} == {1, 2, 3, None} and len(got) == 5
    assert (2, 1) in got and (3, 1) in got and (None, 1) in got


def test_near_dup_stage_keeps_null_ids_and_unlike_texts_of_one_id(spark):
    a, b, c, d, e = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcde")
    rows = [
        (7, a, 1), (7, b, 2), (7, b, 2),  # one id with two texts, one of them twice
        (9, a + " tail", 3), (3, b + " tail", 4),  # near copies of both
        (None, c, 5), (None, c + " tail", 6),  # near copies without ids
        (None, d, 7), (8, d + " tail", 8),  # a near copy with an id goes first
        (None, None, 9), (None, None, 10), (None, "", 11), (5, None, 12), (5, "", 13), (None, e, 14),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = corpus_pipeline.near_dup_stage(spark, docs, "")
    assert got.columns == docs.columns
    got = sorted(r["n_chars"] for r in got.collect())
    assert [x for x in got if x not in (5, 6)] == [1, 4, 8, 9, 10, 11, 12, 13, 14] and len({5, 6} & set(got)) == 1 and len(got) == 10


def test_stray_quotes_hide_no_text():
    for page, want in [
        ("<a title=don't>A</a> it's <b>B</b>", "A it's B"),
        ('<p title="5" wide">one</p><p title="x">two</p>', "one\n\ntwo"),
        ("<p it's>one</p> that's", "one\n\nthat's"),
        ("<p =\"x>one</p><p class='a>b'>two</p>", "one\n\ntwo"),
        ("<p title = 'a > b' hidden>no</p><p title=\"it's\">yes</p>", "yes"),
        ("<a href=x=\"y>one</a> <i>two\"</i>", "one two\""),
        ("<i a='x'b=\"y>\"hidden>no</i>yes", "yes"),
    ]:
        assert html_layout.visible_text(page) == want


def test_xmp_is_shown_as_written():
    assert html_layout.visible_text("<p>a<xmp>if  <b> &amp;\n  c</xmp>d") == "a\n\nif  <b> &amp;\n  c\n\nd"


def test_stages_without_usable_labels_keep_all_documents(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some words"), (2, None), (2, "more")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for labels in ([], [(1, None, None)], [(9, 1, 0)]):
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
        for stage in (corpus_pipeline.quality_stage, corpus_pipeline.toxicity_stage):
            assert stage(spark, docs, str(tmp_path)).count() == 3


def test_stages_keep_columns_called_like_their_own(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"some plain words number {k} " + ("moron idiot" if k % 3 == 0 else "of good sense"), k, "r") for k in range(60)], "doc_id long, text string, _score long, _row string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k % 3 == 0)) for k in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for stage in (corpus_pipeline.quality_stage, corpus_pipeline.toxicity_stage, corpus_pipeline.near_dup_stage):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and all(r["_score"] == r["doc_id"] for r in out.collect())


def test_each_stage_of_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0
