"""The pipeline on a small folder of tables: what each stage removes, and the schema between stages."""

from __future__ import annotations

import corpus_pipeline
from tests.llm.test_operators import words


def test_stages_take_effect(spark, documents, tmp_path):
    shared = "this line stands in many documents"
    item = " ".join(words(77, 30))
    body = {k: " ".join(words(100 + k, 60)) for k in range(14)}
    rows = [(k, f"{text}\n{shared}", "en") for k, text in body.items()]
    near = body[3].split()
    near[5] = "other"
    rows += [(20, body[2], "en"), (21, " ".join(near), "en"), (22, f"{' '.join(words(9, 40))} {item} end", "en"),
             (23, "12345 67890", "en"), (24, None, "en"), (25, shared, "en"), (None, "no id", "en")]
    folder = str(tmp_path)
    documents(*rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = []
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        left.append({r["doc_id"]: r["text"] for r in docs.collect()})
    assert set(left[0]) == set(range(14)) | {20, 21, 22, 25}
    assert left[1][0] == body[0] and 25 not in left[1]
    assert set(left[1]) - set(left[2]) == {20, 21}
    assert set(left[2]) - set(left[3]) == {22}
    coded = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in coded} == set(range(14)) and all(r["round_trip"] for r in coded)


def test_copies_leave_one(spark, documents, tmp_path):
    shared = "this line stands in many documents"
    clean = f"{' '.join(words(500, 40))}\n{' '.join(words(501, 40))}"
    rows = [(k, f"{' '.join(words(600 + k, 40))}\n{shared}", "en") for k in range(11)]
    rows += [(100 + k, clean if k % 2 else f" {clean.upper()}\n", "en") for k in range(12)]
    # One document of many texts, and rows without an id, count a line once.
    own, lost = "only in one document", "only in rows without an id"
    rows += [(50, f"{' '.join(words(650 + k, 9))}\n{own}", "en") for k in range(12)]
    rows += [(None, f"{' '.join(words(670 + k, 9))}\n{lost}", "en") for k in range(12)]
    docs = documents(*rows)
    kept = corpus_pipeline.drop_repeated_lines(spark, docs, "").collect()
    assert len(kept) == len(rows)
    assert all(shared not in r["text"] for r in kept)
    assert sum(own in r["text"] for r in kept) == 12 and sum(lost in r["text"] for r in kept) == 12
    assert {r["text"] for r in kept if (r["doc_id"] or 0) >= 100} == {t for k, t, _ in rows if (k or 0) >= 100}
    folder = str(tmp_path)
    docs.where("doc_id <> 50").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    left = {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert left == {*range(11), 100}


def test_every_document_loses_several_lines(spark, documents):
    shared = "this line stands in all documents\nand so does this one"
    body = {k: " ".join(words(800 + k, 12)) for k in range(15)}
    rows = [(k, f"{text}\n{shared}", "en") for k, text in body.items()] + [(90, shared, "en")]
    left = corpus_pipeline.drop_repeated_lines(spark, documents(*rows), "").collect()
    assert {r["doc_id"]: r["text"] for r in left} == body
    assert all(r["n_chars"] == len(r["text"]) for r in left)


def test_empty_table(spark, documents, tmp_path):
    documents((1, "x", "en")).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
