import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from fathomgrid.llm import packing
from fathomgrid.llm.common import id_remainder, store, table
from tests.llm.test_packing import check
from tests.llm.test_setsketch import plain_components

SF = "/root/testdata/sf0.001"


def test_stages_one_after_another(spark):
    docs = table(spark, SF, "documents")
    before = docs.collect()
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}

    docs = store(pipeline.reject_toxic(spark, docs, SF), "stage")
    kept = docs.collect()
    assert docs.columns == table(spark, SF, "documents").columns and len(kept) < len(before)
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in kept}
    assert sum(labels.get(i) == 0 for i in gone) <= 1

    docs = store(pipeline.drop_near_duplicates(spark, docs, SF), "stage")
    want = plain_components([r["doc_id"] for r in kept], [r["text"] for r in kept])
    assert sorted(r["doc_id"] for r in docs.collect()) == sorted(i for i, (_, c) in want.items() if i == c)

    unique = {r["doc_id"]: r for r in docs.collect()}
    docs = store(pipeline.replace_personal_data(spark, docs, SF), "stage")
    for r in docs.collect():
        old = unique[r["doc_id"]]
        assert len(re.findall(r"\S+", r["text"])) == len(re.findall(r"\S+", old["text"]))
        assert all(m not in r["text"] for m in re.findall(r"555-\d{4}|\S+@mail\d\.example\.com", old["text"]))

    words = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in docs.collect()}
    docs = store(pipeline.mix_sources(spark, docs, SF), "stage")
    mixed = docs.collect()
    assert abs(sum(words[r["doc_id"]] for r in mixed) / sum(words.values()) - 1) < 0.1
    assert max(r["count"] for r in docs.groupBy("doc_id").count().collect()) <= 3

    rows = pipeline.pack_sequences(spark, docs, SF).collect()
    check(rows, packing.CAPACITY)
    assert sum(r["piece"] == 0 for r in rows) == len(mixed)


@pytest.mark.parametrize("stage", [s for _, s in pipeline.STAGES], ids=[n for n, _ in pipeline.STAGES])
def test_awkward_and_empty_rows(spark, awkward, nothing, stage):
    rows = stage(spark, awkward, SF).collect()
    assert rows
    assert stage(spark, nothing, SF).count() == 0


def test_repeated_rows_leave_one(spark, awkward):
    rows = pipeline.drop_near_duplicates(spark, awkward, SF).filter(F.col("doc_id") == 1).collect()
    assert len(rows) == 1


@pytest.mark.parametrize("ids", [[], [-1, -2]])
def test_without_usable_labels_nothing_is_rejected(spark, tmp_path, ids):
    labels = spark.createDataFrame([(i, 1, n % 2) for n, i in enumerate(ids)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(i, f"a clean text {i}") for i in range(20)], "doc_id long, text string")
    if ids:
        held_out = {r["doc_id"] for r in labels.filter(id_remainder("doc_id", 5) == 0).collect()}
        assert not held_out
    assert pipeline.reject_toxic(spark, docs, str(tmp_path)).count() == 20


def test_rows_without_ids_are_mixed_each_by_itself(spark):
    rows = [(None, f"word{i}", "a") for i in range(300)] + [(None, f"word{i}", "b") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = pipeline.mix_sources(spark, docs, SF)
    assert found.columns == docs.columns
    assert {r["source"]: r["count"] for r in found.groupBy("source").count().collect()} == {"a": 280, "b": 30}


def test_each_text_of_an_id_stays_once_and_the_same_one(spark):
    rows = [(5, "one two three four five six", "s2"), (5, "one two three four five six", "s1"), (5, "another text of that id here", "s1")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, source string").coalesce(1)
        found = sorted(map(tuple, pipeline.drop_near_duplicates(spark, docs, SF).collect()))
        assert found == sorted([rows[1], rows[2]])


@pytest.mark.parametrize("stage", [s for n, s in pipeline.STAGES if n != "near_dedup"], ids=[n for n, _ in pipeline.STAGES if n != "near_dedup"])
def test_columns_named_like_the_stages_own(spark, stage):
    names = ("pseudonym_kinds", "row", "key", "id", "number", "copies", "turn", "found", "__key", "__row", "__id", "__pii")
    docs = spark.createDataFrame(
        [(i, f"Call 555-123-4567 or 4111 1111 1111 1111, text {i}", "s", *("x" for _ in names)) for i in range(6)],
        "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names),
    )
    made = stage(spark, docs, SF)
    rows = made.collect()
    assert rows and (made.columns == docs.columns or "sequence_id" in made.columns)
    if made.columns == docs.columns:
        assert all(r[n] == "x" for r in rows for n in names)
