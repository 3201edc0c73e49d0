import hashlib
import zlib

import pytest

from fathomgrid.llm import sharding


def check(docs, rows, shards):
    assert sorted((str(r["doc_id"]), r["size"]) for r in rows) == sorted(
        (str(d["doc_id"]), len((d["text"] or "").encode()) + 8) for d in docs
    )
    by = {}
    for r in rows:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        by.setdefault(r["shard"], []).append(r)
    for part in by.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    return {k: sum(r["size"] for r in v) for k, v in by.items()}


def test_shards_are_near_equal_and_groups_stay_together(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = sharding.shard_by_bytes(docs, shards=12).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    sizes = check(docs.collect(), rows, 12)
    mean = sum(sizes.values()) / 12
    largest = max(len(t.encode()) for t in texts.values())
    assert max(abs(s - mean) for s in sizes.values()) <= 2 * largest
    where = {}
    for r in rows:
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
        where.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    total = {t: 0 for t in where}
    for r in rows:
        total[texts[r["doc_id"]]] += r["size"]
    assert all(len(s) == 1 for t, s in where.items() if total[t] <= sharding.TOGETHER * mean)


def test_a_group_of_a_third_of_all_rows_is_cut(spark):
    docs = spark.range(3000).selectExpr(
        "id as doc_id", "case when id % 3 = 0 then repeat('same text ', 9) else concat(repeat('x', cast(id % 90 as int)), id) end as text"
    )
    rows = sharding.shard_by_bytes(docs, shards=24).collect()
    sizes = check(docs.collect(), rows, 24)
    mean = sum(sizes.values()) / 24
    assert len(sizes) == 24 and max(abs(s - mean) for s in sizes.values()) <= 2 * 110
    again = sharding.shard_by_bytes(docs, shards=24).collect()
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in rows) == sorted((r["doc_id"], r["shard"], r["slot"]) for r in again)


def test_overfull_ranges_are_subdivided(spark):
    docs = spark.range(2000).selectExpr("id as doc_id", "cast(id as string) as text")
    rows = sharding.store(sharding.keyed(docs), "rows")
    total = rows.agg({"size": "sum"}).first()[0]
    bounds = sharding.splitters(rows, total, 40)
    at = sharding._range_of(bounds)("key", "sub")
    sizes = [r["bytes"] for r in rows.groupBy(at.alias("r")).agg({"size": "sum"}).withColumnRenamed("sum(size)", "bytes").collect()]
    assert max(sizes) <= sharding.OVERFULL * total / 40


def test_awkward_rows(awkward, nothing):
    rows = sharding.shard_by_bytes(awkward).collect()
    check(awkward.collect(), rows, 24)
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] in (3, 4)} == {(8, 0)}
    assert sharding.shard_by_bytes(nothing).count() == 0


@pytest.mark.parametrize("count", [1, 5])
def test_fewer_equal_rows_than_shards(spark, count):
    docs = spark.createDataFrame([(i, "the same text") for i in range(count)], "doc_id long, text string")
    rows = sharding.shard_by_bytes(docs).collect()
    sizes = check(docs.collect(), rows, 24)
    assert len(rows) == count and len(sizes) == count


def test_a_huge_first_record(spark):
    texts = [f"text {i} " + "x" * 5000 for i in range(60)]
    first = min(texts, key=lambda t: hashlib.md5(t.encode()).hexdigest()[:15])
    # Of all texts the first in hash order is kept, the others are short and later in it.
    later = [t for t in (f"short {i}" for i in range(400)) if hashlib.md5(t.encode()).hexdigest() > hashlib.md5(first.encode()).hexdigest()]
    docs = spark.createDataFrame(list(enumerate([first, *later])), "doc_id long, text string")
    rows = sharding.shard_by_bytes(docs).collect()
    check(docs.collect(), rows, 24)
    assert max(r["size"] for r in rows) * 24 > sum(r["size"] for r in rows)
