"""The manifest next to a plain tree of lists."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from fathomgrid.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def written(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, more=0):
    n = None if row["n_chars"] is None else row["n_chars"] + more
    return h(*(written(v) for v in (row["doc_id"], row["source"], row["lang"], n, row["text"])))


def tree(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        levels.append(nodes)
    return levels


def path(levels, at):
    steps = []
    for nodes in levels[:-1]:
        pair = nodes[at & ~1 : (at | 1) + 1]
        steps.append((at & 1, pair[1 - (at & 1)] if len(pair) == 2 else ""))
        at >>= 1
    return steps


def plain(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row["lang"], []).append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for part in by_lang.values():
        part.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {x: tree([leaf(r) for r in by_lang[x]]) for x in langs}
    upper = tree([trees[x][-1][0] for x in langs])
    out = []
    for place, x in enumerate(langs):
        for at, row in enumerate(by_lang[x]):
            steps = path(trees[x], at) + path(upper, place)
            hit = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            node = leaf(row, 1 if hit else 0)
            for right, sibling in steps:
                node = h(sibling, node) if right else h(node, sibling)
            proof = h(*(s for _, s in steps))
            root = upper[-1][0]
            out.append((row["doc_id"], leaf(row), trees[x][-1][0], root, proof, node, node == root))
    return out


COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, rank long, tree string, n int, digest string"


def made(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2, "z") for r in rows], COLUMNS)


def same(docs, bits):
    got = sorted((tuple(r) for r in merkle.manifest(docs, bits).collect()), key=repr)
    assert got == sorted(plain([r.asDict() for r in docs.collect()]), key=repr)
    return got


ROWS = [(i, f"s{i % 3}", ("de", "en", None, "null", "")[i % 5 if i % 3 else 0], len(str(i)), f"text {i}") for i in range(150)]
EDGES = [
    (None, None, None, None, None),
    (None, None, None, None, None),
    (7, "s", "en", 3, ""),
    (7, "s", "en", 3, "other"),
    (7, "s", "en", 3, "other"),
    (500, "s", "alone", 3, "é漢 " * 40_000),
    (501, "s", "two", None, "x"),
    (502, "s", "two", None, "x"),
]


@pytest.mark.parametrize("bits", [1, 3, 8])
def test_against_plain_trees(spark, bits):
    got = same(made(spark, ROWS + EDGES).repartition(5), bits)
    # Adding to a null count changes nothing, so such a leaf still proves.
    tampered = [r for r in got if not r[-1]]
    assert 0 < len(tampered) < len(got) / 4


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9, 16, 17])
def test_sizes_around_whole_packs(spark, n):
    same(made(spark, [(i, "s", "en", i, "t") for i in range(n)]), 2)


def test_equal_rows_share_packs(spark):
    docs = made(spark, [(None, "s", "en", 1, "same")] * 64 + [(1, "s", "en", 1, "other")])
    got = same(docs, 2)
    assert len({r[1] for r in got}) == 2


def test_single_row_is_the_root(spark):
    ((_, leaf_, subroot, root, proof, folded, _),) = same(made(spark, [(3, "s", "en", 1, "t")]), 8)
    assert leaf_ == subroot == root and proof == h("")


def test_empty_table(spark):
    assert merkle.manifest(made(spark, ROWS).filter("false")).collect() == []


def test_no_task_has_a_whole_language(spark):
    """Rows are cut into ranges whatever the language, even where all are equal."""
    from fathomgrid.llm.common import store
    from fathomgrid.llm.ordinals import ordinals

    rows = store(spark.range(0, 4000, 1, 8).select(F.lit("1en").alias("tree"), F.lit(None).cast("long").alias("doc_id")), "rows")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ordinals(rows, ["tree"], [F.col("doc_id")], "ordered").select("ordinal", "group_rows").collect()
        parts = rows.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange("tree", "doc_id", "__row")
        sizes = [r["count"] for r in parts.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r["ordinal"] for r in got) == list(range(4000)) and {r["group_rows"] for r in got} == {4000}
    assert len(sizes) == 4 and max(sizes) < 1500
