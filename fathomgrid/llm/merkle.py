"""Merkle manifest of a table: a content-addressed DAG of digests, and proofs by descending it.

Every row is a leaf. Leaves of a language ascend by id; every two consecutive nodes become their digest until one is
left, the language's subroot. Subroots, ordered by language, become the root of the table the same way.

The DAG is stored as records digest -> children, held in packs: a pack has the records below one digest, `BITS` levels
deep, and is found by that digest. A tree of n leaves takes log(n) / `BITS` rounds of packs, up and down.

Proofs descend from the root. In each pack the digits of a leaf's rank choose the child to follow, and the children
not chosen are collected; a pack's share of the path, a segment, is then reversed and put before the segments above
it. Upper packs are visited once per pack below, not once per leaf, so only the last step has a row per leaf,
and it never leaves the task: the proof's digest and the folded root are computed there.

A null field is written `-`. Rows without an id come first; rows of one id are ordered by their digest, repeated rows
are leaves of their own with equal digests (their packs are stored once). Languages: null first, then bytewise;
null and the text `null` differ. Very long texts are hashed where they are read and go no further. An empty table
has no rows. Only the five fields are read, so further columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomgrid.llm.common import store
from fathomgrid.llm.ordinals import ordinals

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BITS = 8
"""Levels per pack; so a pack has at most 2^BITS leaves below its digest."""

# How a step of a path is written: the sibling's side, then its digest. A node without a sibling is `LONE`.
LEFT, RIGHT, LONE = "<", ">", "="

_RESULT = (
    "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A field as the digest takes it: byte count, colon, value; `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(n_chars: Column) -> Column:
    return F.sha2(F.concat(*(field(n_chars if f == "n_chars" else F.col(f)) for f in FIELDS)).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """tree, doc_id, leaf and tampered (null where the row stays as it is) per row."""
    # Trees in the order of their languages, and without a null among the keys.
    tree = F.coalesce(F.concat(F.lit("1"), "lang"), F.lit("0"))
    chosen = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = F.when(chosen, row_digest(F.col("n_chars") + 1))
    return docs.select(
        tree.alias("tree"), "doc_id", row_digest(F.col("n_chars")).alias("leaf"), changed.alias("tampered")
    )


# --- building ------------------------------------------------------------------------------------


def raised(nodes: list[str], levels: int | None) -> tuple[str, list[tuple[str, list[str]]]]:
    """The digest above `nodes` after `levels` rounds (until one is left, if None), and the records below it."""
    records: dict[str, list[str]] = {}
    done = 0
    while len(nodes) > 1 if levels is None else done < levels:
        above = []
        for at in range(0, len(nodes), 2):
            children = nodes[at : at + 2]
            node = digest("".join(children))
            records[node] = children
            above.append(node)
        nodes, done = above, done + 1
    return nodes[0], list(records.items())


_PACK = "tree string, pack bigint, n bigint, digest string, records array<struct<digest:string,children:array<string>>>"


def _packs(nodes: DataFrame, bits: int) -> DataFrame:
    """Packs of nodes (tree, rank, digest, n): at most 2^bits nodes each."""
    grouped = nodes.groupBy("tree", F.shiftright("rank", bits).alias("pack")).agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("rank", "digest")))["digest"].alias("nodes")
    )
    kind = pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                made = [
                    raised(nodes, bits if n > 1 << bits else None)
                    for nodes, n in zip(batch.column("nodes").to_pylist(), batch.column("n").to_pylist(), strict=True)
                ]
                records = [[{"digest": d, "children": c} for d, c in m[1]] for m in made]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c) for c in ("tree", "pack", "n")),
                        pa.array([m[0] for m in made], pa.string()),
                        pa.array(records, kind),
                    ],
                    names=["tree", "pack", "n", "digest", "records"],
                )

    return grouped.mapInArrow(run, _PACK)


def build(nodes: DataFrame, bits: int = BITS) -> tuple[list[DataFrame], DataFrame]:
    """Packs by level from the leaves up, and (tree, digest, top) with the number of levels each tree has.

    `nodes`: stored (tree, rank, digest, n), where n counts the tree's leaves.
    """
    roots = nodes.filter("n = 1").select("tree", "digest", F.lit(0).alias("top"))
    open_nodes = nodes.filter("n > 1")
    # One number; it sets how many rounds there are.
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels: list[DataFrame] = []
    while most > 1:
        packs = store(_packs(open_nodes, bits), f"packs{len(levels)}")
        levels.append(packs)
        most = -(-most >> bits)
        above = packs.select(
            "tree",
            F.col("pack").alias("rank"),
            "digest",
            F.shiftright(F.col("n") + ((1 << bits) - 1), bits).alias("n"),
        )
        roots = roots.unionByName(above.filter("n = 1").select("tree", "digest", F.lit(len(levels)).alias("top")))
        open_nodes = above.filter("n > 1")
    return levels, store(roots, "roots")


# --- descending ----------------------------------------------------------------------------------


def segment(top: str, records: dict[str, list[str]], offset: int, levels: int) -> tuple[str, list[str]]:
    """The node at `offset`, `levels` below `top`, and the steps from it up to `top`."""
    node, steps = top, []
    for level in range(levels - 1, -1, -1):
        children = records[node]
        digit = offset >> level & 1
        if len(children) == 1:
            steps.append(LONE)
        else:
            steps.append((RIGHT if digit == 0 else LEFT) + children[1 - digit])
        node = children[digit]
    steps.reverse()
    return node, steps


def folded(leaf: str, path: list[str]) -> str:
    for step in path:
        side, sibling = step[0], step[1:]
        leaf = digest(sibling + leaf if side == LEFT else leaf + sibling)
    return leaf


def _height(records: dict[str, list[str]], top: str) -> int:
    """Levels of a pack: its leaves have no records."""
    node, levels = top, 0
    while node in records:
        node, levels = records[node][0], levels + 1
    return levels


_VISIT = "tree string, rank bigint, subroot string, digest string, path array<string>"


def _steps(rows: pa.RecordBatch) -> Iterator[tuple[dict, dict, str, list[str]]]:
    """Per request (row, request, digest reached, path from it to the root)."""
    for at in range(rows.num_rows):
        row = rows.slice(at, 1).to_pylist()[0]
        records = {r["digest"]: r["children"] for r in row["records"]}
        levels = _height(records, row["digest"])
        for wanted in row["wanted"]:
            node, steps = segment(row["digest"], records, wanted["rank"] - row["first"], levels)
            yield row, wanted, node, steps + row["path"]


def _visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 16):
            found = list(_steps(batch.slice(at, 16)))
            columns = [
                pa.array([r["tree"] for r, _, _, _ in found], pa.string()),
                pa.array([w["rank"] for _, w, _, _ in found], pa.int64()),
                pa.array([r["subroot"] for r, _, _, _ in found], pa.string()),
                pa.array([d for _, _, d, _ in found], pa.string()),
                pa.array([p for _, _, _, p in found], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "rank", "subroot", "digest", "path"])


def _proved(root: str):
    """Last step: per leaf its proof's digest and what a tampered leaf folds to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                made: list[list] = [[] for _ in range(7)]
                for row, wanted, leaf, path in _steps(batch.slice(at, 16)):
                    proof = digest("".join(step[1:] for step in path))
                    end = folded(wanted["tampered"] or leaf, path)
                    values = (wanted["doc_id"], leaf, row["subroot"], root, proof, end, end == root)
                    for column, value in zip(made, values, strict=True):
                        column.append(value)
                kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(made, kinds, strict=True)],
                    names=[c.split()[0] for c in _RESULT.split(", ")],
                )

    return run


def _asked(requests: DataFrame, level: int, bits: int) -> DataFrame:
    """(tree, pack, wanted): what is asked for below each pack of a level, each child once."""
    below = requests
    if level:
        below = requests.select("tree", F.shiftright("rank", bits * level).alias("rank")).distinct()
    columns = [c for c in below.columns if c != "tree"]
    return below.groupBy("tree", F.shiftright("rank", bits).alias("pack")).agg(
        F.collect_list(F.struct(*columns)).alias("wanted")
    )


def _met(frontier: DataFrame, packs: DataFrame, asked: DataFrame, bits: int) -> DataFrame:
    """Requests beside the pack that their digest names. Equal packs are one."""
    records = packs.groupBy("digest").agg(F.any_value("records").alias("records"))
    at = frontier.withColumnRenamed("rank", "pack").join(asked, ["tree", "pack"])
    return at.withColumn("first", F.shiftleft("pack", bits)).join(records, "digest")


def descend(
    levels: list[DataFrame], starts: DataFrame, requests: DataFrame, last, schema: str, bits: int = BITS
) -> DataFrame | None:
    """What `last` returns of the requests at the leaf packs; None where no tree has packs.

    `starts`: (tree, top, subroot, digest, path), the roots and their paths to the top. `requests`: (tree, rank, ...).
    """
    below = None
    for level in range(len(levels) - 1, -1, -1):
        frontier = starts.filter(F.col("top") == level + 1).select(
            "tree", F.lit(0).cast("bigint").alias("rank"), "subroot", "digest", "path"
        )
        if below is not None:
            frontier = frontier.unionByName(below)
        met = _met(frontier, levels[level], _asked(requests, level, bits), bits)
        if level == 0:
            return met.mapInArrow(last, schema)
        below = store(met.mapInArrow(_visit, _VISIT), f"visit{level}")
    return None


def manifest(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified per row of `docs`."""
    spark = docs.sparkSession
    made = store(leaves(docs), "leaves")
    ranked = ordinals(made, ["tree"], [F.col("doc_id"), F.col("leaf")], "ranked").withColumnsRenamed(
        {"ordinal": "rank", "group_rows": "n"}
    )
    levels, roots = build(ranked.select("tree", "rank", F.col("leaf").alias("digest"), "n"), bits)

    # The trees' roots are the leaves of one more tree.
    trees = ordinals(roots.withColumn("all", F.lit("")), ["all"], [F.col("tree")], "trees").withColumnsRenamed(
        {"tree": "of", "ordinal": "rank", "group_rows": "n"}
    )
    upper, tops = build(trees.select(F.col("all").alias("tree"), "rank", "digest", "n"), bits)
    top = tops.first()
    if top is None:
        return spark.createDataFrame([], _RESULT)
    root = top["digest"]
    no_path = F.array().cast("array<string>")
    start = tops.select("tree", "top", F.lit("").alias("subroot"), "digest", no_path.alias("path"))
    reached = descend(upper, start, trees.select(F.col("all").alias("tree"), "rank"), _visit, _VISIT, bits)
    if reached is None:
        starts = trees.withColumn("path", no_path)
    else:
        starts = trees.join(reached.select("rank", "path"), "rank")
    starts = store(
        starts.select(F.col("of").alias("tree"), "top", F.col("digest").alias("subroot"), "digest", "path"), "starts"
    )
    requests = ranked.select("tree", "rank", "doc_id", "tampered")
    alone = starts.filter("top = 0").join(requests, "tree").select(
        "subroot",
        "digest",
        "path",
        F.lit(0).cast("bigint").alias("first"),
        F.array(F.struct("rank", "doc_id", "tampered")).alias("wanted"),
        F.array().cast("array<struct<digest:string,children:array<string>>>").alias("records"),
    )
    proofs = descend(levels, starts, requests, _proved(root), _RESULT, bits)
    single = alone.mapInArrow(_proved(root), _RESULT)
    return single if proofs is None else proofs.unionByName(single)
