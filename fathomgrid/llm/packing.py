"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands.

Each document is its token ids and one end id; only longer ones are cut, into pieces of a whole
sequence. A full piece is a sequence of its own. The rest are dealt by hash into blocks of about
`BLOCK_PIECES` pieces; blocks are solved apart, so tasks stay small and their number grows with the input.

Within a block several islands evolve populations. An individual is a grouping of pieces into bins. Crossover
injects whole well-filled bins of one parent into the other, removes bins that hold a duplicate, and puts
displaced pieces back by best fit; mutation dissolves the emptiest bins. Between epochs each island's best
migrates to the next island by a shuffle. A block that reaches the lower bound (its tokens over the capacity)
is done. Where blocks leave a sequence part empty, the pieces of their emptiest sequences are dealt anew
together, which takes a last round.

Null texts count as empty: one end id. Repeated rows are packed each. An empty table packs into nothing.
"""

from __future__ import annotations

import bisect
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomgrid.llm.common import store, texts
from fathomgrid.llm.tokens import shared_encoder

CAPACITY = 4096
END_ID = 1
BLOCK_PIECES = 2048
ISLANDS = 3
EPOCHS = 2
GENERATIONS = 12
POPULATION = 6
WELL_FILLED = 0.995

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document. Texts are read once and go no further."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer)
        end, width = np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            made: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, ids in zip(
                batch.column("doc_id").to_pylist(), encoder.ids(batch.column("text")), strict=True
            ):
                ids += end
                for number, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    for column, value in zip(
                        made, (doc_id, number, at // 4, len(part) // 4, zlib.crc32(part)), strict=True
                    ):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(made, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return texts(docs, "doc_id").mapInArrow(run, PIECES)


class Grouping:
    """Bins of piece numbers with their fill."""

    __slots__ = ("bins", "fill")

    def __init__(self, bins: list[list[int]], fill: list[int]):
        self.bins, self.fill = bins, fill

    def value(self) -> tuple[int, int]:
        """Fewer bins first, then fill gathered in fewer bins."""
        return len(self.bins), -sum(f * f for f in self.fill)


def best_fit(grouping: Grouping, items: list[int], size: list[int], capacity: int) -> Grouping:
    """Put `items` where they leave least room, opening bins where none has room."""
    bins, fill = grouping.bins, grouping.fill
    room = sorted((capacity - f, i) for i, f in enumerate(fill) if f < capacity)
    for item in items:
        at = bisect.bisect_left(room, (size[item], -1))
        if at == len(room):
            bins.append([item])
            fill.append(size[item])
            i = len(bins) - 1
        else:
            _, i = room.pop(at)
            bins[i].append(item)
            fill[i] += size[item]
        if fill[i] < capacity:
            bisect.insort(room, (capacity - fill[i], i))
    return grouping


def _larger_first(items: list[int], size: list[int]) -> list[int]:
    return sorted(items, key=lambda i: (-size[i], i))


def cross(a: Grouping, b: Grouping, size: list[int], capacity: int, dice: random.Random) -> Grouping:
    """`a` with whole well-filled bins of `b` injected."""
    full = [i for i, f in enumerate(b.fill) if f >= WELL_FILLED * capacity] or [max(range(len(b.fill)), key=b.fill.__getitem__)]
    chosen = dice.sample(full, max(1, len(full) // 2))
    injected = {item for i in chosen for item in b.bins[i]}
    bins, fill, displaced = [list(b.bins[i]) for i in chosen], [b.fill[i] for i in chosen], []
    for content, f in zip(a.bins, a.fill, strict=True):
        if injected.isdisjoint(content):
            bins.append(list(content))
            fill.append(f)
        else:
            displaced += [item for item in content if item not in injected]
    return best_fit(Grouping(bins, fill), _larger_first(displaced, size), size, capacity)


def mutate(a: Grouping, size: list[int], capacity: int, dice: random.Random) -> Grouping:
    """Dissolve the emptiest bins and a few others, and fit their pieces again in mixed order."""
    order = sorted(range(len(a.bins)), key=a.fill.__getitem__)
    gone = set(order[: max(1, len(order) // 50)]) | set(dice.sample(order, max(1, len(order) // 25)))
    loose = [item for i in gone for item in a.bins[i]]
    rest = [i for i in range(len(a.bins)) if i not in gone]
    kept = Grouping([list(a.bins[i]) for i in rest], [a.fill[i] for i in rest])
    loose = sorted(loose, key=lambda i: -size[i] * dice.uniform(0.8, 1.25))
    return best_fit(kept, loose, size, capacity)


def evolve(
    size: list[int], elites: list[list[int]], seed: int, capacity: int, generations: int = GENERATIONS
) -> tuple[list[int], int]:
    """Best grouping found as a bin number per piece, and its number of bins."""
    least = -(-sum(size) // capacity)
    dice = random.Random(seed)
    population = [_grouping(e, size) for e in elites]
    order = list(range(len(size)))
    population.append(best_fit(Grouping([], []), _larger_first(order, size), size, capacity))
    best = min(population, key=Grouping.value)
    if len(best.bins) > least:
        while len(population) < POPULATION:
            loose = sorted(order, key=lambda i: -size[i] * dice.uniform(0.7, 1.4))
            population.append(best_fit(Grouping([], []), loose, size, capacity))
        for _ in range(generations):
            children = []
            for _ in range(POPULATION):
                a, b = (min(dice.sample(population, 2), key=Grouping.value) for _ in range(2))
                child = cross(a, b, size, capacity, dice) if a is not b else mutate(a, size, capacity, dice)
                if dice.random() < 0.3:
                    child = mutate(child, size, capacity, dice)
                children.append(child)
            population = sorted([*population, *children], key=Grouping.value)[:POPULATION]
            best = population[0]
            if len(best.bins) <= least:
                break
    bins = [0] * len(size)
    for number, content in enumerate(best.bins):
        for item in content:
            bins[item] = number
    return bins, len(best.bins)


def _grouping(bins: list[int], size: list[int]) -> Grouping:
    made: list[list[int]] = [[] for _ in range(max(bins) + 1)]
    fill = [0] * len(made)
    for item, b in enumerate(bins):
        made[b].append(item)
        fill[b] += size[item]
    return Grouping(made, fill)


def _evolve_islands(capacity: int, seed: int):
    """One epoch for rows (block, island, sizes, elites): adds the best found and its number of bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            found = [
                evolve(r["sizes"], r["elites"], hash((seed, r["block"], r["island"])), capacity) for r in rows
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("block"),
                    batch.column("island"),
                    batch.column("sizes"),
                    pa.array([f[0] for f in found], pa.list_(pa.int32())),
                    pa.array([f[1] for f in found], pa.int32()),
                ],
                names=["block", "island", "sizes", "best", "used"],
            )

    return run


def _solve(blocks: DataFrame, capacity: int, islands: int, epochs: int) -> DataFrame:
    """(block, bins) for stored rows (block, sizes): a bin number per piece."""
    elites = F.lit(None).cast("array<array<int>>")
    state = blocks.select("block", "sizes", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"))
    state = state.select("block", "island", "sizes", F.coalesce(elites, F.array().cast("array<array<int>>")).alias("elites"))
    shape = "block bigint, island int, sizes array<int>, best array<int>, used int"
    least = F.ceil(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda s, x: s + x) / capacity)
    solved = None
    for epoch in range(epochs):
        # One row per block and island, at most BLOCK_PIECES numbers each: rows are dealt one by one.
        run = state.repartition("block", "island").mapInArrow(_evolve_islands(capacity, epoch), shape)
        ran = store(run, f"epoch{epoch}")
        best = ran.groupBy("block").agg(
            F.min_by("best", F.struct("used", "island")).alias("bins"), F.min("used").alias("used"), F.first("sizes").alias("sizes")
        )
        done = best if epoch == epochs - 1 else best.filter(F.col("used") <= least)
        done = done.select("block", "bins")
        solved = done if solved is None else solved.unionByName(done)
        if epoch == epochs - 1:
            break
        open_blocks = best.filter(F.col("used") > least).select("block")
        ring = Window.partitionBy("block").orderBy("island")
        first = F.first("best").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        state = ran.join(open_blocks, "block").select(
            "block",
            "island",
            "sizes",
            F.array("best", F.coalesce(F.lead("best").over(ring), first)).alias("elites"),
        )
    return solved


def _pack_blocks(rows: DataFrame, capacity: int, block_pieces: int, islands: int, epochs: int, salt: int) -> DataFrame:
    """Stored rows (uid, length) with their block and bin."""
    n = rows.count()
    count = max(1, -(-n // block_pieces))
    dealt = rows.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(count)).alias("block"))
    # A block is about `block_pieces` rows by construction, so its list is bounded.
    listed = dealt.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("uid", "length"))).alias("items"))
    blocks = store(listed.select("block", F.col("items.uid").alias("uids"), F.col("items.length").cast("array<int>").alias("sizes")), "blocks")
    solved = _solve(blocks.select("block", "sizes"), capacity, islands, epochs)
    each = blocks.join(solved, "block").select("block", F.inline(F.arrays_zip("uids", "sizes", "bins")))
    return each.select(F.col("uids").alias("uid"), F.col("sizes").cast("bigint").alias("length"), "block", F.col("bins").alias("bin"))


def pack_pieces(
    rows: DataFrame,
    capacity: int = CAPACITY,
    block_pieces: int = BLOCK_PIECES,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
) -> DataFrame:
    """`rows` (stored, with unique `uid` and `length`) plus sequence_id and offset."""
    full = rows.filter(F.col("length") == capacity).withColumn("sequence_id", -1 - F.col("uid")).withColumn(
        "offset", F.lit(0).cast("bigint")
    )
    part = rows.filter(F.col("length") < capacity)
    packed = store(_pack_blocks(part.select("uid", "length"), capacity, block_pieces, islands, epochs, 0), "packed")
    # Each block may end with a sequence or two part empty; those pieces are few and are packed together.
    fills = packed.groupBy("block", "bin").agg(F.sum("length").alias("fill"))
    emptiest = Window.partitionBy("block").orderBy("fill", "bin")
    loose = store(fills.filter(F.col("fill") < capacity).withColumn("nth", F.row_number().over(emptiest)).filter("nth <= 2"), "loose")
    keys = ["block", "bin"]
    again = store(packed.join(loose.select(*keys), keys).select("uid", "length"), "again")
    settled = packed.join(loose.select(*keys), keys, "left_anti").select("uid", "length", (F.col("block") * (1 << 20) + F.col("bin")).alias("sequence_id"))
    second = _pack_blocks(again, capacity, block_pieces, islands, epochs, 1).select(
        "uid", "length", (F.col("block") * (1 << 20) + F.col("bin") + (1 << 61)).alias("sequence_id")
    )
    placed = settled.unionByName(second)
    # A sequence holds at most `capacity` pieces.
    offset = F.sum("length").over(Window.partitionBy("sequence_id").orderBy("uid")) - F.col("length")
    placed = placed.withColumn("offset", offset).drop("length")
    return part.join(placed, "uid").unionByName(full)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece of every document."""
    cut = store(pieces(docs, tokenizer, capacity).withColumn("uid", _number()), "pieces")
    return pack_pieces(cut, capacity).drop("uid")


def _number() -> Column:
    return F.monotonically_increasing_id()
