"""Sharding by sampled splitters: shards of near equal bytes, equal texts together.

Records are ordered by a hash of their text, then a hash of their id. A sample drawn with probability in
proportion to size gives quantile boundaries; records are dealt to the ranges between them. Ranges that turn
out overfull are sampled again and subdivided, as far as rows can be told apart. With exact bytes and counts
per range, every record knows the bytes before it, and shards end at the records nearest to equal bytes.

Equal texts are consecutive. Where a shard's end falls into a group of equal texts it moves to the group's
nearer end, so the group stays together; a group of more than `together` of a shard's bytes is cut instead,
because whole it would make shards unequal.

A null text has no bytes (size 8, checksum 0), so null and empty texts form one group. Repeated rows are
rows of their own. With fewer rows than shards some shards are empty. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomgrid.llm.common import store
from fathomgrid.llm.ranges import running

SHARDS = 24
RECORD_BYTES = 8
TOGETHER = 0.1
RANGES_PER_SHARD = 16
DRAWS_PER_RANGE = 16
OVERFULL = 2.0
ROUNDS = 4


def _number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def keyed(docs: DataFrame) -> DataFrame:
    """Narrow rows: id, size, checksum and the two ordering hashes."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        "doc_id",
        (F.length(text) + RECORD_BYTES).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        _number(text).alias("key"),
        _number(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("sub"),
        F.monotonically_increasing_id().alias("row"),
    )


def _draw(rows: DataFrame, each: float, seed: int) -> np.ndarray:
    """(key, sub) of records drawn once per `each` bytes on average, in order.

    Their number is the drawn bytes over `each`, set by the number of ranges and not by the table.
    """
    chance = F.col("size") / F.lit(each)
    dice = F.pmod(F.xxhash64("key", "sub", "row", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    drawn = rows.filter(dice < chance).select("key", "sub", F.greatest(F.col("size").cast("double"), F.lit(each)))
    return np.array(sorted(tuple(r) for r in drawn.collect()), dtype=object).reshape(-1, 3)


def _quantiles(drawn: np.ndarray, parts: int) -> list[tuple[int, int]]:
    """`parts - 1` boundaries of equal drawn weight, fewer where draws coincide."""
    if len(drawn) == 0 or parts < 2:
        return []
    upto = np.cumsum(drawn[:, 2].astype(float))
    at = np.searchsorted(upto, upto[-1] * np.arange(1, parts) / parts)
    return sorted({(int(drawn[i, 0]), int(drawn[i, 1])) for i in at})


def _range_of(bounds: list[tuple[int, int]]):
    """Column function of (key, sub): how many boundaries are at or below."""
    keys = np.array([b[0] for b in bounds], dtype=np.int64)
    subs = np.array([b[1] for b in bounds], dtype=np.int64)

    def place(key: pa.Array, sub: pa.Array) -> pa.Array:
        k, s = key.to_numpy(zero_copy_only=False), sub.to_numpy(zero_copy_only=False)
        low, high = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
        for key_in_both in np.unique(k[low < high]):
            rows = np.flatnonzero(k == key_in_both)
            a, b = low[rows[0]], high[rows[0]]
            low[rows] = a + np.searchsorted(subs[a:b], s[rows], "right")
        return pa.array(low.astype(np.int32))

    return F.arrow_udf(place, T.IntegerType(), F.ArrowUDFType.SCALAR)


def splitters(rows: DataFrame, total: int, ranges: int) -> list[tuple[int, int]]:
    """Boundaries between ranges of at most about `OVERFULL` times the mean bytes."""
    mean = total / ranges
    bounds = _quantiles(_draw(rows, mean / DRAWS_PER_RANGE, 0), ranges)
    for seed in range(1, ROUNDS + 1):
        at = _range_of(bounds)(F.col("key"), F.col("sub")) if bounds else F.lit(0)
        placed = rows.withColumn("range", at)
        sizes = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        overfull = {r["range"]: r["bytes"] for r in sizes.filter((F.col("bytes") > OVERFULL * mean) & (F.col("rows") > 1)).collect()}
        if not overfull:
            break
        again = _draw(placed.filter(F.col("range").isin(*overfull)), mean / DRAWS_PER_RANGE, seed)
        edges = [(-1, -1), *bounds]
        added: set[tuple[int, int]] = set()
        for r, size in overfull.items():
            low, high = edges[r], edges[r + 1] if r + 1 < len(edges) else None
            inside = [d for d in again if (d[0], d[1]) >= low and (high is None or (d[0], d[1]) < high)]
            added |= set(_quantiles(np.array(inside, dtype=object).reshape(-1, 3), int(np.ceil(size / mean)) + 1))
        if added <= set(bounds):
            break
        bounds = sorted({*bounds, *added})
    return bounds


def _ends(spread: DataFrame, total: int, shards: int, together: float) -> list[int]:
    """Bytes before each shard but the first; at record ends."""
    # At most one record holds each of the shards-1 even cuts, in whole numbers to the byte.
    # The first record has nothing before it and may hold the first cut.
    nth = F.greatest(F.expr(f"(before * {shards} + {total} - 1) div {total}"), F.lit(1))
    across = spread.filter((nth * total < F.col("upto") * shards) & nth.between(1, shards - 1))
    across = across.select("key", "before", "upto").collect()
    groups = {
        r["key"]: (r["low"], r["high"])
        for r in spread.filter(F.col("key").isin(*{r["key"] for r in across}))
        .groupBy("key")
        .agg(F.min("before").alias("low"), F.max("upto").alias("high"))
        .collect()
    }
    ends = []
    for j in range(1, shards):
        row = next(r for r in across if r["before"] * shards <= total * j < r["upto"] * shards)
        low, high = groups[row["key"]]
        if (high - low) * shards > together * total:
            low, high = row["before"], row["upto"]
        ends.append(low if 2 * total * j <= (low + high) * shards else high)
    return ends


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, together: float = TOGETHER) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard per row of `docs`."""
    rows = store(keyed(docs), "keyed")
    total = rows.agg(F.sum("size")).first()[0] or 0
    bounds = splitters(rows, total, shards * RANGES_PER_SHARD) if total else []
    at = _range_of(bounds)(F.col("key"), F.col("sub")) if bounds else F.lit(0)
    ranged = store(rows.withColumn("range", at), "ranged")
    order = [F.col("key"), F.col("sub"), F.col("doc_id"), F.col("row")]
    spread = running(ranged, "range", order, {"upto": F.col("size"), "rank": F.lit(1)})
    spread = store(spread.withColumn("before", F.col("upto") - F.col("size")), "spread")
    ends = _ends(spread, total, shards, together) if total else []
    shard = F.lit(0)
    for end in ends:
        shard = shard + (F.col("before") >= F.lit(end)).cast("int")
    spread = spread.withColumn("shard", shard)
    # One row per shard.
    starts = spread.groupBy("shard").agg(F.min("rank").alias("start"))
    return spread.join(F.broadcast(starts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - F.col("start")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
