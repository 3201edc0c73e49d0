"""Mixing sources to target weights by weighted fair queueing.

Every document of a source, in an order shuffled by a hash of its id, gets a virtual finish time: the
source's words up to and including it over the source's target. A source whose target exceeds its size
is queued again, up to three times in all. All queues are merged by finish time and the merge is cut
where the budget (the size of all documents) is used up, so at any point of the merge every source
has received its share.

Targets: sources in code point order, null last, weigh 1, 2, 3, repeating. A target stops at 3 times
its source's size; the excess is shared again by weight until none is above.

Null texts have size 0. Sizeless documents take nothing. Repeated rows count as rows of their own. An
empty table gives an empty mix. Reruns agree: ties are broken by id, size and row number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomgrid.llm.common import store
from fathomgrid.llm.ranges import running

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
RANGE_ROWS = 10_000
"""Rows one task orders; sources and the merge are cut into so many ranges of about this size."""

_MD5_SPAN = float(1 << 60)


def words(text: Column) -> Column:
    """Maximal runs other than space and the controls 9 to 13."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def shuffled(column: str) -> Column:
    """A number from 0 to 2^60-1 that a document's id fixes."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(column).cast("string"), F.lit(""))), 1, 15), 16, 10).cast("bigint")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, rank, target) of stored (source, size) rows."""
    spark = sized.sparkSession
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    # Ranks by range, so that not even the list of sources meets in one task.
    ranged = totals.repartitionByRange(F.col("source").isNull(), F.col("source"))
    numbered = store(ranged.withColumn("range", F.spark_partition_id()), "sources")
    ranked = running(
        numbered, "range", [F.col("source").isNull(), F.col("source")], {"rank": F.lit(1)}
    ).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    ranked = store(ranked.withColumn("most", F.col("source_size") * MOST_REPEATS), "ranked")

    budget = ranked.agg(F.sum("source_size")).first()[0] or 0
    full, known = F.lit(False), -1
    left, weight = budget, 1
    # A literal below 2^31 is an int, and so is a weight: their product would pass an int.
    shared = lambda: F.col("weight") * F.lit(left).cast("bigint")
    while True:
        # One row: what is capped so far, and the weight of the rest.
        capped, count, weight = ranked.agg(
            F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0)),
            F.coalesce(F.sum(full.cast("bigint")), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        left = budget - capped
        if count == known or weight == 0:
            break
        known = count
        # Shares only grow, so a capped source stays capped.
        full = F.col("most") * weight <= shared()
    share = shared().cast("double") / F.lit(float(max(weight, 1)))
    target = F.when(full, F.col("most").cast("double")).otherwise(share)
    return store(ranked.select("source", "source_size", "source_rows", "rank", target.alias("target")), "targets")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, range_rows: int = RANGE_ROWS, row: str | None = None
) -> DataFrame:
    """Per row of `docs`: doc_id, size, source_size, target, taken and copies, and `row` if it names a row number."""
    number = F.col(row) if row else F.monotonically_increasing_id()
    sized = store(
        docs.select(
            "doc_id", "source", words(F.col("text")).alias("size"), number.alias("row")
        ),
        "sizes",
    )
    targets = source_targets(sized, weights).withColumnRenamed("source", "of")
    placed = sized.join(targets, sized["source"].eqNullSafe(targets["of"])).drop("of").withColumn(
        "turn", shuffled("doc_id")
    )
    parts = F.ceil(F.col("source_rows") / range_rows)
    placed = placed.withColumn("part", F.floor(F.col("turn") / F.lit(_MD5_SPAN) * parts))
    order = [F.col("turn"), F.col("doc_id"), F.col("size"), F.col("row")]
    queued = running(placed, "part", order, {"up_to": F.col("size")}, "rank")

    rounds = F.greatest(F.lit(1), F.ceil(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))))
    turns = queued.withColumn("again", F.explode(F.sequence(F.lit(0), F.coalesce(rounds, F.lit(1)).cast("int") - 1)))
    served = (F.col("again") * F.col("source_size") + F.col("up_to")).cast("double")
    finish = F.when(F.col("target") > 0, served / F.when(F.col("target") > 0, F.col("target")))
    merged = turns.withColumn("finish", F.coalesce(finish, F.lit(float("inf"))))
    total, rows = sized.agg(F.sum("size"), F.count(F.lit(1))).first()
    # Sources spend evenly in virtual time, so ranges of equal time hold about equally many words.
    ranges = max(8, -(-rows // range_rows))
    merged = merged.withColumn("stretch", F.floor(F.least(F.col("finish"), F.lit(2.0)) * ranges))
    merged = store(merged, "queue")
    order = [F.col("finish"), F.col("rank"), F.col("turn"), F.col("doc_id"), F.col("row"), F.col("again")]
    cut = running(merged, "stretch", order, {"used": F.col("size")})
    taken = (F.col("used") <= F.lit(total or 0)) & (F.col("finish") < float("inf")) & (F.col("size") > 0)
    named = [F.col("row").alias(row)] if row else []
    return (
        cut.groupBy("row", "doc_id", "size", "source_size", "target")
        .agg(F.sum(taken.cast("bigint")).alias("copies"))
        .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", *named)
    )
