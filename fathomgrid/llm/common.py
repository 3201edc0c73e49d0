"""Shared small helpers of the training-text operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomgrid.session import scratch_path

UPPER_TO_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
"""Lower-cases A-Z and nothing else; UTF-8 continuation bytes stay."""

SLICE_ROWS = 512

GROUP_BYTES = 2_000_000
"""Bytes of text whose words a task holds at a time; a longer text is a group of its own."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def store(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, and safe against lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns and the text as UTF-8 bytes, empty for null."""
    return df.select(*columns, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def byte_slices(batch: pa.RecordBatch, column: str = "text", rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch of at most `rows` rows and about `GROUP_BYTES` of text, or of one longer text."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64())).to_numpy()
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = min(at + rows, max(at + 1, int(ends.searchsorted(before + GROUP_BYTES, "right"))))
        yield batch.slice(at, end - at)
        at = end


def per_text(
    df: DataFrame, schema: str, prepare: Callable[[], Callable[[bytes], tuple]], *columns: str
) -> DataFrame:
    """`columns` beside what a function of one text returns; `prepare` runs once per task.

    Rows stay where they are read: no shuffle, and the results of `SLICE_ROWS` texts in memory at a time.
    """
    spark_schema = df.sparkSession.createDataFrame([], schema).schema
    names = [f.name for f in spark_schema][len(columns) :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = prepare()
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                made = zip(*(measure(text) for text in batch.column("text").to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c) for c in columns),
                        *(pa.array(v, type=t) for v, t in zip(made, types, strict=True)),
                    ],
                    names=[*columns, *names],
                )

    types = [_arrow(f.dataType.simpleString()) for f in spark_schema][len(columns) :]
    return texts(df, *columns).mapInArrow(run, spark_schema)


def _arrow(kind: str) -> pa.DataType:
    inner = re.fullmatch(r"array<(.*)>", kind)
    if inner:
        return pa.list_(_arrow(inner[1]))
    return {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "float": pa.float32(),
        "string": pa.string(),
        "binary": pa.binary(),
        "boolean": pa.bool_(),
    }[kind]


def id_remainder(column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; null ids fall in no part."""
    return F.crc32(F.col(column).cast("string")) % parts


def training_labels(labels: DataFrame, name: str, held_out: Column) -> DataFrame:
    """One label per id from the rows that may be learned from; contradicting rows give no label."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(name).isNotNull() & ~held_out)
    found = known.groupBy("doc_id").agg(F.min(name).alias("label"), F.max(name).alias("_most"))
    return found.filter("label = _most and label in (0, 1)").select("doc_id", F.col("label").cast("int"))
