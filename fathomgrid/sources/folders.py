"""Tables of many small folders, written and replaced by tasks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomgrid.session import stored
from fathomgrid.sources import stores

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = {c: f"%{c:02X}" for c in [*range(1, 32), 127, *map(ord, "\"#%'*/:=?\\{[]^")]}


def folder_columns(columns: Sequence[str]) -> dict:
    """Text columns as folder names have them: these hold no null and no empty text."""
    return {c: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit(NO_VALUE)) for c in columns}


def exists(spark: SparkSession, path: str) -> bool:
    at = stores.address_in(spark, path)
    return at.open().get_file_info(at.folder).type != fs.FileType.NotFound


class TextFile:
    """Lines of a column."""

    def __init__(self, stream, schema: pa.Schema) -> None:
        self.stream = stream

    def write(self, rows: pa.RecordBatch) -> None:
        self.stream.write("".join(f"{x or ''}\n" for x in rows.column(0).to_pylist()).encode())

    def close(self) -> None:
        pass


_CODECS = {"none": "none", "uncompressed": "none", "lz4_raw": "lz4", "lz4raw": "lz4"}


class ParquetFile:
    """Rows of any columns, in groups of about `group_bytes`."""

    def __init__(self, stream, schema: pa.Schema, codec: str, group_bytes: int) -> None:
        self.writer, self.group_bytes = pq.ParquetWriter(stream, schema, compression=_CODECS.get(codec, codec)), group_bytes

    def write(self, rows: pa.RecordBatch) -> None:
        self.writer.write_batch(rows, max(1, self.group_bytes * rows.num_rows // max(1, rows.nbytes)))

    def close(self) -> None:
        self.writer.close()


def parquet_file(spark: SparkSession, group_bytes: int) -> Callable:
    """`ParquetFile` with the session's compression."""
    return partial(ParquetFile, codec=spark.conf.get("spark.sql.parquet.compression.codec").lower(), group_bytes=group_bytes)


def write_folders(rows: DataFrame, columns: Sequence[str], path: str, file: Callable, suffix: str) -> None:
    """Rows below column=value folders, as `partitionBy` with a dynamic overwrite leaves them: a folder that has rows is
    replaced, others stay. Rows of a folder are next to each other in their partition, and keep their order.

    Spark's writer gives its driver each folder to delete and rename, one after another, which for a folder per sound
    file takes longer than writing. Here tasks write below a hidden folder, and note what they wrote; when all have,
    tasks put the noted files in the place of the folders' earlier ones. A task that is run again writes other names,
    or finds moved what it had moved. `file` makes a writer from a stream and a schema.
    """
    spark, columns, names = rows.sparkSession, list(columns), [c for c in rows.columns if c not in columns]
    into, aside = stores.address_in(spark, path), f".staging-{uuid.uuid4().hex}"
    kind = into.kind

    def folder_of(values: Sequence) -> str:
        return "/".join(f"{c}={str(v).translate(_ESCAPED)}" for c, v in zip(columns, values, strict=True))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, noted, at, stream, out = into.open(), [], None, None, None
        task, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        for batch in batches:
            keys = [*zip(*(batch.column(c).to_pylist() for c in columns), strict=True)]
            begins = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
            content = batch.select(names)
            for i, j in zip(begins, [*begins[1:], len(keys)], strict=True):
                if keys[i] != at:
                    if out is not None:
                        out.close()
                        stream.close()
                    at = keys[i]
                    noted.append((folder_of(at), f"part-{task:05d}-{len(noted):06d}-{attempt}{suffix}"))
                    below, name = f"{into.folder}/{aside}/{noted[-1][0]}", noted[-1][1]
                    if kind != "s3":
                        store.create_dir(below)
                    stream = store.open_output_stream(f"{below}/{name}")
                    out = file(stream, content.schema)
                out.write(content.slice(i, j - i))
        if out is not None:
            out.close()
            stream.close()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in noted], pa.string()) for i in (0, 1)], names=["folder", "name"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = into.open()
        for batch in batches:
            for row in batch.to_pylist():
                here, there = f"{into.folder}/{aside}/{row['folder']}", f"{into.folder}/{row['folder']}"
                if kind != "s3":
                    store.create_dir(there)
                for old in store.get_file_info(fs.FileSelector(there, allow_not_found=True)):
                    if old.type == fs.FileType.File and old.base_name not in row["names"]:
                        store.delete_file(old.path)
                for x in store.get_file_info([f"{here}/{name}" for name in row["names"]]):
                    if x.type == fs.FileType.File:
                        store.move(x.path, f"{there}/{x.base_name}")
            yield batch.select(["folder"])

    noted = stored(rows.mapInArrow(write, "folder string, name string"), "written")
    byfolder = noted.groupBy("folder").agg(F.collect_list("name").alias("names"))
    byfolder.mapInArrow(place, "folder string").write.format("noop").mode("overwrite").save()
    store = into.open()
    if kind != "s3":
        store.create_dir(into.folder)
        store.create_dir(f"{into.folder}/{aside}")
        store.delete_dir(f"{into.folder}/{aside}")
    with store.open_output_stream(f"{into.folder}/_SUCCESS"):
        pass
