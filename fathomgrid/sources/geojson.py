"""GeoJSON files of ping positions."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fathomgrid import schemas
from fathomgrid.functions import times
from fathomgrid.operators import gps
from fathomgrid.operators.ordered import Layout
from fathomgrid.session import few_listing_tasks, stored
from fathomgrid.sources import stores
from fathomgrid.sources.folders import TextFile, folder_columns, write_folders


_AS_JSON = {"ignoreNullFields": "false"}
FOLDERS = ["cruise", "file_name"]


def write_features(aligned: DataFrame, path: str) -> None:
    """Features as newline-delimited JSON, one per ping, below cruise=/file_name= folders.

    Rewriting a file's positions replaces its folder and no other.
    """
    lines = gps.features(aligned).select("cruise", "file_name", F.to_json("feature", _AS_JSON).alias("value"))
    rows = lines.withColumns(folder_columns(FOLDERS)).sortWithinPartitions(*FOLDERS)
    write_folders(rows, FOLDERS, path, TextFile, ".txt")


def write_collections(aligned: DataFrame, path: str, layout: Layout | None = None) -> None:
    """One FeatureCollection per file, line by line, below cruise=/file_name= folders.

    Lines are dealt by range of file and ping, so a hot file is written by several tasks: its document is then the
    part files of its folder in the order of their names. `export_documents` makes single files of them.
    """
    order = [*FOLDERS, "part", "ping_idx"]
    lines = gps.collection_lines(aligned, layout=layout).withColumns(folder_columns(FOLDERS))
    rows = lines.repartitionByRange(*order).sortWithinPartitions(*order).select(*FOLDERS, F.col("line").alias("value"))
    write_folders(rows, FOLDERS, path, TextFile, ".txt")


COPY_BYTES = 8_000_000


def export_documents(spark: SparkSession, path: str, target: str, name: str = "geo.json") -> DataFrame:
    """Each file's document as one object, `target`/cruise/file_name/`name`: cruise, file_name, parts and bytes.

    A task appends the parts of a document block by block, so what it holds is one block however long the document
    is. Nothing is parsed on the way. Part files are found by Spark's listing, their contents are not read by it.
    """
    # Names of folders are text: Spark would try each for a number and a time, one by one in its driver.
    named = StructType([*schemas.FILE_CONTENT, *(StructField(c, StringType()) for c in FOLDERS)])
    with few_listing_tasks(spark):
        listed = spark.read.format("binaryFile").schema(named).option("pathGlobFilter", "part-*").load(path)
    parts = (
        listed.select("cruise", "file_name", "path")
        .groupBy("cruise", "file_name")
        .agg(F.sort_array(F.collect_list(F.substring_index("path", "/", -1))).alias("names"), F.min("path").alias("path"))
    )
    into = stores.address_in(spark, target)
    settings = stores.settings_of(spark)

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = into.open()
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                origin = stores.address(unquote(row["path"].rpartition("/")[0]), settings)
                source, folder = origin.open(), f"{into.folder}/{row['cruise']}/{row['file_name']}"
                if into.kind == "local":
                    store.create_dir(folder)
                size = 0
                with store.open_output_stream(f"{folder}/{name}") as out:
                    for part in row["names"]:
                        with source.open_input_stream(f"{origin.folder}/{part}") as read:
                            while block := read.read(COPY_BYTES):
                                out.write(block)
                                size += len(block)
                made.append((row["cruise"], row["file_name"], len(row["names"]), size))
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
            columns = zip(*made, strict=True) if made else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(columns, kinds, strict=True)], names=["cruise", "file_name", "parts", "bytes"]
            )

    copied = parts.repartition("cruise", "file_name").mapInArrow(
        copy, "cruise string, file_name string, parts int, bytes long"
    )
    return stored(copied, "exported")


def _positions(features: DataFrame, folders: list[str]) -> DataFrame:
    return features.select(
        *folders,
        "f.id",
        F.col("f.properties.latitude").alias("latitude"),
        F.col("f.properties.longitude").alias("longitude"),
        F.col("f.geometry").alias("geometry"),
    )


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Stored features: id, position, geometry, and the folder columns."""
    with few_listing_tasks(spark):
        rows = spark.read.schema(schemas.FEATURE).json(path)
    own = [f.name for f in schemas.FEATURE]
    folders = [c for c in rows.columns if c not in own]
    return _positions(rows.select(*folders, F.struct(*own).alias("f")), folders)


def read_collections(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Features of all collections below `path`: id, position, geometry, and the folder columns.

    Documents are read line by line, in as many tasks as they are long: either a document is one line, or it has a
    feature per line, as `write_collections` and `export_documents` leave it. `multi_line` reads one pretty-printed
    document per file instead, whole.
    """
    if multi_line:
        documents = spark.read.schema(schemas.FEATURE_COLLECTION).option("multiLine", "true").json(path)
        folders = [c for c in documents.columns if c not in ("type", "features")]
        return _positions(documents.select(*folders, F.explode("features").alias("f")), folders)
    with few_listing_tasks(spark):
        lines = spark.read.option("recursiveFileLookup", "false").text(path)
    folders = [c for c in lines.columns if c != "value"]
    value = F.regexp_replace(F.trim("value"), "^,", "")
    feature = F.from_json(value, schemas.FEATURE)
    whole = F.from_json(value, schemas.FEATURE_COLLECTION)["features"]
    is_document = value.startswith('{"type":"FeatureCollection"') & value.endswith(gps.COLLECTION_TAIL)
    found = lines.filter(~value.isin(gps.COLLECTION_HEAD, gps.COLLECTION_TAIL, "")).select(
        *folders, F.explode(F.when(is_document, whole).otherwise(F.array(feature))).alias("f")
    )
    return _positions(found, folders)


def spatiotemporal_index(features: DataFrame) -> DataFrame:
    """Features with a position, with their time and epoch seconds; any missing part drops them."""
    ping_time = F.to_timestamp("id")
    return (
        features.dropna(subset=["latitude", "longitude"])
        .filter(F.col("geometry").isNotNull())
        .withColumn("ping_time", ping_time)
        .withColumn("epoch_seconds", times.epoch_seconds(F.col("ping_time")))
    )
