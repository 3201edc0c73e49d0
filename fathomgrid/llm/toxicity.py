"""Toxicity: class-conditional Kneser-Ney models of characters within words.

A word (a run of ASCII letters and non-ASCII characters, lower case) is read as windows of six characters with start and end marks. Windows of
all documents are counted, apart from those of labelled rows that may be learned from. Backoff is shared
by both classes: corpus windows, discounted, back off to three-character windows counted by how many
windows they continue, and those to single characters counted likewise. A class's own counts, discounted,
sit on top of the shared probabilities with a few pseudo-counts, so where a class has seen little both
classes agree and a rare word says nothing.

A word's evidence is its toxic minus ordinary log-likelihood beyond `MARGIN`; a document's is the sum
over its words, normalised by the square root of their number. A logistic over it, fitted on the learned
rows, gives the score.

Every window counts: ratios are a stored table, joined to the windows of words, and the evidence of words is
joined to the words of documents. Tasks hold `BUCKETS` upper bounds of ratios, which only spare the joins:
a word whose bounds stay within the margin has no evidence. Ratios are summed in whole units of 2^-28, so
sums do not depend on their order.

Bounds: at most about `MOST_LABELLED` labelled ids are learned from (a sample by hash beyond that). Counts
cover every document.

Null texts count as empty; texts without words have evidence 0 and are scored by the logistic. Rows without
an id are scored, never learned from. Contradicting labels of an id are left out. With at most one class
known among the rows every score is the smoothed share of label 1, 0.1 without labels. Repeated rows each give a row.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomgrid.llm.common import GROUP_BYTES, SLICE_ROWS, store, texts, training_labels

ORDER = 6
SHORT = 3
DISCOUNT = 0.75
PSEUDO = 20.0
MARGIN = 2.0
REJECT_AT = 0.5
MOST_LABELLED = 200_000
UNIT = 1 << 28
BUCKETS = 1 << 22
BIN = 0.01
BINS = 20_000

START, END = "^", "$"
_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_PRIME = 0x100000001B3
_HELD_WORDS = 200_000
_HELD_WINDOWS = 200_000


def words_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and non-ASCII characters, A-Z in lower case."""
    return text.translate(_LETTERS).split()


def spelled(words: Iterable[bytes]) -> list[str]:
    """Words as text in lower case."""
    return [w.decode("utf-8", "replace").lower() for w in words]


def windows(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the marked words, and start and word number of each window."""
    marked = "".join(START * (ORDER - 1) + w + END for w in words)
    points = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    made = np.fromiter(map(len, words), np.int64, len(words)) + 1
    sizes = made + ORDER - 1
    first = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(words)), made)
    within = np.arange(len(word)) - np.repeat(np.cumsum(made) - made, made)
    return points, first[word] + within, word


def window_hashes(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit number per window of six characters."""
    h = np.full(len(starts), 0xCBF29CE484222325, dtype=np.uint64)
    for k in range(ORDER):
        h = (h ^ points[starts + k].astype(np.uint64)) * np.uint64(_PRIME)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _count_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds: list[Counter] = [Counter(), Counter(), Counter()]

    def flush() -> pa.RecordBatch:
        words = list(kinds[2])
        weights = [np.fromiter((k[w] for w in words), np.int64, len(words)) for k in kinds]
        for k in kinds:
            k.clear()
        points, starts, word = windows(spelled(words))
        hashes = window_hashes(points, starts)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        shown = np.lib.stride_tricks.sliding_window_view(points, ORDER)[starts[first]]
        text = np.ascontiguousarray(shown).view(f"<U{ORDER}").ravel()
        sums = [np.bincount(which, w[word], len(first)).astype(np.int64) for w in weights]
        return pa.RecordBatch.from_arrays(
            [pa.array(text.tolist(), pa.string()), pa.array(hashes[first]), *map(pa.array, sums)],
            names=["gram", "hash", "ordinary", "toxic", "everywhere"],
        )

    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            words = words_of(text)
            kinds[2].update(words)
            if label is not None:
                kinds[label].update(words)
            if len(kinds[2]) > _HELD_WORDS:
                yield flush()
    if kinds[2]:
        yield flush()


def window_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """gram, hash, ordinary, toxic, everywhere: counts of every window of every document."""
    # At most about MOST_LABELLED rows of an id and a label: broadcast by that bound.
    known = docs.join(F.broadcast(labels), "doc_id", "left")
    counted = texts(known, "label").mapInArrow(
        _count_windows, "gram string, hash bigint, ordinary bigint, toxic bigint, everywhere bigint"
    )
    return counted.groupBy("gram", "hash").agg(
        *(F.sum(c).alias(c) for c in ("ordinary", "toxic", "everywhere"))
    )


def _discounted(count: Column, total: Column, kinds: Column, lower: Column) -> Column:
    return F.greatest(count - DISCOUNT, F.lit(0.0)) / total + F.lit(DISCOUNT) * kinds / total * lower


def window_ratios(counts: DataFrame) -> DataFrame:
    """gram, hash, everywhere, ratio: toxic minus ordinary log-probability of a window's last character."""
    tail = counts.withColumn("tail", F.substring("gram", -SHORT, SHORT))
    short = tail.groupBy("tail").agg(F.count(F.lit(1)).alias("continued"))
    short = short.withColumn("head", F.substring("tail", 1, SHORT - 1)).withColumn("last", F.substring("tail", -1, 1))
    single = short.groupBy("last").agg(F.count(F.lit(1)).alias("single"))
    of_all, characters = single.agg(F.coalesce(F.sum("single"), F.lit(1)), F.count(F.lit(1))).first()
    floor = F.lit(1.0 / (characters + 1.0))
    single = single.select("last", _discounted(F.col("single"), F.lit(of_all), F.lit(characters), floor).alias("p1"))
    heads = short.groupBy("head").agg(F.sum("continued").alias("head_total"), F.count(F.lit(1)).alias("head_kinds"))
    short = short.join(heads, "head").join(single, "last").select(
        "tail", _discounted(F.col("continued"), F.col("head_total"), F.col("head_kinds"), F.col("p1")).alias("p3")
    )
    context = F.substring("gram", 1, ORDER - 1)
    contexts = counts.groupBy(context.alias("context")).agg(
        F.sum("everywhere").alias("total"),
        F.count(F.lit(1)).alias("kinds"),
        F.sum("ordinary").alias("ordinary_total"),
        F.sum((F.col("ordinary") > 0).cast("int")).alias("ordinary_kinds"),
        F.sum("toxic").alias("toxic_total"),
        F.sum((F.col("toxic") > 0).cast("int")).alias("toxic_kinds"),
    )
    joined = tail.withColumn("context", context).join(contexts, "context").join(short, "tail")
    joined = joined.withColumn("p6", _discounted(F.col("everywhere"), F.col("total"), F.col("kinds"), F.col("p3")))

    def own(name: str) -> Column:
        seen = F.greatest(F.col(name) - DISCOUNT, F.lit(0.0))
        return (seen + (F.lit(DISCOUNT) * F.col(f"{name}_kinds") + PSEUDO) * F.col("p6")) / (F.col(f"{name}_total") + PSEUDO)

    return joined.select("gram", "hash", "everywhere", F.log(own("toxic") / own("ordinary")).alias("ratio"))


def ratio_bounds(ratios: DataFrame, buckets: int) -> np.ndarray:
    """The largest ratio of a window per bucket of hashes; `ratios` has hash and units of every window."""
    bucket = F.pmod("hash", F.lit(buckets)).cast("int")
    most = ratios.groupBy(bucket.alias("bucket")).agg(F.max("units").alias("units")).filter("units != 0")
    # At most one row per bucket.
    found = most.select("bucket", (F.col("units") / UNIT).cast("float").alias("most")).toArrow()
    bounds = np.zeros(buckets, dtype=np.float32)
    bounds[found.column("bucket").to_numpy()] = np.nextafter(found.column("most").to_numpy(), np.float32(np.inf))
    return bounds


def _suspects(bounds: np.ndarray):
    """Adds to rows (..., text) their number of words, and key, word and times of those that may have evidence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bytes | None] = {}

        def look(lists: list[list[bytes]]) -> list[list[tuple[bytes, bytes, int]]]:
            words = set().union(*lists)
            if len(known) > _HELD_WORDS:  # Memory only: words are looked at anew.
                known.clear()
            new = list(words - known.keys())
            if new:
                points, starts, word = windows(spelled(new))
                most = bounds[window_hashes(points, starts) % len(bounds)]
                may = np.bincount(word, most, len(new)) > MARGIN
                known.update(
                    (w, hashlib.blake2b(w, digest_size=16).digest() if m else None)
                    for w, m in zip(new, may.tolist(), strict=True)
                )
            return [[(known[w], w, n) for w, n in Counter(filter(known.__getitem__, ws)).items()] for ws in lists]

        def made(rows: pa.RecordBatch, lists: list[list[bytes]]) -> pa.RecordBatch:
            found = [[{"key": k, "word": w, "times": n} for k, w, n in ws] for ws in look(lists)]
            kind = pa.list_(pa.struct([("key", pa.binary()), ("word", pa.binary()), ("times", pa.int64())]))
            return pa.RecordBatch.from_arrays(
                [*rows.columns[:-1], pa.array([len(ws) for ws in lists], pa.int64()), pa.array(found, kind)],
                names=[*rows.schema.names[:-1], "words", "suspects"],
            )

        for batch in batches:
            lists: list[list[bytes]] = []
            at, size = 0, 0
            for text in batch.column("text").to_pylist():
                lists.append(words_of(text))
                size += len(text)
                if size > GROUP_BYTES:
                    yield made(batch.slice(at, len(lists)), lists)
                    at, lists, size = at + len(lists), [], 0
            if lists:
                yield made(batch.slice(at), lists)

    return run


def _word_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, hash and times of the windows of each word."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            keys = part.column("key").cast(pa.binary())
            points, starts, word = windows(spelled(part.column("word").to_pylist()))
            hashes = window_hashes(points, starts)
            for low in range(0, len(starts), _HELD_WINDOWS):
                own = slice(low, low + _HELD_WINDOWS)
                # A window that repeats in a word of many is one row.
                pairs, times = np.unique(np.column_stack([word[own], hashes[own]]), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(pairs[:, 0])), pa.array(pairs[:, 1]), pa.array(times.astype(np.int64))],
                    names=["key", "hash", "times"],
                )


def word_evidence(words: DataFrame, ratios: DataFrame) -> DataFrame:
    """key, evidence in units beyond the margin, of those distinct words (key, word) that have any."""
    each = words.mapInArrow(_word_windows, "key binary, hash bigint, times bigint")
    sums = each.join(ratios, "hash").groupBy("key").agg(F.sum(F.col("times") * F.col("units")).alias("units"))
    margin = int(MARGIN * UNIT)
    return sums.filter(F.col("units") > margin).select("key", (F.col("units") - margin).alias("evidence"))


def evidence(docs: DataFrame, ratios: DataFrame, columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """`columns` and normalised evidence per row of `docs`; `ratios` has gram, hash and ratio of all its windows."""
    units = F.round(F.col("ratio") * UNIT).cast("bigint")
    ratios = store(ratios.select("hash", units.alias("units")), "ratios")
    suspect = T.StructType().add("key", T.BinaryType()).add("word", T.BinaryType()).add("times", T.LongType())
    shape = T.StructType([*docs.select(*columns).schema, T.StructField("row", T.LongType())])
    shape = shape.add("words", T.LongType()).add("suspects", T.ArrayType(suspect))
    numbered = texts(docs.withColumn("row", F.monotonically_increasing_id()), *columns, "row")
    rows = store(numbered.mapInArrow(_suspects(ratio_bounds(ratios, buckets)), shape), "suspects")
    each = rows.select("row", F.inline("suspects"))
    # Windows of which nothing follows are left out of the join: their ratio is 0.
    known = word_evidence(each.groupBy("key").agg(F.first("word").alias("word")), ratios.filter("units != 0"))
    sums = each.select("row", "key", "times").join(store(known, "evidence"), "key").groupBy("row")
    sums = sums.agg(F.sum(F.col("times") * F.col("evidence")).alias("sum"))
    norm = F.sqrt(F.greatest(F.col("words"), F.lit(1)).cast("double"))
    found = (F.coalesce(F.col("sum"), F.lit(0)) / F.lit(float(UNIT))) / norm
    return rows.drop("suspects").join(sums, "row", "left").select(*columns, found.alias("evidence"))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps with a slight ridge."""
    a = np.zeros(2)
    z = np.column_stack([x, np.ones(len(x))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ a, -500, 500)))
        gradient = z.T @ (weight * (p - y)) + 1e-3 * a
        curve = (z * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        size = np.abs(step).max()
        a = a - step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-8:
            break
    return float(a[0]), float(a[1])


def _share(toxic: float, n: float) -> float:
    """The share of label 1, smoothed toward a small one: where nothing was learned nothing is rejected."""
    return float((toxic + 0.1) / (n + 1))


def scored(docs: DataFrame, labels: DataFrame, columns: dict[str, Column], most_labelled: int = MOST_LABELLED) -> DataFrame:
    """`columns`, expressions over `docs`, and the score of each of its rows.

    `labels` has doc_id and label 0 or 1, of rows that may be learned from.
    """
    wanted = [c.alias(name) for name, c in columns.items()]
    n, toxic = labels.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if toxic in (0, n):
        return docs.select(*wanted, F.lit(_share(toxic, n)).alias("score"))
    if n > most_labelled:
        dice = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        labels = labels.filter(dice < most_labelled / n)
    labels = store(labels, "labels")
    counts = store(window_counts(docs.select("doc_id", "text"), labels), "windows")
    named = docs.select(F.col("doc_id").alias("__id"), "text", *wanted)
    known = labels.withColumnRenamed("doc_id", "__id")
    # At most about MOST_LABELLED rows, as above.
    named = named.join(F.broadcast(known.withColumnRenamed("label", "__label")), "__id", "left")
    found = store(evidence(named, window_ratios(counts), [*columns, "__label"]), "scored")
    bin = F.least(F.floor(F.col("evidence") / BIN), F.lit(BINS))
    # Two rows per bin at most.
    seen = found.filter("__label is not null").groupBy("__label", bin.alias("bin")).count().collect()
    bins = np.array([tuple(r) for r in seen], dtype=float).reshape(-1, 3)
    n, toxic = bins[:, 2].sum(), bins[bins[:, 0] == 1, 2].sum()
    if toxic in (0, n):
        return found.select(*columns, F.lit(_share(toxic, n)).alias("score"))
    slope, offset = _logistic((bins[:, 1] + 0.5) * BIN, bins[:, 0], bins[:, 2])
    score = 1.0 / (1.0 + F.exp(-(F.lit(slope) * F.col("evidence") + F.lit(offset))))
    return found.select(*columns, score.alias("score"))


def toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, reject_at: float = REJECT_AT) -> DataFrame:
    """doc_id, held_out, score, predicted per row of `docs`; `held_out` is an expression over doc_id."""
    columns = {"doc_id": F.col("doc_id"), "held_out": F.coalesce(held_out, F.lit(False))}
    found = scored(docs, training_labels(labels, "toxic", held_out), columns)
    return found.withColumn("predicted", (F.col("score") >= reject_at).cast("int"))
