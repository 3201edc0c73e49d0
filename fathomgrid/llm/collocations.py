"""Phrase collocations by language: n-grams counted in counting quotient filters.

1. Each task turns its texts into shards of bounded size: the shard's words, their counts, and the text as places in
   that word list. Word counts add up to a dictionary; words that are frequent enough get consecutive ids over all
   languages. A phrase is never more frequent than a word in it, so an n-gram with another word can be no
   candidate, and no part of one.
2. Each shard learns the ids of its own words, so no task needs the whole dictionary. Its 2- and 3-grams are packed
   from the ids, permuted invertibly and counted in a filter, which is cut into buckets of the quotient.
3. Filters of one bucket are merged across shards. Permuted keys are spread evenly, and a frequent phrase is one
   counter per filter, so buckets are alike whatever the text; their number grows with the text.
4. Candidates get the counts of their parts by joins and are scored in exact decimal arithmetic.

Null and empty texts have no words. A null language counts as `und`. Texts of any length are read in windows. Ties in
score go by count, then phrase bytewise. Repeated rows count as often as they stand there. An empty table, or
one without candidates, gives no rows. Only `lang` and `text` are read, so further columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomgrid.llm import quotientfilter as qf
from fathomgrid.llm.common import store
from fathomgrid.llm.ordinals import ordinals

LEAST = 10
"""Occurrences a candidate has at least."""

BEST = 2000
"""Phrases reported per language."""

NO_LANGUAGE = "und"
ABSORBED_PERCENT = 50
SHARD_BYTES = 8_000_000
WINDOW_BYTES = 2_000_000
BUCKET_COUNTERS = 1 << 19
"""Occurrences per bucket, about, and so the most counters that a merge holds."""
HELD_COUNTERS = 1 << 20

DENSE = {"compression": "zstd"}
"""How the large intermediate tables are written, whatever the session names."""

# Lower-cases A-Z; what ends a piece becomes a full stop, a tab a space.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else 46 if b in b",;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)
)
_BREAK = b"."

_SHARD = "shard bigint, lang string, words array<string>, counts array<bigint>, places binary"
_FILTER = "length int, bucket bigint, filter binary"
_GRAM = "length int, w0 bigint, w1 bigint, w2 bigint, a bigint"


class _Places(dict):
    """Place of each word in the order of appearance; 0 is the break between pieces."""

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        return place


class _Shard:
    """Words and places of one language."""

    def __init__(self):
        self.places = _Places({_BREAK: 0})
        self.runs: list[np.ndarray] = []

    def add(self, text: bytes) -> None:
        """Take in a whole text, window by window; windows end at spaces, so none cuts a word."""
        at = 0
        while at < len(text):
            end = text.find(b" ", at + WINDOW_BYTES)
            end = len(text) if end < 0 else end
            words = text[at:end].translate(_PLAIN).replace(_BREAK, b" . ").split()
            self.runs.append(np.fromiter(map(self.places.__getitem__, words), np.int32, len(words)))
            at = end
        self.runs.append(np.zeros(1, np.int32))

    def row(self, lang: str) -> tuple:
        places = np.concatenate(self.runs)
        counts = np.bincount(places, minlength=len(self.places))[1:]
        words = [w.decode("utf-8", "replace") for w in self.places if w != _BREAK]
        return lang, words, counts, places.astype("<i4").tobytes()


def shards(docs: DataFrame) -> DataFrame:
    """One row per language of each shard of texts."""

    def rows(held: dict[str, _Shard], number: int) -> Iterator[pa.RecordBatch]:
        for lang in held:
            name, words, counts, places = held[lang].row(lang)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([name], pa.string()),
                    pa.array([words], pa.list_(pa.string())),
                    pa.array([counts], pa.list_(pa.int64())),
                    pa.array([places], pa.binary()),
                ],
                names=["shard", "lang", "words", "counts", "places"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[str, _Shard] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                lang, text = lang.as_py(), text.as_py()
                if lang not in held:
                    held[lang] = _Shard()
                held[lang].add(text)
                size += len(text)
                if size >= SHARD_BYTES:
                    yield from rows(held, number)
                    held, size, number = {}, 0, number + 1
        yield from rows(held, number)

    read = docs.select(
        F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), F.col("text").cast("binary").alias("text")
    )
    return read.filter(F.col("text").isNotNull()).mapInArrow(run, _SHARD)


def gram_keys(bits: int, length: int) -> qf.Keys:
    """Widths of packed n-grams of ids of `bits` bits; what the middle id of three adds is divided."""
    return qf.Keys(length * bits // 2, length * bits - length * bits // 2)


def packed(ids: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) == 2:
        return ids[0], ids[1]
    # The middle id's upper half goes left, the rest right.
    lower = bits - bits // 2
    b, low = np.uint64(bits), np.uint64(lower)
    return (ids[0] << np.uint64(bits // 2)) | (ids[1] >> low), ((ids[1] & qf._mask(lower)) << b) | ids[2]


def unpacked(left: np.ndarray, right: np.ndarray, bits: int, length: int) -> list[np.ndarray]:
    if length == 2:
        return [left, right]
    upper, lower, b = np.uint64(bits // 2), np.uint64(bits - bits // 2), np.uint64(bits)
    middle = ((left & qf._mask(bits // 2)) << lower) | (right >> b)
    return [left >> upper, middle, right & qf._mask(bits)]


def grams(ids: np.ndarray, length: int, bits: int) -> qf.Counters:
    """Filter of the n-grams of consecutive ids; 0 is no id."""
    keys = gram_keys(bits, length)
    n = max(0, len(ids) - length + 1)
    parts = [ids[k : k + n] for k in range(length)]
    whole = np.flatnonzero(np.logical_and.reduce([p != 0 for p in parts])) if n else np.zeros(0, np.int64)
    return qf.counted(keys, *keys.permuted(*packed([p[whole] for p in parts], bits)))


def filters(known: DataFrame, bits: int, bucket_bits: dict[int, int]) -> DataFrame:
    """Filters by bucket of shards (places, known), where `known` lists (place, id) of the shard's frequent words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[qf.Counters]] = {length: [] for length in bucket_bits}

        def flushed(length: int) -> pa.RecordBatch:
            keys, depth = gram_keys(bits, length), bucket_bits[length]
            cut = qf.buckets(keys, qf.merged(keys, held[length]), depth)
            held[length] = []
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([length] * len(cut), pa.int32()),
                    pa.array([b for b, _ in cut], pa.int64()),
                    pa.array([qf.stored_filter(keys, c, depth) for _, c in cut], pa.binary()),
                ],
                names=["length", "bucket", "filter"],
            )

        for batch in batches:
            for at in range(batch.num_rows):
                pairs = batch.column("known")[at].values
                place = np.frombuffer(batch.column("places")[at].as_py(), "<i4")
                id_of = np.zeros(int(place.max(initial=0)) + 1, np.uint64)
                id_of[pairs.field("place").to_numpy()] = pairs.field("id").to_numpy()
                ids = id_of[place]
                for length in bucket_bits:
                    held[length].append(grams(ids, length, bits))
                    if sum(map(len, held[length])) > HELD_COUNTERS:
                        # Shards that repeat each other are merged, and given away when that does not help.
                        held[length] = [qf.merged(gram_keys(bits, length), held[length])]
                        if len(held[length][0]) > HELD_COUNTERS // 2:
                            yield flushed(length)
        for length in bucket_bits:
            if held[length]:
                yield flushed(length)

    return known.mapInArrow(run, _FILTER)


def merged_filters(parts: DataFrame, bits: int, bucket_bits: dict[int, int]) -> DataFrame:
    """One filter per bucket."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        length, bucket = (k.as_py() for k in key)
        keys, depth = gram_keys(bits, length), bucket_bits[length]
        read = [qf.read_filter(keys, f, bucket, depth) for f in rows.column("filter").to_pylist()]
        whole = qf.stored_filter(keys, qf.merged(keys, read), depth)
        return pa.table(
            [pa.array([length], pa.int32()), pa.array([bucket], pa.int64()), pa.array([whole], pa.binary())],
            names=["length", "bucket", "filter"],
        )

    return parts.groupBy("length", "bucket").applyInArrow(run, _FILTER)


def frequent_grams(whole: DataFrame, bits: int, bucket_bits: dict[int, int], least: int) -> DataFrame:
    """Ids and counts of the n-grams in merged filters that occur at least `least` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                length, bucket = batch.column("length")[row].as_py(), batch.column("bucket")[row].as_py()
                keys = gram_keys(bits, length)
                found = qf.read_filter(keys, batch.column("filter")[row].as_py(), bucket, bucket_bits[length])
                found = found.part(found.count >= least)
                ids = unpacked(*keys.restored(found.quotient, found.remainder), bits, length)
                columns = [pa.array(i.astype(np.int64)) for i in ids]
                third = columns[2] if length == 3 else pa.nulls(len(found), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), length, np.int32)), *columns[:2], third, pa.array(found.count)],
                    names=["length", "w0", "w1", "w2", "a"],
                )

    return whole.mapInArrow(run, _GRAM)


def _score(a: str, left: str, right: str) -> Column:
    """floor(10^6 a^2 / (left * right)) in whole decimal numbers of 38 digits."""
    whole = lambda c: f"cast({c} as decimal(19,0))"
    return F.expr(f"cast((cast(1000000 as decimal(7,0)) * ({whole(a)} * {whole(a)})) div ({whole(left)} * {whole(right)}) as bigint)")


def scored(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Candidates that no longer one absorbs: lang, ids, a, l, r and score.

    `found`: stored (length, w0, w1, w2, a); `dictionary`: stored (id, lang, word, f).
    """
    words = dictionary.select("id", "lang", "f")
    first = words.select(F.col("id").alias("w0"), "lang", F.col("f").alias("l"))
    second = words.select(F.col("id").alias("w1"), F.col("f").alias("r"))
    pairs = found.filter("length = 2").select("w0", "w1", "a").join(first, "w0").join(second, "w1")
    pairs = store(pairs, "pairs")
    triples = found.filter("length = 3").select("w0", "w1", "w2", "a")
    head = pairs.select("w0", "w1", "lang", F.col("l").alias("l1"), F.col("a").alias("l2"))
    tail = pairs.select(
        F.col("w0").alias("w1"), F.col("w1").alias("w2"), F.col("a").alias("r1"), F.col("r").alias("r2")
    )
    triples = store(triples.join(head, ["w0", "w1"]).join(tail, ["w1", "w2"]), "triples")
    cuts = triples.withColumn("s1", _score("a", "l1", "r1")).withColumn("s2", _score("a", "l2", "r2"))
    first_cut = F.col("s1") <= F.col("s2")
    long = cuts.select(
        "lang",
        "w0",
        "w1",
        "w2",
        "a",
        F.when(first_cut, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(first_cut, F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    covers = triples.select("w0", "w1", "a").unionByName(
        triples.select(F.col("w1").alias("w0"), F.col("w2").alias("w1"), "a")
    )
    most = covers.groupBy("w0", "w1").agg(F.max("a").alias("longer"))
    short = pairs.join(most, ["w0", "w1"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < ABSORBED_PERCENT * F.col("a"))
    )
    short = short.select(
        "lang", "w0", "w1", F.lit(None).cast("bigint").alias("w2"), "a", "l", "r", _score("a", "l", "r").alias("score")
    )
    return short.unionByName(long)


def collocations(docs: DataFrame, least: int = LEAST, best: int = BEST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases."""
    cut = store(shards(docs), "shards", **DENSE)
    each = cut.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")).select(
        "shard", "lang", (F.col("at") + 1).alias("place"), F.col("w.words").alias("word"), F.col("w.counts").alias("count")
    )
    totals = store(each.groupBy("lang", "word").agg(F.sum("count").alias("f")), "words", **DENSE)
    sizes = totals.groupBy("lang").agg(F.sum("f").alias("n"))
    # Two numbers set the widths of packed n-grams and of buckets.
    frequent = F.when(F.col("f") >= least, F.col("f"))
    kinds, occurrences = totals.agg(F.count(frequent), F.coalesce(F.sum(frequent), F.lit(0))).first()
    bits = max(2, int(kinds).bit_length())
    depth = max(0, int(occurrences // BUCKET_COUNTERS).bit_length())
    bucket_bits = {length: min(depth, gram_keys(bits, length).left) for length in (2, 3)}

    numbered = ordinals(totals.filter(F.col("f") >= least), [], [F.col("lang"), F.col("word")], "dictionary")
    dictionary = store(numbered.select((F.col("ordinal") + 1).alias("id"), "lang", "word", "f"), "ids")
    known = each.select("shard", "lang", "place", "word").join(dictionary.select("id", "lang", "word"), ["lang", "word"])
    # As many entries as the shard has words, which its size bounds.
    listed = known.groupBy("shard", "lang").agg(F.collect_list(F.struct("place", "id")).alias("known"))
    shard = cut.select("shard", "lang", "places").join(listed, ["shard", "lang"]).select("places", "known")
    parts = store(filters(shard, bits, bucket_bits), "filters", **DENSE)
    whole = store(merged_filters(parts, bits, bucket_bits), "merged", **DENSE)
    found = store(frequent_grams(whole, bits, bucket_bits, least), "grams")

    ranking = store(scored(found, dictionary), "scored")
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    # Spark keeps the best of each task before the shuffle. Ties stay until their phrases can be compared.
    near = ranking.withColumn("near", F.rank().over(by_score)).filter(F.col("near") <= best)
    named = store(near.withColumn("row", F.monotonically_increasing_id()).drop("near"), "near")
    # Words of at most a few thousand phrases per language: the ids asked for meet the dictionary once.
    asked = named.select("row", F.posexplode(F.array("w0", "w1", "w2")).alias("at", "id")).filter("id is not null")
    spelled = asked.join(dictionary.select("id", "word"), "id").groupBy("row").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("at", "word")))["word"], " ").alias("phrase")
    )
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.join(spelled, "row").withColumn("rank", F.row_number().over(last).cast("bigint"))
    return ranked.filter(F.col("rank") <= best).join(sizes, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
