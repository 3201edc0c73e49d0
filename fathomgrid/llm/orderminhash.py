"""Document fingerprints by Order MinHash, in built-in functions only.

A text is its words; three consecutive words are a k-mer (fewer words: the whole text is one). The j-th
occurrence of a k-mer is numbered j, so repetitions count. One hash of (k-mer, number) orders all of them,
and its range is cut into 32 parts; each part selects the two smallest at or after its start, going round at
the end, so short texts fill every part. The two, in the order of the text, are hashed together: an entry
agrees only where two texts share the same k-mers in the same order. Likeness is the share of equal entries.

Hash and place in the text are packed in one 64-bit number (38 and 26 bits), so sorting compares numbers. In
texts of more than 2^26 words places are taken modulo 2^26.

Null texts count as empty; texts without words share one fingerprint. Rows are ordered by descending id,
null last, then by a hash of the text; after the last comes the first, and a single row is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KMER = 3
PARTS_BITS = 5
PARTS = 1 << PARTS_BITS
PLACE_BITS = 26
PLACE = (1 << PLACE_BITS) - 1
RANGE_ROWS = 20_000
MOST_RANGES = 20_000


def _pick(array: Column, at: Column) -> Column:
    return F.get(array, at)


def _packed(number: Column, place: Column) -> Column:
    return F.shiftleft(number, PLACE_BITS).bitwiseOR(place.bitwiseAND(F.lit(PLACE).cast("bigint")))


def _hash_of(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS)


def _runs(array: Column, same: int) -> Column:
    """Where runs of numbers equal above their lowest `same` bits begin."""
    return F.filter(
        F.sequence(F.lit(0), F.size(array) - 1),
        lambda i: (i == 0) | (F.shiftright(_pick(array, i), same) != F.shiftright(_pick(array, i - 1), same)),
    )


def with_signature(df: DataFrame, text: str, name: str) -> DataFrame:
    """`df` with an array of `PARTS` numbers; steps are columns, so each is computed once."""
    none = F.array().cast("array<bigint>")
    rest = list(df.columns)
    words = F.array_remove(F.split(F.col(text), "[\\x20\\x09-\\x0D]+"), "")
    df = df.select(*rest, words.alias("__w"))
    n, w = F.size("__w"), F.col("__w")
    several = F.transform(
        F.sequence(F.lit(0), n - KMER),
        lambda i: _packed(F.xxhash64(*(_pick(w, i + k) for k in range(KMER))), i.cast("bigint")),
    )
    single = F.array(_packed(F.xxhash64(F.concat_ws(" ", w)), F.lit(0).cast("bigint")))
    kmers = F.when(n >= KMER, several).when(n > 0, single).otherwise(none)
    df = df.select(*rest, F.sort_array(kmers).alias("__s"))
    s = F.col("__s")
    df = df.select(*rest, "__s", F.when(F.size(s) > 0, _runs(s, PLACE_BITS)).otherwise(F.array().cast("array<int>")).alias("__r"))
    r = F.col("__r")

    def numbered(x: Column, j: Column) -> Column:
        return _packed(F.xxhash64(_hash_of(x), j), x)

    # Most texts repeat no k-mer; then every occurrence is the first.
    once = F.transform(s, lambda x: numbered(x, F.lit(0)))
    runs = F.transform(
        r,
        lambda at, i: F.transform(
            F.slice(s, at + 1, F.coalesce(_pick(r, i + 1), F.size(s)) - at), lambda x, j: numbered(x, j)
        ),
    )
    df = df.select(*rest, F.sort_array(F.when(F.size(r) == F.size(s), once).otherwise(F.flatten(runs))).alias("__k"))
    k = F.col("__k")
    top = 64 - PARTS_BITS
    df = df.select(*rest, "__k", F.when(F.size(k) > 0, _runs(k, top)).otherwise(F.array().cast("array<int>")).alias("__p"))
    # The part each first number lies in, beside its place in the order.
    parts = F.transform("__p", lambda i: F.struct(F.shiftright(_pick(k, i), top).alias("part"), i.alias("at")))
    df = df.select(*rest, "__k", parts.alias("__p"))

    def entry(part: Column) -> Column:
        at = F.coalesce(_pick(F.filter("__p", lambda p: p["part"] >= part), F.lit(0))["at"], F.lit(0))
        return F.struct(_pick(k, at).alias("a"), _pick(k, F.when(at + 1 < F.size(k), at + 1).otherwise(F.lit(0))).alias("b"))

    half = PARTS // 2
    chosen = F.transform(F.sequence(F.lit(-half), F.lit(half - 1)), lambda part: entry(part.cast("bigint")))
    df = df.select(*rest, F.when(F.size(k) > 0, chosen).alias("__c"))

    def ordered(c: Column) -> Column:
        first = c["a"].bitwiseAND(F.lit(PLACE).cast("bigint")) <= c["b"].bitwiseAND(F.lit(PLACE).cast("bigint"))
        return F.when(first, F.xxhash64(_hash_of(c["a"]), _hash_of(c["b"]))).otherwise(
            F.xxhash64(_hash_of(c["b"]), _hash_of(c["a"]))
        )

    empty = F.array_repeat(F.lit(0).cast("bigint"), PARTS)
    return df.select(*rest, F.coalesce(F.transform("__c", ordered), empty).alias(name))


def as_text(signature: Column) -> Column:
    """Eight hexadecimal digits per entry."""
    low = F.lit((1 << 32) - 1).cast("bigint")
    return F.concat_ws("", F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(low))), 8, "0")))


def likeness(a: Column, b: Column) -> Column:
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return equal / F.lit(float(PARTS))


def _bucket(bounds: list[int]) -> Column:
    """Bounds at or below the id, -1 without an id; two steps, so the work is a root of their number."""
    if not bounds:
        return F.when(F.col("doc_id").isNull(), -1).otherwise(0)
    step = max(1, int(len(bounds) ** 0.5))
    fine = F.array(*map(F.lit, bounds))
    coarse = F.array(*map(F.lit, bounds[::step]))
    passed = F.size(F.filter(coarse, lambda b: b <= F.col("doc_id")))
    start = F.greatest(passed - 1, F.lit(0)) * step
    within = F.size(F.filter(F.slice(fine, start + 1, F.lit(step)), lambda b: b <= F.col("doc_id")))
    return F.when(F.col("doc_id").isNull(), -1).otherwise(start + within)


def with_next(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, text, signature and text and signature of the next document by descending id.

    Documents are dealt by range of ids, one shuffle of the texts, and look ahead within their range. The
    last of a range looks at the first of the next, of which there is one per range.
    """
    rows = docs.count()
    ranges = min(MOST_RANGES, -(-rows // range_rows))
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    found = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 10 * ranges))).first()[0] if ranges > 1 else []
    bounds = sorted(set(found or []))
    at = _bucket(bounds)
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("bucket", at)
    # One row per range at most, so it may pass through the driver.
    tops = {
        r["bucket"]: r["top"]
        for r in docs.select("doc_id", at.alias("bucket")).groupBy("bucket").agg(F.max("doc_id").alias("top")).collect()
    }
    order = sorted(tops, reverse=True)
    spark = docs.sparkSession
    after = [(b, order[(i + 1) % len(order)]) for i, b in enumerate(order)]
    steps = F.broadcast(spark.createDataFrame(after, "before int, bucket int"))
    firsts = base.filter(F.col("doc_id").isin([t for t in tops.values() if t is not None]) | F.col("doc_id").isNull())
    firsts = firsts.groupBy("bucket").agg(
        F.min_by("text", F.struct((-F.col("doc_id")).alias("d"), F.xxhash64("text").alias("h"))).alias("head_text")
    )
    heads = with_signature(firsts, "head_text", "head_signature").join(steps, "bucket").select(
        F.col("before").alias("bucket"), "head_text", "head_signature"
    )
    signed = with_signature(base, "text", "signature")
    line = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    looked = signed.select(
        "*",
        F.lead("text").over(line).alias("next_text"),
        F.lead("signature").over(line).alias("next_signature"),
    )
    edge = F.when(F.col("next_text").isNull(), F.col("bucket"))
    joined = looked.withColumn("edge", edge).join(heads.withColumnRenamed("bucket", "edge"), "edge", "left")
    return joined.select(
        "doc_id",
        "text",
        "signature",
        F.coalesce("next_text", "head_text").alias("next_text"),
        F.coalesce("next_signature", "head_signature").alias("next_signature"),
    )


def fingerprints(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next document's are."""
    looked = with_next(docs, range_rows)
    chars = F.length("text")
    moved = F.floor(chars / 3).cast("int")
    edited = looked.withColumn("edited", F.concat(F.left("text", chars - moved), F.left("next_text", moved)))
    kept = edited.select("doc_id", chars.cast("bigint").alias("n_chars"), "edited", "signature", "next_signature")
    signed = with_signature(kept, "edited", "edited_signature")
    return signed.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        as_text(F.col("signature")).alias("fingerprint"),
        as_text(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )
