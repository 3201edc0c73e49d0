"""Near-duplicates by SetSketch registers: banded, estimated by likelihood, verified on full sets.

A document's set is its distinct five-word shingles (fewer words: the whole sequence). A sketch has 128
registers, floor(1 - log_b x) truncated to 16 bits, of the smallest exponentially distributed hash x: on a
scale so fine (b = 1.001) that registers of two sets agree about as often as the sets' Jaccard similarity.
Sketches merge by the larger register.

1. Texts with equal sets collapse into one class, named by the smallest id, with partial aggregation.
2. Registers are banded, 32 bands of 4; classes that share a band are candidates. A link of similarity
   0.75 escapes every band with probability 5e-6.
3. Each class is tried against the centre of its largest bucket. In buckets that hold several components then,
   whoever is not in the largest is tried against a centre of it. Large buckets are salted, with the centre
   copied to each salt.
4. Of what still shares a bucket with another component, an exact prefix filter on shingles, with bounds by size and
   place, finds who can link. Where few hold a shingle they meet as pairs. Where many do, its holders lie in
   blocks of about `BLOCK` classes, pairs of blocks meet in a task, and only links leave it. No pair is left out.
5. A pair is tried by size, then by the joint likelihood of its registers (kept within five standard errors
   of the threshold), and what is left on the full sets, in whole numbers.

Null and empty texts have an empty set and link with nothing. A row without an id links with nothing and its
component is null. Texts that share an id are one document: classes are named by their sets, and the classes of an id
are linked, so results do not depend on the order of rows. Repeated rows give a row each, very long texts go
through whole, equal sets (ties) are one class, an empty table gives no rows, and of other columns only those named
in `also` are looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomgrid.llm.common import UPPER_TO_LOWER, per_text, store
from fathomgrid.llm.components import components, extended

SHINGLE = 5
PERCENT = 75
REGISTERS = 128
BAND = 4
BASE = 1.001
RATE = 20.0
TOP = 65_535
STANDARD_ERRORS = 5.0
BLOCK = 256
BLOCK_ITEMS = 1 << 17
"""Classes and shingles of a block, about; a larger set is a block of its own or nearly so."""
FEW = 12
"""Holders of a shingle who meet as pairs; more meet in blocks."""
SALTED = 1024
"""Members of a bucket that one key of a join holds."""
_COLUMNS = 4096
_HELD = 200_000

_dice = np.random.default_rng(20240229)
_TIMES = _dice.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _dice.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)
_PLACES = _dice.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: bytes, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = text.translate(UPPER_TO_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    if len(hashes) > _HELD:  # Memory only.
        hashes.clear()
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(w) - SHINGLE + 1)
    total = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(w))):
        total += w[k : k + n] * _PLACES[k]
    return np.unique(_mixed(total))


def registers(items: np.ndarray) -> np.ndarray:
    """SetSketch of a set of 64-bit hashes."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), _COLUMNS):
        block = _TIMES[:, None] * items[None, at : at + _COLUMNS]
        block += _PLUS[:, None]
        np.minimum(least, block.min(axis=1), out=least)
    u = (least.astype(np.float64) + 0.5) / 2.0**64
    x = -np.log1p(-np.minimum(u, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(x) / math.log(BASE)), 0, TOP).astype("<u2")


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of the union."""
    return np.maximum(a, b)


def _sketcher() -> Callable[[bytes], tuple]:
    import xxhash

    hashes = _WordHashes()

    def sketch(text: bytes) -> tuple:
        items = shingles(text, hashes)
        if not len(items):
            return 0, None, None
        return len(items), xxhash.xxh3_128_digest(items.tobytes()), registers(items).tobytes()

    return sketch


def sketches(docs: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, digest of the set, registers; before them the string columns `also`."""
    named = "".join(f"{c} string, " for c in also)
    shape = f"{named}doc_id bigint, n_shingles bigint, digest binary, registers binary"
    return per_text(docs, shape, _sketcher, *also, "doc_id")


def _bands(sketch: pa.Array) -> pa.Array:
    raw = b"".join(sketch.to_pylist())
    parts = np.frombuffer(raw, "<u2").astype(np.uint64).reshape(-1, REGISTERS // BAND, BAND)
    key = np.tile(np.arange(REGISTERS // BAND, dtype=np.uint64), (len(parts), 1))
    for k in range(BAND):
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k] + np.uint64(1))
    ends = np.arange(len(parts) + 1, dtype=np.int32) * (REGISTERS // BAND)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(key.view(np.int64).ravel()))


_band_keys = F.arrow_udf(_bands, T.ArrayType(T.LongType()), F.ArrowUDFType.SCALAR)

_GRID = np.linspace(0.0, 1.0, 201)
_PAIRS = 512


def similarity(above: np.ndarray, below: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of sets of n and m items, of whose registers so many are above and below."""
    u, v = (n / (n + m))[:, None], (m / (n + m))[:, None]
    most = np.minimum(u / v, v / u)
    j = _GRID[None, :] * most

    def greater(x: np.ndarray) -> np.ndarray:
        return np.maximum(-np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE), 1e-12)

    up, down = greater(u - v * j), greater(v - u * j)
    same = np.maximum(1 - up - down, 1e-12)
    equal = (REGISTERS - above - below)[:, None]
    likely = above[:, None] * np.log(up) + below[:, None] * np.log(down) + equal * np.log(same)
    best = likely.argmax(axis=1)
    return np.take_along_axis(j, best[:, None], 1)[:, 0]


def _likely(a: pa.Array, b: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
    if not len(a):
        return pa.array([], pa.float64())
    x = np.frombuffer(b"".join(a.to_pylist()), "<u2").reshape(-1, REGISTERS)
    y = np.frombuffer(b"".join(b.to_pylist()), "<u2").reshape(-1, REGISTERS)
    n, m = (c.to_numpy(zero_copy_only=False).astype(float) for c in (n, m))
    above, below = (x > y).sum(axis=1), (x < y).sum(axis=1)
    # A few hundred pairs at a time: the likelihoods of each are a row of the grid's width.
    parts = [slice(i, i + _PAIRS) for i in range(0, len(x), _PAIRS)]
    return pa.array(np.concatenate([similarity(above[p], below[p], n[p], m[p]) for p in parts]))


_estimate = F.arrow_udf(_likely, T.DoubleType(), F.ArrowUDFType.SCALAR)


def _least_estimate(percent: int) -> float:
    j = percent / 100
    return j - STANDARD_ERRORS * math.sqrt(j * (1 - j) / REGISTERS)


def _sets() -> Callable[[bytes], tuple]:
    import xxhash

    hashes = _WordHashes()

    def made(text: bytes) -> tuple:
        items = shingles(text, hashes)
        return xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None, items.view(np.int64)

    return made


def _sizes_allow(n: Column, m: Column, percent: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


class _Verifier:
    """Tries pairs (a, b) of classes; classes and sets are stored tables."""

    def __init__(self, classes: DataFrame, sets: DataFrame, percent: int):
        self.classes, self.sets, self.percent = classes, sets, percent

    def links(self, pairs: DataFrame) -> DataFrame:
        def side(name: str) -> DataFrame:
            return self.classes.select(
                F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("registers").alias(f"r_{name}")
            )

        known = pairs.join(side("a"), "a").join(side("b"), "b")
        likely = known.withColumn("estimate", _estimate("r_a", "r_b", F.col("n_a"), F.col("n_b"))).filter(
            F.col("estimate") >= _least_estimate(self.percent)
        )
        likely = store(likely.select("a", "b", "n_a", "n_b"), "likely")

        def full(name: str) -> DataFrame:
            return self.sets.select(F.col("node").alias(name), F.col("items").alias(f"s_{name}"))

        both = likely.join(full("a"), "a").join(full("b"), "b")
        shared = F.size(F.array_intersect("s_a", "s_b")).cast("bigint")
        met = both.select("a", "b", "n_a", "n_b", shared.alias("shared"))
        ok = F.col("shared") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("shared")) * self.percent
        return store(met.filter(ok).select("a", "b"), "confirmed")


def _pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs, the smaller node first, whose sizes allow a link."""
    allowed = rows.filter((F.col("x") != F.col("y")) & _sizes_allow(F.col("nx"), F.col("ny"), percent))
    return allowed.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _salted(members: DataFrame, centres: DataFrame, percent: int) -> DataFrame:
    """Pairs of members (bucket, size, node, n, component) with the centre (bucket, size, c) of their bucket.

    Each salt of a large bucket has the centre; members of its component are left alone.
    """
    salts = F.ceil(F.col("size") / SALTED).cast("int")
    copies = centres.select("bucket", "c", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    dealt = members.withColumn("salt", F.pmod(F.xxhash64("node"), salts).cast("int"))
    joined = dealt.join(copies, ["bucket", "salt"]).filter(F.col("component") != F.col("c.component"))
    return _pairs(
        joined.select(F.col("c.node").alias("x"), F.col("c.n").alias("nx"), F.col("node").alias("y"), F.col("n").alias("ny")), percent
    )


def _around_largest(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of each class with the centre of its largest bucket."""
    largest = members.groupBy("node").agg(F.max(F.struct("size", "bucket", "n")).alias("at"))
    chosen = largest.select("node", F.col("node").alias("component"), "at.bucket", "at.size", "at.n")
    centres = members.groupBy("bucket", "size").agg(F.min(F.struct("node", "n", F.col("node").alias("component"))).alias("c"))
    return _salted(chosen, centres, percent)


def _around_component(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of a centre of the bucket's largest component with the members of other components."""
    parts = members.groupBy("bucket", "size", "component").agg(
        F.count(F.lit(1)).alias("held"), F.min(F.struct("node", "n")).alias("c")
    )
    most = parts.groupBy("bucket", "size").agg(F.max(F.struct("held", "component", "c")).alias("most"))
    centres = most.select("bucket", "size", F.struct("most.c.node", "most.c.n", "most.component").alias("c"))
    return _salted(members, centres, percent)


def _unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component."""
    at = members.join(labels, "node", "left").select(
        "bucket", "size", "node", "n", F.coalesce("component", "node").alias("component")
    )
    at = store(at, "labelled")
    mixed = at.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return store(at.join(mixed.filter("low < high").select("bucket"), "bucket"), "unsettled")


def class_components(docs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, component) of linked classes; `classes` is a stored (node, digest, doc_id, n, registers) table.

    A class is a number that its set has got; `doc_id` is that of a row whose text has the set.
    """
    banded = classes.select("node", "n", F.explode(_band_keys("registers")).alias("bucket"))
    shared = banded.groupBy("bucket").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("size")
    )
    members = store(banded.join(shared.filter("low < high").select("bucket", "size"), "bucket"), "members")
    sets = _stored_sets(docs, classes, members.select("node").distinct())
    verifier = _Verifier(classes, sets, percent)

    labels = store(components(verifier.links(_around_largest(members, percent))), "components")
    open_members = _unsettled(members, labels)
    more = verifier.links(_around_component(open_members, percent))
    labels = store(extended(labels, more), "components")
    open_members = _unsettled(open_members.drop("component"), labels)
    prefixes = _prefixes(open_members, sets, percent)
    more = verifier.links(_met_in_pairs(prefixes, percent)).unionByName(_met_in_blocks(prefixes, classes, sets, percent))
    return store(extended(labels, more), "components")


def _prefixes(open_members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Stored (item, node, n, component, left, met) by which what is still unsettled can meet another component.

    Two sets of the wanted similarity share one of the rarest n - ceil(n * percent / 100) + 1 shingles of each.
    A shingle that no other unsettled set has only uses up a place, so sets with many shingles of their own,
    as heavily edited copies in a large group have, meet nobody. `left` counts the shingles from this one on that
    others have too, `met` those who hold this one within their own prefix.
    """
    rest = open_members.select("node", "n", "component").distinct()
    items = sets.join(rest.select("node"), "node", "left_semi").select("node", F.explode("items").alias("item"))
    counts = items.groupBy("item").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    held = F.sort_array(F.collect_list(F.struct("holders", "item")))
    shared = items.join(counts, "item").groupBy("node").agg(held.alias("shared"))
    places = F.expr(f"n - (n * {percent} + 99) div 100 + 1 - (n - size(shared))").cast("int")
    prefix = shared.join(rest, "node").filter(places > 0).select(
        "node", "n", "component", F.size("shared").alias("all"), F.posexplode(F.slice("shared", F.lit(1), places)).alias("at", "s")
    )
    prefix = prefix.select("node", "n", "component", F.col("s.item").alias("item"), (F.col("all") - F.col("at")).alias("left"))
    prefix = store(prefix, "prefixes")
    met = prefix.groupBy("item").agg(
        F.count(F.lit(1)).alias("met"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    return store(prefix.join(met.filter("low < high").select("item", "met"), "item"), "meeting")


def _met_in_pairs(prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that meet at a shingle which few hold."""
    few = prefixes.filter(F.col("met") <= FEW)
    side = lambda z: few.select(
        "item", *(F.col(c).alias(z + c) for c in ("node", "n", "component", "left"))
    )
    # What they can share is at most what is left from the first shingle at which they meet.
    enough = F.least("xleft", "yleft") * (100 + percent) >= (F.col("xn") + F.col("yn")) * percent
    sized = _sizes_allow(F.col("xn"), F.col("yn"), percent)
    met = side("x").join(side("y"), "item").filter((F.col("xcomponent") < F.col("ycomponent")) & sized & enough)
    return met.select(F.least("xnode", "ynode").alias("a"), F.greatest("xnode", "ynode").alias("b")).distinct()


def _met_in_blocks(prefixes: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Stored links (a, b) of different components that meet at shingles which many hold.

    A class belongs with those who have the same most held shingle in their prefix; they are dealt to blocks.
    """
    many = prefixes.filter(F.col("met") > FEW)
    homes = many.groupBy("node", "n", "component").agg(F.max(F.struct("met", "item")).alias("home"))
    homes = homes.select("node", "n", "component", F.col("home.item").alias("home"))
    dealt = homes.groupBy("home").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"))
    parts = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("shingles") / BLOCK_ITEMS))
    block = F.xxhash64("home", F.pmod(F.xxhash64("node"), parts))
    placed = store(homes.join(dealt, "home").select("node", "n", "component", block.alias("block")), "placed")

    at = many.select("item", "node").join(placed.select("node", "component", "block"), "node").groupBy("item", "block").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    x, y = (at.select("item", *(F.col(c).alias(z + c) for c in ("block", "low", "high"))) for z in "xy")
    differ = F.least("xlow", "ylow") < F.greatest("xhigh", "yhigh")
    pairs = x.join(y, "item").filter((F.col("xblock") <= F.col("yblock")) & differ).select("xblock", "yblock").distinct()

    filled = placed.join(classes.select("node", "registers"), "node").join(sets, "node")
    blocks = filled.groupBy("block").agg(
        F.collect_list(F.struct("node", "n", "component", "registers", "items")).alias("members")
    )
    sides = pairs.withColumn("block", F.explode(F.array_distinct(F.array("xblock", "yblock"))))
    tried = sides.join(blocks, "block").groupBy("xblock", "yblock").applyInArrow(_block_links(percent), "a bigint, b bigint")
    return store(tried.distinct(), "block-links")


def _block_links(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Links between different components of two blocks, or within one."""
    least = _least_estimate(percent)
    # Registers agree about as often as sets are alike; so few of a link agree in no case.
    agree = REGISTERS * (percent / 100 - 9 * math.sqrt(percent / 100 * (1 - percent / 100) / REGISTERS))

    def tried(met: pa.Table) -> pa.Table:
        members = met.column("members").combine_chunks()
        first = len(members[0])
        rows = members.flatten()
        node, n, component = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("node", "n", "component"))
        sketch = np.frombuffer(b"".join(rows.field("registers").to_pylist()), "<u2").reshape(-1, REGISTERS)
        lists = rows.field("items")
        values, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
        ends = ends - ends[0]
        total = len(node)
        xs, ys = [], []
        for i in range(first if len(members) > 1 else total - 1):
            j = np.arange(first if len(members) > 1 else i + 1, total)
            j = j[(component[j] != component[i]) & (np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * percent)]
            above, below = (sketch[i] > sketch[j]).sum(axis=1), (sketch[i] < sketch[j]).sum(axis=1)
            near = REGISTERS - above - below >= agree
            j, above, below = j[near], above[near], below[near]
            if len(j):
                j = j[similarity(above, below, np.full(len(j), float(n[i])), n[j].astype(float)) >= least]
            xs.append(np.full(len(j), i))
            ys.append(j)
        x, y = (np.concatenate([*z, np.empty(0, np.int64)]).astype(np.int64) for z in (xs, ys))
        shared = _shared(values, ends, x, y)
        link = shared * 100 >= (n[x] + n[y] - shared) * percent
        a, b = node[x[link]], node[y[link]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return tried


def _shared(values: np.ndarray, ends: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many items sets x and y share, pair by pair; set k is values[ends[k]:ends[k + 1]], without repeats."""
    if not len(x):
        return np.empty(0, np.int64)
    asked, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    of = np.repeat(np.arange(len(asked)), ends[asked + 1] - ends[asked])
    held = np.concatenate([values[ends[k] : ends[k + 1]] for k in asked])
    _, column, holders = np.unique(held, return_inverse=True, return_counts=True)
    kept = holders[column] > 1
    of, column = of[kept], (np.cumsum(holders > 1) - 1)[column[kept]]
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    counts = np.zeros((len(asked), len(asked)), np.float32)  # Whole numbers below 2^24 each part, summed as such.
    total = counts.astype(np.int64)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        inside = slice(*np.searchsorted(column, [low, low + _COLUMNS]))
        part = np.zeros((len(asked), _COLUMNS), np.float32)
        part[of[inside], column[inside] - low] = 1
        np.matmul(part, part.T, out=counts)
        total += counts.astype(np.int64)
    return total[at[: len(x)], at[len(x) :]]


def _stored_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, items) of the wanted classes, each once, from texts of the ids that stand for them."""
    asked = wanted.join(classes.select("node", "digest", "doc_id"), "node")
    texts = docs.select("doc_id", "text").join(asked.select("doc_id").distinct(), "doc_id", "left_semi")
    made = per_text(texts, "doc_id bigint, digest binary, items array<bigint>", _sets, "doc_id").drop("doc_id")
    # Rows of such an id with the same set, or with another one, are read as well; a class counts once.
    once = made.join(asked.select("digest", "node"), "digest").groupBy("node").agg(F.first("items").alias("items"))
    return store(once, "sets")


def _of_one_id(named: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of an id that has several."""
    pairs = named.select("doc_id", "digest").distinct()
    several = pairs.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    many = pairs.join(several, "doc_id").join(classes.select("digest", "node"), "digest").select("doc_id", "node")
    first = many.groupBy("doc_id").agg(F.min("node").alias("a"))
    return many.join(first, "doc_id").select("a", F.col("node").alias("b")).filter("a <> b").distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, and the set's digest, per row of `docs`; before them the columns `also`."""
    rows = store(sketches(docs, also), "sketches")
    named = rows.filter(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    by_set = named.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers")
    )
    classes = store(by_set.withColumn("node", F.monotonically_increasing_id()), "classes")
    labels = extended(class_components(docs, classes, percent), _of_one_id(named, classes))
    known = classes.select("node", "digest", "doc_id").join(labels, "node", "left").select(
        "digest", "doc_id", F.coalesce("component", "node").alias("component")
    )
    known = store(known, "labels")
    least = known.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_set = known.join(least, "component").select("digest", "component_id")
    out = rows.drop("registers").join(of_set, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        *also,
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        "digest",
    )
