import hashlib
import struct

import xxhash
from pyspark.sql import functions as F

from fathomgrid.llm import orderminhash as omh


def _x64(*values):
    """The engine's 64-bit hash: strings as UTF-8, ints as 4 and longs as 8 bytes, each seeding the next."""
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else struct.pack("<i" if isinstance(v, _Int) else "<q", v)
        seed = xxhash.xxh64_intdigest(data, seed=seed)
    return _signed(seed)


class _Int(int):
    pass


def _signed(x):
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >= 1 << 63 else x


def plain(text):
    """Order MinHash by the definition, with tuples instead of packed numbers."""
    words = text.split()
    k = omh.KMER
    kmers = [_x64(*words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [_x64(" ".join(words))] if words else []
    seen, numbered = {}, []
    for place, h in enumerate(kmers):
        low = _signed(h << omh.PLACE_BITS) >> omh.PLACE_BITS
        j = seen[low] = seen.get(low, -1) + 1
        numbered.append((_signed(_x64(low, _Int(j)) << omh.PLACE_BITS) >> omh.PLACE_BITS, place))
    if not numbered:
        return [0] * omh.PARTS
    numbered.sort()
    out = []
    for part in range(-omh.PARTS // 2, omh.PARTS // 2):
        least = part << (64 - omh.PARTS_BITS - omh.PLACE_BITS)
        at = next((i for i, (g, _) in enumerate(numbered) if g >= least), 0)
        pair = [numbered[at], numbered[(at + 1) % len(numbered)]]
        pair.sort(key=lambda x: x[1])
        out.append(_x64(pair[0][0], pair[1][0]))
    return out


def test_signatures_match_the_definition(spark):
    texts = ["", "one", "one two", "a b c", "a b c d e f g h", "x y z " * 40, "la " * 100, "é ñ\n漢 \t字 ok " * 3]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(25).collect()]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r["doc_id"]: r["s"] for r in omh.with_signature(docs, "text", "s").collect()}
    for i, t in enumerate(texts):
        assert found[i] == plain(t), t[:60]


def test_edits_and_neighbours(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = {r["doc_id"]: r for r in omh.fingerprints(docs).collect()}
    cut = {r["doc_id"]: r for r in omh.fingerprints(docs, range_rows=7).collect()}
    assert rows == cut
    order = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
    for i, (doc_id, text) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        n = len(text) // 3
        edited = text[: len(text) - n] + after[:n]
        r = rows[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, e, x = plain(text), plain(edited), plain(after)
        assert r["near_edited"] == sum(p == q for p, q in zip(a, e)) / omh.PARTS
        assert r["near_next"] == sum(p == q for p, q in zip(a, x)) / omh.PARTS


def test_order_matters(spark):
    words = [f"w{i}" for i in range(60)]
    turned = words[30:] + words[:30]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(turned))], "doc_id long, text string")
    a, b = (r["s"] for r in omh.with_signature(docs, "text", "s").orderBy("doc_id").collect())
    assert 0 < sum(x == y for x, y in zip(a, b)) < omh.PARTS


def test_awkward_rows(spark, awkward, nothing):
    rows = omh.fingerprints(awkward).collect()
    assert len(rows) == awkward.count()
    prints = {r["fingerprint"] for r in rows if r["doc_id"] in (3, 4, 5)}
    assert prints == {"0" * 8 * omh.PARTS}
    assert len({r["fingerprint"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert all(0 <= r["near_edited"] <= 1 for r in rows)
    assert omh.fingerprints(nothing).count() == 0
    single = spark.createDataFrame([(1, "only this one here now")], "doc_id long, text string")
    assert omh.fingerprints(single).first()["near_next"] == 1.0


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = omh.fingerprints(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_bounds_find_the_range(spark):
    ids = spark.range(-5, 500).select(F.col("id").alias("doc_id"))
    for bounds in ([], [0], [3, 7, 20], list(range(0, 400, 3))):
        got = {r["doc_id"]: r["b"] for r in ids.select("doc_id", omh._bucket(bounds).alias("b")).collect()}
        assert all(got[i] == sum(x <= i for x in bounds) for i in got)
