"""Quotient filters next to counters, collocations next to plain counting."""

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fathomgrid.llm import collocations
from fathomgrid.llm import quotientfilter as qf

WIDTHS = [(1, 2), (7, 7), (20, 21), (31, 32), (40, 41), (60, 63)]


@pytest.mark.parametrize("left,right", WIDTHS)
def test_permutation_is_invertible(left, right):
    keys = qf.Keys(left, right)
    dice = np.random.default_rng(3)
    a = dice.integers(0, 1 << left, 5000, dtype=np.uint64)
    b = dice.integers(0, 1 << right, 5000, dtype=np.uint64)
    q, r = keys.permuted(a, b)
    assert int(q.max()) < 1 << left and int(r.max()) < 1 << right
    back = keys.restored(q, r)
    assert (back[0] == a).all() and (back[1] == b).all()


@pytest.mark.parametrize("left,right", WIDTHS)
@pytest.mark.parametrize("bits", [0, 1, 5])
def test_filters_hold_exact_counts(left, right, bits):
    bits = min(bits, left)
    keys, dice = qf.Keys(left, right), np.random.default_rng(5)
    a = dice.integers(0, min(1 << left, 40), 3000, dtype=np.uint64)
    b = dice.integers(0, min(1 << right, 7), 3000, dtype=np.uint64)
    halves = [qf.counted(keys, *keys.permuted(a[part], b[part])) for part in (slice(0, 1700), slice(1700, None))]
    stored = [{n: qf.stored_filter(keys, c, bits) for n, c in qf.buckets(keys, half, bits)} for half in halves]
    got = Counter()
    for bucket in stored[0].keys() | stored[1].keys():
        read = [qf.read_filter(keys, s[bucket], bucket, bits) for s in stored if bucket in s]
        whole = qf.read_filter(keys, qf.stored_filter(keys, qf.merged(keys, read), bits), bucket, bits)
        x, y = keys.restored(whole.quotient, whole.remainder)
        for k, n in zip(zip(x.tolist(), y.tolist(), strict=True), whole.count.tolist(), strict=True):
            assert k not in got
            got[k] = n
    assert got == Counter(zip(a.tolist(), b.tolist(), strict=True))


@given(st.lists(st.integers(0, 3), max_size=60), st.sampled_from([2, 3]), st.sampled_from([2, 5, 22, 40]))
@settings(max_examples=60, deadline=None)
def test_grams(ids, length, bits):
    found = collocations.grams(np.array(ids, np.uint64), length, bits)
    keys = collocations.gram_keys(bits, length)
    back = collocations.unpacked(*keys.restored(found.quotient, found.remainder), bits, length)
    got = dict(zip(zip(*(b.tolist() for b in back), strict=True), found.count.tolist(), strict=True))
    windows = (tuple(ids[i : i + length]) for i in range(len(ids) - length + 1))
    assert got == Counter(w for w in windows if 0 not in w)


def plain(rows, least, best):
    counts = {}
    for lang, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang or "und", Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        n = sum(a for p, a in f.items() if len(p) == 1)
        kept = []
        for p, a in candidates.items():
            if any(len(x) > len(p) and 100 * b >= 50 * a and p in (x[:2], x[1:]) for x, b in candidates.items()):
                continue
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def same(docs, least, best):
    got = sorted(tuple(r) for r in collocations.collocations(docs, least, best).collect())
    assert got == plain([(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()], least, best)
    return got


def phrases(spark):
    dice = np.random.default_rng(11)
    words = ["the", "The", "of", "new", "york", "é", "漢", "x\x01", "x", "\x02", "a.b", "end!", "q\nr", "tab\tbed", "s,t"]
    texts = [" ".join(dice.choice(words, 40)) for _ in range(60)]
    rows = [(i, t, ("en", "de", None, "und")[i % 4 if i % 3 else 0]) for i, t in enumerate(texts)]
    rows += [(None, "hot phrase here " * 4000, "en"), (1, None, "en"), (2, "", None), (3, " . ,\n", "xx"), (3, "rare words", "xx")]
    return spark.createDataFrame(
        [(*r, "c", "c", 1) for r in rows], "doc_id long, text string, lang string, phrase string, word string, n int"
    )


def test_against_plain_counts(spark):
    assert len({r[0] for r in same(phrases(spark).repartition(3), 10, 2000)}) >= 3


def test_ties_at_the_last_rank(spark):
    got = same(phrases(spark), 3, 7)
    assert max(r[1] for r in got) == 7


def test_small_shards_buckets_and_windows(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SHARD_BYTES", 300)
    monkeypatch.setattr(collocations, "WINDOW_BYTES", 50)
    monkeypatch.setattr(collocations, "BUCKET_COUNTERS", 64)
    monkeypatch.setattr(collocations, "HELD_COUNTERS", 40)
    same(phrases(spark).repartition(3), 10, 2000)


def test_products_beyond_64_bits(spark):
    row = spark.createDataFrame([(4 * 10**12, 5 * 10**12, 6 * 10**12)], "a long, l long, r long")
    score = row.select(collocations._score("a", "l", "r").alias("s")).first()["s"]
    assert score == 10**6 * (4 * 10**12) ** 2 // (5 * 10**12 * 6 * 10**12)


def test_nothing_to_count(spark):
    docs = phrases(spark)
    assert collocations.collocations(docs.filter("false")).collect() == []
    assert collocations.collocations(docs.filter("lang = 'xx'")).collect() == []


def test_intermediate_tables_are_written_densely(spark):
    before = spark.conf.get("spark.sql.parquet.compression.codec")
    spark.conf.set("spark.sql.parquet.compression.codec", "snappy")
    try:
        kept = collocations.store(spark.range(3), "dense", **collocations.DENSE)
    finally:
        spark.conf.set("spark.sql.parquet.compression.codec", before)
    assert kept.count() == 3 and all(f.endswith(".zstd.parquet") for f in kept.inputFiles())
