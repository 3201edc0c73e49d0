import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomgrid.llm import quality, toxicity
from fathomgrid.llm.common import id_remainder, table, training_labels

SF = "/root/testdata/sf0.1"


def accuracy(rows, labels, name):
    known = {r["doc_id"]: r[name] for r in labels.collect()}
    held = [r for r in rows if r["held_out"] and known.get(r["doc_id"]) is not None]
    return sum(r["predicted"] == known[r["doc_id"]] for r in held) / len(held)


def test_quality_on_held_out_rows(spark):
    labels = table(spark, SF, "labels")
    rows = quality.quality(table(spark, SF, "documents"), labels, id_remainder("doc_id", 4) == 2).collect()
    assert accuracy(rows, labels, "quality") > 0.98


def test_toxicity_on_held_out_rows(spark):
    labels = table(spark, SF, "labels")
    rows = toxicity.toxicity(table(spark, SF, "documents"), labels, id_remainder("doc_id", 5) == 0).collect()
    assert accuracy(rows, labels, "toxic") > 0.97


@pytest.mark.parametrize("make", [quality.quality, toxicity.toxicity])
def test_awkward_rows(make, awkward, nothing, some_labels):
    held_out = F.col("doc_id") == 7
    rows = make(awkward, some_labels, held_out).collect()
    assert len(rows) == awkward.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
    assert {r["held_out"] for r in rows if r["doc_id"] is None} == {False}
    assert make(nothing, some_labels, held_out).count() == 0
    # One class, or none at all.
    for known in (some_labels.filter("quality = 1 and toxic = 0"), some_labels.filter("false")):
        scores = {r["score"] for r in make(awkward, known, held_out).collect()}
        assert len(scores) == 1


def test_labels_that_may_be_learned_from(some_labels):
    found = {tuple(r) for r in training_labels(some_labels, "quality", F.col("doc_id") == 7).collect()}
    assert found == {(1, 1), (2, 1), (4, 0), (6, 0)}


def test_discriminant_is_the_density_difference(spark):
    dice = np.random.default_rng(5)
    x = np.vstack([dice.normal(0, 1, (300, 12)), dice.normal(1, 2, (200, 12))])
    y = [0] * 300 + [1] * 200
    rows = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["doc_id", *quality.STATISTICS])
    labels = spark.createDataFrame(list(enumerate(y)), "doc_id long, label int")
    model = quality.fit(rows, labels, shrinkage=0.2)
    pooled = sum(n * np.cov(x[np.array(y) == k].T, bias=True) for k, n in ((0, 300), (1, 200))) / 500
    want = np.zeros(len(x))
    for k, n, sign in ((0, 300, -1), (1, 200, 1)):
        own = x[np.array(y) == k]
        cov = 0.8 * np.cov(own.T, bias=True) + 0.2 * np.diag(np.diag(pooled)) + quality.RIDGE * np.eye(12)
        z = x - own.mean(axis=0)
        want += sign * (math.log(n / 500) - np.linalg.slogdet(cov)[1] / 2 - np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z) / 2)
    assert np.allclose(model.differences(x), want)


def plain_ratios(texts, labels):
    """The smoothed ratios by plain counting."""
    d, order = toxicity.DISCOUNT, toxicity.ORDER
    counts = [Counter(), Counter(), Counter()]
    for text, label in zip(texts, labels, strict=True):
        for word in toxicity.spelled(toxicity.words_of(text.encode())):
            p = "^" * (order - 1) + word + "$"
            for i in range(len(word) + 1):
                g = p[i : i + order]
                counts[2][g] += 1
                if label is not None:
                    counts[label][g] += 1
    short = Counter(g[-3:] for g in counts[2])
    single = Counter(s[-1] for s in short)

    def smooth(c, of, low):
        total = sum(n for k, n in of.items() if k[:-1] == c[:-1])
        kinds = sum(k[:-1] == c[:-1] for k in of)
        return max(of[c] - d, 0) / total + d * kinds / total * low

    found = {}
    for g in counts[2]:
        shared = smooth(g, counts[2], smooth(g[-3:], short, smooth(g[-1], single, 1 / (len(single) + 1))))
        p = []
        for k in (0, 1):
            total = sum(n for h, n in counts[k].items() if h[:-1] == g[:-1])
            kinds = sum(h[:-1] == g[:-1] for h in counts[k])
            p.append((max(counts[k][g] - d, 0) + (d * kinds + toxicity.PSEUDO) * shared) / (total + toxicity.PSEUDO))
        found[g] = math.log(p[1] / p[0])
    return found


def test_ratios_match_plain_counting(spark):
    texts = ["you idiot moron", "the idiotic rest the rest", "a fine day the day", "é mañana 1 x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 0)], "doc_id long, label int")
    counts = toxicity.window_counts(docs, labels)
    found = {r["gram"]: r["ratio"] for r in toxicity.window_ratios(counts).collect()}
    want = plain_ratios(texts, [1, 0, 0, None])
    assert found.keys() == want.keys()
    assert all(found[g] == pytest.approx(want[g]) for g in want)


def test_counts_do_not_depend_on_flushing(spark, monkeypatch):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    labels = training_labels(table(spark, "/root/testdata/sf0.001", "labels"), "toxic", F.lit(False))
    whole = {tuple(r) for r in toxicity.window_counts(docs, labels).collect()}
    monkeypatch.setattr(toxicity, "_HELD_WORDS", 50)
    assert {tuple(r) for r in toxicity.window_counts(docs, labels).collect()} == whole


@pytest.mark.parametrize("buckets", [1, 1 << 16])
def test_every_window_counts_toward_the_evidence(spark, buckets):
    bad = ["idiot", "moron", "zyqqward", "dämlich"]
    texts = [f"{w} " * 200 + "you" for w in bad] + ["a fine day the day " * 200, "", "idiots and a moronic day, zyqqwards", "the rest"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = [1] * len(bad) + [0] + [None] * 3
    known = spark.createDataFrame([(i, n) for i, n in enumerate(labels) if n is not None], "doc_id long, label int")
    ratios = toxicity.window_ratios(toxicity.window_counts(docs, known))
    found = {r["doc_id"]: r["evidence"] for r in toxicity.evidence(docs, ratios, ["doc_id"], buckets).collect()}
    want, plain = {}, plain_ratios(texts, labels)
    for i, text in enumerate(texts):
        words = toxicity.spelled(toxicity.words_of(text.encode()))
        marked = ["^" * (toxicity.ORDER - 1) + w + "$" for w in words]
        sums = [sum(plain[m[k : k + toxicity.ORDER]] for k in range(len(m) - toxicity.ORDER + 1)) for m in marked]
        want[i] = sum(max(x - toxicity.MARGIN, 0) for x in sums) / math.sqrt(max(len(words), 1))
    assert found == pytest.approx(want, abs=1e-6) and sum(x > 0 for x in want.values()) >= 4


def test_scoring_holds_no_model(spark):
    docs = spark.createDataFrame([(i, f"idiot{'abcdefgh'[i]} day") for i in range(8)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, label int")
    ratios = toxicity.window_ratios(toxicity.window_counts(docs, labels))
    units = ratios.select("hash", F.round(F.col("ratio") * toxicity.UNIT).cast("bigint").alias("units"))
    bounds = toxicity.ratio_bounds(units, 16)
    assert len(bounds) == 16
    assert all(bounds[r["hash"] % 16] >= r["units"] / toxicity.UNIT for r in units.collect())
