from fathomgrid.llm import mixing
from fathomgrid.llm.queries import ORACLES, QUERIES
from workload.check import compare, connect


def plain_targets(sizes):
    """sizes by source in order."""
    weights = {s: i % 3 + 1 for i, s in enumerate(sizes)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        weight = sum(w for s, w in weights.items() if s not in full)
        new = {s for s in sizes if s in full or 3 * sizes[s] * weight <= weights[s] * left}
        if new == full:
            return {s: 3.0 * sizes[s] if s in full else weights[s] * left / weight for s in sizes}
        full = new


def test_targets_of_many_words(spark):
    """Budgets whose product with a weight passes 32 bits, below and above 2^31 words."""
    for scale in (10**8, 4 * 10**8, 10**12):
        sizes = {s: n * scale for s, n in zip("abcdef", (1, 2, 1, 0, 3, 2), strict=True)}
        sized = spark.createDataFrame(list(sizes.items()), "source string, size long")
        found = {r["source"]: (r["source_size"], r["target"]) for r in mixing.source_targets(sized).collect()}
        assert {s: n for s, (n, _) in found.items()} == sizes
        want = plain_targets(sizes)
        assert all(abs(t - want[s]) <= 1e-9 * sum(sizes.values()) for s, (_, t) in found.items())


def test_sql(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        verdict, *_ = compare(spark, connect(sf), sf, "op4_source_mixing", QUERIES["op4_source_mixing"], ORACLES["op4_source_mixing"])
        assert verdict == "ok"


def test_shares_and_ranges(spark):
    rows = [(i, "w " * (1 + i * 7919 % 50), ["a", "b", "c", "d", None][0 if i % 3 else i % 5]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one = {tuple(r) for r in mixing.mix(docs).collect()}
    cut = {tuple(r) for r in mixing.mix(docs, range_rows=40).collect()}
    assert one == cut and len(one) == 3000
    sizes, taken, targets = {}, {}, {}
    of = {r[0]: r[2] for r in rows}
    for doc_id, size, source_size, target, words, copies in one:
        s = of[doc_id]
        sizes[s], targets[s] = source_size, target
        taken[s] = taken.get(s, 0) + words
        assert 0 <= copies <= 3 and words == copies * size
    order = sorted(sizes, key=lambda s: (s is None, s))
    want = plain_targets({s: sizes[s] for s in order})
    for s in order:
        assert abs(targets[s] - want[s]) < 1e-6
        assert abs(taken[s] - targets[s]) <= 60


def test_awkward_rows(spark, awkward, nothing):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    assert {r["taken"] for r in rows if r["size"] == 0} == {0}
    assert mixing.mix(nothing).count() == 0
    empty = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [r["taken"] for r in mixing.mix(empty).collect()] == [0, 0]
