import random

import numpy as np
import pytest

from fathomgrid.llm import setsketch as ss
from fathomgrid.llm.components import components
from fathomgrid.llm.queries import ORACLES, QUERIES
from workload.check import compare, connect


def plain_sets(texts):
    out = []
    for t in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def plain_components(ids, texts, percent=75):
    sets, parent = plain_sets(texts), {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x in range(len(ids)):
        for y in range(x):
            k = len(sets[x] & sets[y])
            if k and 100 * k >= percent * (len(sets[x]) + len(sets[y]) - k):
                a, b = sorted((root(ids[x]), root(ids[y])))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in zip(ids, sets, strict=True)}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql(spark, sf):
    sf = f"/root/testdata/{sf}"
    verdict, *_ = compare(spark, connect(sf), sf, "op8_near_dedup", QUERIES["op8_near_dedup"], ORACLES["op8_near_dedup"])
    assert verdict == "ok"


@pytest.mark.parametrize("few, block, salted", [(ss.FEW, ss.BLOCK, ss.SALTED), (1, 16, 8), (10**6, 1, 10**6)])
def test_large_groups_chains_and_threshold(spark, monkeypatch, few, block, salted):
    """The same components whether classes meet as pairs or in blocks, large ones or small ones."""
    for name, value in (("FEW", few), ("BLOCK", block), ("SALTED", salted)):
        monkeypatch.setattr(ss, name, value)
    dice = random.Random(11)
    fresh = lambda n: [f"w{dice.randrange(10**9)}" for _ in range(n)]
    texts = []
    base = fresh(200)
    for _ in range(150):  # Copies of one base that are often too far from each other.
        copy = list(base)
        for _ in range(dice.randint(1, 6)):
            copy[dice.randrange(200)] = fresh(1)[0]
        texts.append(" ".join(copy))
    for _ in range(60):  # Copies that link with the base at best.
        copy = list(base)
        for _ in range(dice.randint(5, 14)):
            copy[dice.randrange(200)] = fresh(1)[0]
        texts.append(" ".join(copy))
    step = fresh(120)
    for i in range(40):  # A chain: each links with the next only.
        step = step[4:] + fresh(4)
        texts.append(" ".join(step))
    for _ in range(30):  # A shared passage that is no link.
        texts.append(" ".join(fresh(80) + base[:60] + fresh(80)))
    texts += [texts[0]] * 60 + [texts[0].upper()] * 3 + ["a b", "A B", "a b c", "", None]
    ids = list(range(len(texts)))
    dice.shuffle(ids)
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ss.near_duplicates(docs).collect()}
    assert found == plain_components(ids, texts)


def test_shared_counts():
    dice = np.random.default_rng(3)
    sets = [np.unique(dice.integers(0, 9000, dice.integers(1, 9000))) for _ in range(9)]
    ends = np.cumsum([0, *map(len, sets)])
    x, y = np.triu_indices(9, 1)
    want = [len(np.intersect1d(sets[i], sets[j])) for i, j in zip(x, y, strict=True)]
    assert ss._shared(np.concatenate(sets), ends, x, y).tolist() == want
    assert len(ss._shared(np.concatenate(sets), ends, x[:0], y[:0])) == 0


def test_registers_merge_and_estimate():
    dice = np.random.default_rng(1)
    pool = dice.integers(0, 1 << 63, 6000, dtype=np.uint64)
    a, b = pool[:4000], pool[1000:5000]
    ra, rb = ss.registers(a), ss.registers(b)
    assert (ss.merge(ra, rb) == ss.registers(np.unique(np.concatenate([a, b])))).all()
    got = ss.similarity(
        np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()]), np.array([4000.0]), np.array([4000.0])
    )[0]
    assert abs(got - 0.6) < 5 * (0.6 * 0.4 / ss.REGISTERS) ** 0.5
    assert (ss.registers(a) >= ss.registers(a[:100])).all()


def test_components_of_a_long_chain(spark):
    n = 400
    links = spark.range(n - 1).selectExpr("id as a", "id + 1 as b").unionByName(spark.sql("select 1000L as a, 1001L as b"))
    found = {r["node"]: r["component"] for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}
    assert components(links.filter("false")).count() == 0


def test_awkward_rows(awkward, nothing):
    rows = ss.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert [x[1:] for x in by[1]] == [(1, True)] * 2 and by[2][0][1:] == (1, False)
    assert by[3] == by_empty(3) and by[4] == by_empty(4) and by[5] == by_empty(5)
    assert by[7][0][1] == 6
    assert all(x[1] is None and x[2] for x in by[None])
    assert by[8][0] == (1, 8, True)
    assert ss.near_duplicates(nothing).count() == 0


def by_empty(doc_id):
    return [(0, doc_id, True)]


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (1, 0, 3, 2), (3, 2, 1, 0)])
def test_an_id_with_several_texts_links_them(spark, order):
    """Rows of one id are one document: what links with any of its texts joins it, in any order of rows."""
    dice = random.Random(4)
    a, b = (" ".join(f"w{dice.randrange(10**9)}" for _ in range(300)) for _ in range(2))
    rows = [(5, a), (5, b), (7, a + " x"), (8, b + " x")]
    docs = spark.createDataFrame([rows[i] for i in order], "doc_id long, text string").coalesce(1)
    assert {(r["doc_id"], r["component_id"]) for r in ss.near_duplicates(docs).collect()} == {(5, 5), (7, 5), (8, 5)}
