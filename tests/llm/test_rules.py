from fathomgrid.llm import rules
from fathomgrid.llm.queries import ORACLES, QUERIES
from workload.check import compare, connect


def plain(text):
    text = text or ""
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_measures_match_a_plain_count(awkward, nothing):
    rows = awkward.filter("doc_id is not null").collect()
    found = {r["doc_id"]: tuple(r)[1:6] for r in rules.ledger(awkward.filter("doc_id is not null")).collect()}
    for r in rows:
        assert found[r["doc_id"]] == plain(r["text"])
    assert rules.ledger(awkward).count() == awkward.count()
    assert rules.judged(rules.ledger(nothing)).count() == 0


def test_many_distinct_words_are_numbered_in_two_steps(monkeypatch):
    words = [b"a", b"b", b"c", b"d", b"a", b"b", b"c", b"x", b"b", b"c", b"d"]
    one = rules.repeated_positions(words)
    monkeypatch.setattr(rules, "MANY_WORDS", 1)
    assert rules.repeated_positions(words) == one == plain(" ".join(w.decode() for w in words))[4]


def test_policies_and_ablation_agree(spark):
    book = rules.ledger(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rows = book.collect()
    mask = rules.policy_mask(2)
    table = {r["rule"]: (r["fails"], r["only_this"]) for r in rules.ablation(book, 2).collect()}
    for rule, bit in rules.BITS.items():
        fails = sum(bool(r["failed"] & bit) for r in rows)
        only = sum((r["failed"] & mask) == bit for r in rows)
        assert table[rule] == (fails, only)
    kept = rules.judged(book, 2).filter("kept").count()
    assert kept == sum(r["failed"] & mask == 0 for r in rows)


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    verdict, *_ = compare(spark, connect(sf), sf, "op5_quality_rules", QUERIES["op5_quality_rules"], ORACLES["op5_quality_rules"])
    assert verdict == "ok"
