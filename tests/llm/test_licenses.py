import re

import pytest

from fathomgrid.llm.licenses import BASE, evaluate, license_scan, scanner, to_postfix

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(low)
    hits = [
        (i, label)
        for phrase, label in BASE.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


def test_base_columns_match_a_plain_scan(spark, awkward):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame(
        [(-1, "CC-BY cc by,CC (by) all\nrights reserved; all rights all rights reserved"), (-2, "ccc by xcc by éall rights reserved")],
        "doc_id long, text string",
    )
    docs = docs.unionByName(more).unionByName(
        awkward.selectExpr("doc_id + 1000000 as doc_id", "text")
    )
    # Rows of one id have one text here, apart from the rows without an id.
    found = {r["doc_id"]: tuple(r)[1:6] for r in license_scan(docs.filter("doc_id is not null")).collect()}
    for r in docs.filter("doc_id is not null").collect():
        assert found[r["doc_id"]] == plain(r["text"])


def test_awkward_rows_all_come_back(awkward, nothing):
    rows = license_scan(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert license_scan(nothing).count() == 0


@pytest.mark.parametrize(
    ("expression", "value"),
    [
        ("MIT", 0.9),
        ("MIT AND GPL-3.0-only", 0.3),
        ("MIT OR GPL-3.0-only", 0.9),
        ("GPL-2.0-only WITH Classpath-exception-2.0", 0.4),
        ("GPL-2.0 OR MIT AND AGPL-3.0", 0.3),
        ("(GPL-2.0 OR MIT) AND LGPL-2.1", 0.5),
        ("CC-BY-NC-4.0", 0.2),
        ("something-else", 0.5),
    ],
)
def test_expressions(expression, value):
    assert evaluate(expression)[0] == pytest.approx(value)


@pytest.mark.parametrize("broken", ["", "MIT OR", "AND MIT", "(MIT", "MIT)", "MIT GPL", "()", "MIT (GPL)"])
def test_malformed_expressions(broken):
    with pytest.raises(ValueError):
        to_postfix(re.findall(r"[()]|[^\s()]+", broken))


def test_tags_end_with_their_line():
    found = scanner()(b"// SPDX-License-Identifier: (MIT OR Apache-2.0)\nmore text */")
    assert found[5] == "apache-2.0,mit" and found[6] == 0.9
    assert scanner()(b"SPDX-License-Identifier: MIT OR")[5] == "invalid-expression"
    assert scanner()(b"SPDX-License-Identifier: BSD-3-Clause */ x")[5] == "bsd-3-clause"


@pytest.mark.parametrize(
    ("expression", "value"),
    [
        ("CC0-1.0 OR MIT", 1.0),
        ("MIT OR GPL-2.0-only", 0.9),
        ("(MIT AND GPL-2.0-only) OR CC0-1.0", 1.0),
        ("MIT AND GPL-2.0-only", 0.3),
        ("GPL-2.0-only WITH GPL-2.0-only OR GPL-2.0-only", 0.4),
    ],
)
def test_an_expression_counts_as_a_whole(expression, value):
    """Neither the identifiers in it nor phrases on its line pull it down; a notice elsewhere does."""
    assert evaluate(expression)[0] == pytest.approx(value)
    tag = b"SPDX-License-Identifier: " + expression.encode()
    assert scanner()(tag)[6] == pytest.approx(value)
    assert scanner()(b"code\n" + tag + b"\nmore code\n" + tag)[6] == pytest.approx(value)
    assert scanner()(tag + b"\nAll rights reserved.")[6] == 0.0


def test_an_exception_that_is_a_licence_elsewhere_is_named():
    assert evaluate("MIT WITH x AND x")[1] == {"mit", "x"}
    assert evaluate("MIT WITH x")[1] == {"mit"}


def test_phrases_around_a_tag_do_not_join():
    found = scanner()(b"all rights\nSPDX-License-Identifier: MIT\nreserved")
    assert found[1] == 0 and found[6] == 0.9
    assert scanner()(b"")[0] == 0 and scanner()(b" . ")[0] == 0 and scanner()(b"one")[0] == 1
