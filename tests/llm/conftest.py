import pytest

LONG = " ".join(f"word{i % 977}" for i in range(30_000))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns named like results."""
    text = "All rights reserved. Call +1 (017) 555-7713 or mail a.1@mail0.example.com\nfor the rest of it all today"
    rows = [
        (1, text, "s1"),
        (1, text, "s1"),
        (2, text, None),
        (3, None, "s2"),
        (4, "", "s2"),
        (5, "   \n\t ", None),
        (6, LONG, "s3"),
        (7, LONG + " more", "s3"),
        (None, "a text without an id", "s1"),
        (None, None, None),
        (8, "one", "s4"),
        (9, "é ñ 漢字 \U0001f600 ß", "s4"),
        (10, "same same same same same same same same", "s1"),
    ]
    clash = (
        "size int, score double, kept boolean, shard int, slot int, sequence_id long, offset int, length int, piece int,"
        " component_id long, n_shingles int, fingerprint string, label int, row long, key string, rank int, target int,"
        " taken int, copies int, failed long, words int, uid long, block int, digest string, node long, gram string"
    )
    names = len(clash.split(","))
    schema = f"doc_id long, text string, source string, {clash}"
    return spark.createDataFrame([(*r, *([None] * names)) for r in rows], schema)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.filter("false")


@pytest.fixture(scope="session")
def some_labels(spark):
    rows = [(1, 1, 0), (2, 1, 0), (4, 0, 1), (6, 0, 1), (7, 1, 0), (8, None, None), (None, 1, 1), (10, 0, 1), (10, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
