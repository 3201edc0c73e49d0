import random
import zlib

import numpy as np
import pyarrow as pa

from fathomgrid.llm import packing, tokens
from fathomgrid.llm.common import store
from fathomgrid.llm.queries import tokenizer_path


def check(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def whole(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return {
        r["doc_id"]: tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [packing.END_ID]
        for r in docs.collect()
    }


def check_ids(rows, ids, capacity):
    left = {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["start"] == r["piece"] * capacity and len(part) == r["length"]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        left[r["doc_id"]] = left.get(r["doc_id"], 0) + r["length"]
    return left


def test_documents_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack(docs, tokenizer_path()).collect()
    ids = whole(docs)
    assert check_ids(rows, ids, packing.CAPACITY) == {k: len(v) for k, v in ids.items()}
    least = -(-sum(map(len, ids.values())) // packing.CAPACITY)
    assert check(rows, packing.CAPACITY) <= least + 1


def test_odd_texts_keep_their_ids(spark):
    texts = [
        "it's I'LL we'd 's", "a<|endoftext|>b <|ENDOFTEXT|> c", "«x», ½ ² ̸= ≠ é É", "x\x1cy\x85z\xa0w　v",
        "Σίσυφος ΣΑΣ", "\U0001f600\U0001f600 漢字かな", "---!!!...", "don't!!! (Don’t)", "a" * 9000, "İstanbul ﬁ", "x\x00y",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack(docs, tokenizer_path()).collect()
    ids = whole(docs)
    assert check_ids(rows, ids, packing.CAPACITY) == {k: len(v) for k, v in ids.items()}


def plain_ids(text):
    from tokenizers import Tokenizer

    return np.array(Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_new_words_are_encoded_many_in_a_row(monkeypatch):
    dice = random.Random(5)
    words = ["".join(dice.choices("abcdefgß", k=9)) + dice.choice(["", "", ",", ".)"]) for _ in range(3000)]
    text, asked = " ".join(words), []
    encode = tokens.Encoder._encode
    monkeypatch.setattr(tokens.Encoder, "_encode", lambda self, texts: asked.append(len(texts)) or encode(self, texts))
    encoder = tokens.Encoder(tokenizer_path())
    assert list(encoder.ids(pa.array([text.encode()], pa.binary()))) == [plain_ids(text)]
    assert sum(asked) < 30
    # Known words are asked for no more, and a tokenizer without a mark gives the same ids.
    asked.clear()
    again = text.upper().replace("SS", "ß")
    assert list(encoder.ids(pa.array([again.encode()], pa.binary()))) == [plain_ids(again)] and sum(asked) == 0
    unmarked = tokens.Encoder(tokenizer_path())
    unmarked.ends = None
    assert list(unmarked.ids(pa.array([text.encode()], pa.binary()))) == [plain_ids(text)]


def test_ids_of_bytes_that_are_no_utf8_and_of_part_of_a_column(monkeypatch):
    monkeypatch.setattr(tokens, "_HELD_WORDS", 2)
    monkeypatch.setattr(tokens, "_HELD_CHUNKS", 2)
    texts = [b"skipped", b"", b" \t\x0b x\x1cY ", b"ab\xff\xfe cd\xc3 \xc3\x9f\xc3 \xe2\x82 x", b"A<|endoftext|>B <|ENDOFTEXT|> C", b"one two, three. one Two", b"\xc3"]
    encoder = tokens.Encoder(tokenizer_path())
    for _ in range(3):
        got = [i for t in range(1, len(texts)) for i in encoder.ids(pa.array(texts, pa.binary()).slice(t, 1))]
        assert got == [plain_ids(t.decode("utf-8", "replace")) for t in texts[1:]]
    assert list(encoder.ids(pa.array(texts, pa.binary()).slice(1))) == got
    assert list(encoder.ids(pa.array([], pa.binary()))) == []


def test_awkward_rows(awkward, nothing):
    rows = packing.pack(awkward, tokenizer_path(), capacity=256).collect()
    check(rows, 256)
    assert sum(r["piece"] == 0 for r in rows) == awkward.count()
    assert {(r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] in (3, 4, 5)} == {(1, zlib.crc32(b"\1\0\0\0"))}
    assert packing.pack(nothing, tokenizer_path()).count() == 0


def test_blocks_islands_and_second_round(spark):
    dice = random.Random(3)
    sizes = [dice.randint(1, 100) if dice.random() < 0.9 else 100 for _ in range(900)]
    rows = store(spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "uid long, length long"), "rows")
    found = packing.pack_pieces(rows, capacity=100, block_pieces=100, islands=2, epochs=2).collect()
    assert sorted(r["uid"] for r in found) == list(range(900))
    order = sorted(range(900), key=lambda i: -sizes[i])
    plain = packing.best_fit(packing.Grouping([], []), order, sizes, 100)
    assert check(found, 100) <= len(plain.bins) * 1.02


def test_crossover_keeps_injected_bins_and_every_piece():
    dice = random.Random(1)
    size = [dice.randint(1, 60) for _ in range(80)]
    order = list(range(80))
    a = packing.best_fit(packing.Grouping([], []), order, size, 100)
    b = packing.best_fit(packing.Grouping([], []), order[::-1], size, 100)
    child = packing.cross(a, b, size, 100, dice)
    assert sorted(i for content in child.bins for i in content) == order
    assert all(sum(size[i] for i in c) == f <= 100 for c, f in zip(child.bins, child.fill, strict=True))
    assert any(sorted(c) in [sorted(x) for x in b.bins] for c in child.bins)


def test_the_best_never_gets_worse_and_repeats():
    dice = random.Random(9)
    size = [dice.choice((34, 33, 51, 26, 49, 67, 17)) for _ in range(150)]
    first = packing.best_fit(packing.Grouping([], []), sorted(range(150), key=lambda i: -size[i]), size, 100)
    bins, used = packing.evolve(size, [], 4, 100, 30)
    assert used <= len(first.bins)
    assert packing.evolve(size, [], 4, 100, 30) == (bins, used)
    assert packing.evolve(size, [bins], 5, 100, 1)[1] <= used
