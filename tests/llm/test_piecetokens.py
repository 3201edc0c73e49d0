"""Prefix tables next to the library that defines the ids."""

import hashlib
import random

import pytest

from fathomgrid.llm import piecetokens
from fathomgrid.llm.queries import tokenizer_path

MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=tokenizer_path(MODEL))


@pytest.fixture(scope="module")
def vocabulary():
    return piecetokens.MergeVocabulary.load(tokenizer_path(MODEL))


FIXED = [
    "", " ", "   ", "a", " a", "a ", "  a  b ", "\n\t x\r\n", "▁a ▁ ▁▁b", "<s></s><unk><0x41>", "é é ﬁ ① \x00\x01",
    "日本語 漢字かな", "🤷🏽‍♂️ \U0010ffff", " " * 100 + "x" + " " * 33, "a" * 500, "ab" * 300 + " " + "." * 200,
]


def test_fixed_texts(library, vocabulary):
    for text in FIXED:
        ids = library.encode(text)
        assert vocabulary.encode(text) == ids, text
        assert vocabulary.decode(ids) == library.decode(ids), text


def test_random_texts(library, vocabulary):
    dice = random.Random(7)
    pieces = list(vocabulary.id_of)
    signs = "ab e▁\n\t.,éß漢字日本のx🤷\x00�<>01"
    for _ in range(4000):
        if dice.random() < 0.5:
            text = "".join(dice.choice(pieces) for _ in range(dice.randint(0, 9)))
        else:
            text = "".join(dice.choice(signs) for _ in range(dice.randint(0, 40)))
        assert vocabulary.encode(text) == library.encode(text), text


def test_any_ids_decode(library, vocabulary):
    dice = random.Random(8)
    for _ in range(3000):
        ids = [dice.choice([dice.randint(3, 258), dice.randint(3, 31_999), 259, 29_871]) for _ in range(dice.randint(0, 9))]
        assert vocabulary.decode(ids) == library.decode(ids), ids


def test_one_last_token_per_prefix(vocabulary):
    """Each prefix of a chunk has exactly one compatible piece, and it is the last of the prefix's own encoding."""
    chunk = "▁unbelievably"
    for end, found in enumerate(vocabulary.last_tokens(chunk), 1):
        fits = [
            t for e, (t, n) in vocabulary.automaton.iter(chunk[:end])
            if e == end - 1 and (n == end or vocabulary.compatible[vocabulary.last_tokens(chunk[: end - n])[-1][0], t])
        ]
        assert fits == [found[0]] and vocabulary.ids(chunk[:end])[-1] == found[0]


def test_pieces_that_hold_spaces_are_not_cut():
    pieces = {c: (i, -9.0 - i) for i, c in enumerate("▁abc")} | {"a▁b": (10, -1.0), "▁b": (11, 0.0), "▁a": (12, -2.0)}
    vocabulary = piecetokens.MergeVocabulary(pieces, [])
    assert not vocabulary.cuts and vocabulary.chunks("c a b") == ["▁c▁a▁b"]
    assert vocabulary.encode("ca b") == [0, 3, 10]


def test_query_next_to_the_library(spark, awkward, library):
    got = {}
    for r in piecetokens.round_trips(awkward, tokenizer_path(MODEL)).collect():
        got.setdefault(r["doc_id"], set()).add((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]))
    want = {}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for r in awkward.select("doc_id", "text").collect():
        ids = library.encode(r["text"] or "")
        want.setdefault(r["doc_id"], set()).add((len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert got == want


def test_ids_come_back_as_texts(spark, awkward, nothing):
    path = tokenizer_path(MODEL)
    ids = piecetokens.token_ids(awkward, path)
    back = sorted((tuple(r) for r in piecetokens.decoded(ids, path).collect()), key=repr)
    assert back == sorted(((r["doc_id"], r["text"] or "") for r in awkward.collect()), key=repr)
    assert piecetokens.round_trips(nothing, path).count() == 0
    assert piecetokens.decoded(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), path).first()["text"] == ""


def test_memo_forgets_the_older_half_only():
    from fathomgrid.llm.memo import Memo

    made = []
    memo = Memo(lambda k: made.append(k) or k * 2, 3)
    for k in (1, 2, 3, 1, 4, 1, 2):
        assert memo[k] == 2 * k
    assert made == [1, 2, 3, 4] and len(memo) <= 3


def test_chunks_that_decode_to_themselves_are_held_as_ids_alone(library, vocabulary):
    coder = piecetokens.ChunkCoder(vocabulary)
    for text in [*FIXED, "plain words \ud800 plain"]:
        want = library.encode(text.encode("utf-8", "replace").decode())
        ids, decoded = coder.coded(text.encode("utf-8", "replace").decode())
        assert [int(i) for i in ids.split(b",")[:-1]] == want and decoded == library.decode(want), text
    assert coder.held["▁a"] == b"".join(b"%d," % i for i in vocabulary.ids("▁a"))
