"""Token ids of whole texts by a sentence-piece merge vocabulary, and texts of ids.

The vocabulary merges neighbouring symbols, best score first and leftmost first among equals, wherever the joined
symbol is a piece. The last token of a text's encoding fixes the rest: what stands before it is encoded as if it
were the whole text. So one token per prefix is all there is to know:

* An Aho-Corasick automaton lists the pieces that end at each character.
* A piece can be the last token of a prefix if it is compatible with the last token of the prefix before it, which
  means that merging the two pieces' text alone gives the two again. Exactly one piece is.
* The ids are read off from the end: last token of the whole, last token of the prefix before it, and so on.

Compatibility undoes the merges of both pieces, latest first. Whenever the two symbols at the border could have
been joined before the merge just undone, the pair can't stand.

A character in no piece is spelled in byte tokens. White space is a symbol of its own that pieces only begin with,
so texts are cut before each run of it, and what a worker remembers are such chunks; the vocabulary is tested for
that property, and a text is one chunk where it does not hold.

Null and empty texts have no tokens and decode to the empty text. Very long texts go through whole, a chunk at a
time. Repeated rows are encoded each; equal texts have equal ids. An empty table gives no rows. Further
columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from fathomgrid.llm.common import byte_slices, texts
from fathomgrid.llm.memo import Memo, per_worker

SPACE = "▁"
HELD_CHUNKS = 300_000
HELD_PAIRS = 500_000
LONGEST_HELD = 64
"""Characters of the longest chunk that is remembered."""

RESULT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class MergeVocabulary:
    """Pieces with ids and scores. Characters that occur only inside pieces have ids below 0."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int]):
        import ahocorasick

        self.byte_ids = byte_ids
        self.byte_of = {i: b for b, i in enumerate(byte_ids)}
        self.id_of = {text: i for text, (i, _) in pieces.items()}
        self.score = {i: score for i, score in pieces.values()}
        for c in sorted({c for text in pieces for c in text} - self.id_of.keys()):
            self.id_of[c] = -1 - len(self.id_of)
        self.text_of = {i: text for text, i in self.id_of.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for text, i in self.id_of.items():
            if len(text) == 1 or self._derive(text, i):
                self.automaton.add_word(text, (i, len(text)))
        self.automaton.make_automaton()
        self.compatible = Memo(lambda pair: self._compatible(*pair), HELD_PAIRS)
        self.cuts = not any(SPACE in text.lstrip(SPACE) for text in pieces)

    @classmethod
    def load(cls, path: str) -> MergeVocabulary:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))]
        byte_ids = [i for i in ids if model.is_byte(i)]
        byte_ids.sort(key=lambda i: int(model.id_to_piece(i)[1:-1], 16))
        return cls({model.id_to_piece(i): (i, model.get_score(i)) for i in plain}, byte_ids)

    def _derive(self, text: str, token: int) -> bool:
        """Merge `text` alone; True if it becomes one token, whose last merge is kept."""
        parts = [self.id_of[c] for c in text]
        joined = list(text)
        while len(parts) > 1:
            found = [
                (-self.score[t], at)
                for at in range(len(joined) - 1)
                if (t := self.id_of.get(joined[at] + joined[at + 1])) is not None
            ]
            if not found:
                return False
            _, at = min(found)
            last = parts[at], parts[at + 1]
            joined[at : at + 2] = [joined[at] + joined[at + 1]]
            parts[at : at + 2] = [self.id_of[joined[at]]]
        self.halves[token] = last
        return True

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' text gives these two tokens."""
        limit, left_first = None, False
        while True:
            joined = self.id_of.get(self.text_of[left] + self.text_of[right])
            if joined is not None:
                score = self.score[joined]
                # Of equal scores the merge further left comes first; a merge inside `left` is.
                if limit is None or score > limit or (score == limit and not left_first):
                    return False
            a, b = self.halves.get(left), self.halves.get(right)
            if a is None and b is None:
                return True
            # The later merge is the one of lower score, of equal ones the one further right.
            if b is None or (a is not None and self.score[left] < self.score[right]):
                limit, left_first, left = self.score[left], True, a[1]
            else:
                limit, left_first, right = self.score[right], False, b[0]

    def last_tokens(self, text: str) -> list[tuple[int, int] | None]:
        """Per prefix (by its length less one) the last token and its length; None for a character in no piece."""
        table: list[tuple[int, int] | None] = [None] * len(text)
        compatible = self.compatible
        for end, (token, length) in self.automaton.iter(text):
            if length <= end:
                before = table[end - length]
                if before is not None and not compatible[before[0], token]:
                    continue
            table[end] = token, length
        return table

    def ids(self, chunk: str) -> list[int]:
        """Ids of normalised text, recovered from the last token backwards."""
        table, out = self.last_tokens(chunk), []
        end = len(chunk)
        while end:
            found = table[end - 1]
            if found is None or found[0] < 0:
                out += [self.byte_ids[b] for b in reversed(chunk[end - 1].encode("utf-8", "replace"))]
                end -= 1
            else:
                out.append(found[0])
                end -= found[1]
        out.reverse()
        return out

    def chunks(self, text: str) -> list[str]:
        """`text` normalised and cut before each run of white space symbols."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        return _CHUNK.findall(marked) if self.cuts else [marked]

    def encode(self, text: str) -> list[int]:
        return [i for chunk in self.chunks(text) for i in self.ids(chunk)]

    def surface(self, ids: list[int]) -> str:
        """Text of ids with its white space symbols; bytes that spell no character become U+FFFD each."""
        value_of, text_of = self.byte_of, self.text_of
        if value_of.keys().isdisjoint(ids):
            return "".join(map(text_of.__getitem__, ids))
        out, spelled = [], bytearray()
        for i in ids:
            if i in value_of:
                spelled.append(value_of[i])
                continue
            out += [_spell(spelled), text_of[i]]
            spelled.clear()
        return "".join([*out, _spell(spelled)])

    def decode(self, ids: list[int]) -> str:
        return _plain(self.surface(ids))


_CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def _plain(surface: str) -> str:
    """Without the white space symbol that encoding put in front."""
    return surface.removeprefix(SPACE).replace(SPACE, " ")


def _spell(spelled: bytearray) -> str:
    """Characters of bytes; every byte that belongs to none is replaced alone."""
    out, rest = [], bytes(spelled)
    while rest:
        try:
            return "".join([*out, rest.decode("utf-8")])
        except UnicodeDecodeError as e:
            out += [rest[: e.start].decode("utf-8"), "�"]
            rest = rest[e.start + 1 :]
    return "".join(out)


class ChunkCoder:
    """Encodes and decodes whole texts by remembered chunks."""

    def __init__(self, vocabulary: MergeVocabulary):
        self.vocabulary = vocabulary
        self.held: dict[str, bytes | tuple[bytes, str]] = Memo(self._of, HELD_CHUNKS)

    def _of(self, chunk: str) -> bytes | tuple[bytes, str]:
        """Decimal ids, each with a comma behind it, and what they decode to where that is not the chunk again."""
        ids = self.vocabulary.ids(chunk)
        written, surface = "".join([f"{i}," for i in ids]).encode(), self.vocabulary.surface(ids)
        return written if surface == chunk else (written, surface)

    def coded(self, text: str) -> tuple[bytes, str]:
        """Comma-joined ids, with a comma at the end, and the decoded text."""
        chunks = self.vocabulary.chunks(text)
        if max(map(len, chunks), default=0) <= LONGEST_HELD:
            made = list(map(self.held.__getitem__, chunks))
        else:
            held, of = self.held, self._of
            made = [held[c] if len(c) <= LONGEST_HELD else of(c) for c in chunks]
        if tuple in set(map(type, made)):
            both = [m if type(m) is tuple else (m, c) for m, c in zip(made, chunks, strict=True)]
            made, chunks = [m[0] for m in both], [m[1] for m in both]
        return b"".join(made), _plain("".join(chunks))

    def digests(self, text: bytes) -> tuple[int, str, str]:
        ids, decoded = self.coded(text.decode("utf-8", "replace"))
        return (
            ids.count(b","),
            hashlib.sha256(ids[:-1]).hexdigest(),
            hashlib.sha256(decoded.encode("utf-8", "replace")).hexdigest(),
        )


def shared_coder(model: str) -> ChunkCoder:
    return per_worker(("pieces", model), lambda: ChunkCoder(MergeVocabulary.load(model)))


def _mapped(docs: DataFrame, model: str, schema: str, types: list[pa.DataType], of: Callable) -> DataFrame:
    """doc_id beside what `of(coder, text)` returns."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared_coder(model)
        for whole in batches:
            for batch in byte_slices(whole):
                made = zip(*(of(coder, t) for t in batch.column("text").to_pylist()), strict=True)
                columns = [pa.array(v, k) for v, k in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    return texts(docs, "doc_id").mapInArrow(run, schema)


def token_ids(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and the ids of its text."""
    split = lambda coder, text: ([int(i) for i in coder.coded(text.decode("utf-8", "replace"))[0].split(b",")[:-1]],)
    return _mapped(docs, model, "doc_id bigint, ids array<int>", [pa.list_(pa.int32())], split)


def decoded(rows: DataFrame, model: str) -> DataFrame:
    """doc_id and the text of `ids`, a list of token ids; null lists decode to the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared_coder(model).vocabulary
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = [vocabulary.decode(ids or []) for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(made, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def round_trips(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 per document; no shuffle, texts stay where they are read."""
    return _mapped(docs, model, RESULT, [pa.int64(), pa.string(), pa.string()], ChunkCoder.digests)
