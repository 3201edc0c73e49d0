"""Token ids of whole texts by a public tokenizer's file.

The tokenizer drops white space, so the ids of a text are those of its white-space separated chunks in a row.
The distinct chunks of some texts are looked up once. A plain chunk (letters, then ASCII punctuation) is remembered
by its two parts, which the tokenizer never joins. New parts are encoded many in a row, as one text: where the
tokenizer marks tokens that end a word, these tell the parts apart again.
"""

from __future__ import annotations

import os
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from fathomgrid.llm.common import byte_slices

_PLAIN = r"^(?P<word>(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)(?P<tail>[!-&(-/:-@\[-`{-~]*)$"
"""a-z, ß-ö and ø-ÿ, then punctuation without the apostrophe, by bytes of UTF-8."""
_HELD_CHUNKS = 250_000
_HELD_WORDS = 800_000
_ROW_WORDS = 200


class Known:
    """Ids by text, made on first use. Two generations: at a limit the older one is dropped, so what is in steady use
    stays known."""

    def __init__(self, make: Callable[[list[bytes]], list[bytes]], held: int):
        self.make, self.held = make, held
        self.young: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def of(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each of distinct `texts`: those of the older generation are taken over, the rest made."""
        if len(self.young) > self.held:
            self.older, self.young = self.young, {}
        found = list(map(self.young.get, texts))
        missing = [i for i, ids in enumerate(found) if ids is None]
        unknown = []
        for i in missing:
            found[i] = self.older.get(texts[i])
            if found[i] is None:
                unknown.append(i)
        for i, ids in zip(unknown, self.make([texts[i] for i in unknown]), strict=True):
            found[i] = ids
        self.young.update((texts[i], found[i]) for i in missing)
        return found


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.ends = _word_ends(self.tokenizer)
        self.parts = Known(self._encode_parts, _HELD_WORDS)
        self.others = Known(lambda chunks: self._encode([c.decode("utf-8", "replace") for c in chunks]), _HELD_CHUNKS)

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _encode_parts(self, parts: list[bytes]) -> list[bytes]:
        """Ids of parts of plain chunks, each one word to the tokenizer."""
        if self.ends is None:
            return self._encode([p.decode() for p in parts])
        rows = [parts[at : at + _ROW_WORDS] for at in range(0, len(parts), _ROW_WORDS)]
        out: list[bytes] = []
        for row, ids in zip(rows, self._encode([b" ".join(row).decode() for row in rows]), strict=True):
            ends = (4 * np.flatnonzero(self.ends[np.frombuffer(ids, "<u4")]) + 4).tolist()
            if len(ends) == len(row) and ends[-1] == len(ids):
                out += [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]
            else:
                out += self._encode([p.decode() for p in row])
        return out

    def _part_ids(self, parts: pa.Array) -> pa.Array:
        coded = parts.dictionary_encode()
        return pa.array(self.parts.of(coded.dictionary.to_pylist()), pa.large_binary()).take(coded.indices)

    def _chunk_ids(self, chunks: pa.Array) -> pa.Array:
        """Ids of each of distinct chunks."""
        halves = pc.extract_regex(chunks, _PLAIN)
        ids = pc.binary_join_element_wise(
            *(self._part_ids(pc.struct_field(halves, [name])) for name in ("word", "tail")), pa.scalar(b"", pa.large_binary())
        )
        other = halves.is_null()
        return pc.replace_with_mask(ids, other, pa.array(self.others.of(chunks.filter(other).to_pylist()), pa.large_binary()))

    def ids(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text (UTF-8 bytes). Texts are lower-cased first (A-Z), as the tokenizer does, unless a text has a
        special mark."""
        whole = pa.RecordBatch.from_arrays([texts], names=["text"])
        for part in byte_slices(whole, rows=max(1, len(texts))):
            # Bytes that are no UTF-8 stay as they are: both functions look at ASCII alone.
            read = part.column("text").view(pa.string())
            lowered = pc.if_else(pc.match_substring(read, "<|"), read, pc.ascii_lower(read))
            split = pc.ascii_split_whitespace(lowered)
            coded = split.flatten().view(pa.binary()).dictionary_encode()
            found = self._chunk_ids(coded.dictionary).take(coded.indices)
            _, at, data = found.buffers()
            ends = np.frombuffer(at, np.int64)[found.offset + split.offsets.to_numpy() - split.offsets[0].as_py()].tolist()
            view = memoryview(data or b"")
            for a, b in zip(ends, ends[1:], strict=False):
                yield bytes(view[a:b])


def _word_ends(tokenizer) -> np.ndarray | None:
    """By id, whether the token ends a word; none where the tokenizer has no mark for it."""
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    if not suffix:
        return None
    vocabulary = tokenizer.get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return ends


def shared_encoder(path: str) -> Encoder:
    """One encoder per worker process, so that what it remembers serves later tasks too."""
    state = sys.modules.setdefault("_fathomgrid_worker", types.ModuleType("_fathomgrid_worker"))
    held = state.__dict__.setdefault("encoders", {})
    if path not in held:
        held[path] = Encoder(path)
    return held[path]
