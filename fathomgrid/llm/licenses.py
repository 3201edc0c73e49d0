"""License scans: an Aho-Corasick pass finds notices and identifier tags, a shunting-yard parser reads tags.

Words are maximal runs of bytes outside ASCII punctuation, spaces and controls after A-Z are
lower-cased. A notice is a phrase whose words stand consecutively. After an identifier tag the rest of
the line is parsed as a licence expression: `with` binds closest, then `and`, then `or`.

score: how freely a text may be used, 0 (reserved) to 1 (public domain). All notices and expressions bind, so the
least free one counts. In an expression `or` leaves the choice, so the freer side counts; `and` binds both; an
exception named by `with` frees a little. An expression counts as a whole: neither the identifiers in it nor
phrases on its line count besides. Without any notice nothing is known: 0.5.

Null and empty texts give no words, empty labels and 0.5. Repeated rows each give a row. A malformed
expression yields the label `invalid-expression` and no value.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame

from fathomgrid.llm.common import UPPER_TO_LOWER, per_text

# Phrases whose places are counted, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Further notices. Phrases are words in lower case.
NOTICES = {
    "cc0": "cc0",
    "public domain": "public-domain",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons": "creative-commons",
    "apache license": "apache",
    "mit license": "mit",
    "bsd license": "bsd",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "eclipse public license": "epl",
    "no license": "reserved-by-silence",
    "proprietary and confidential": "proprietary",
}

FREEDOM = {
    "cc0": 1.0,
    "public-domain": 1.0,
    "mit": 0.9,
    "isc": 0.9,
    "bsd": 0.9,
    "apache": 0.9,
    "cc-by": 0.8,
    "creative-commons": 0.6,
    "mpl": 0.6,
    "epl": 0.6,
    "cc-by-sa": 0.5,
    "lgpl": 0.5,
    "gpl": 0.3,
    "agpl": 0.25,
    "cc-by-nd": 0.2,
    "cc-by-nc": 0.2,
    "cc-by-nc-sa": 0.2,
    "cc-by-nc-nd": 0.1,
    "reserved-by-silence": 0.05,
    "proprietary": 0.0,
    "reserved": 0.0,
}
UNKNOWN = 0.5
EXCEPTION = 0.1

TAG = b"spdx-license-identifier:"
TAG_WORDS = "spdx license identifier"
_TOKEN = re.compile(r"[()]|[^\s()]+")
_END = re.compile(rb"\n|\*/|-->")
_BINDS = {"or": 1, "and": 2, "with": 3}
_NOT_A_WORD = bytes(
    b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


def identifier_freedom(name: str) -> float:
    """Freedom of an identifier: the longest known label it begins with, after its version is cut."""
    known = [label for label in FREEDOM if name == label or name.startswith(label + "-")]
    return FREEDOM[max(known, key=len)] if known else UNKNOWN


def to_postfix(tokens: list[str]) -> list[str]:
    """Shunting yard. Raises ValueError where operands, operators or brackets do not fit together."""
    out: list[str] = []
    held: list[str] = []
    operand_next = True
    for token in tokens:
        word = token.lower()
        if word == "(":
            if not operand_next:
                raise ValueError("a bracket follows an operand")
            held.append(word)
        elif word == ")":
            while held and held[-1] != "(":
                out.append(held.pop())
            if operand_next or not held:
                raise ValueError("a bracket closes nothing")
            held.pop()
        elif word in _BINDS:
            if operand_next:
                raise ValueError("an operator has no left side")
            while held and held[-1] != "(" and _BINDS[held[-1]] >= _BINDS[word]:
                out.append(held.pop())
            held.append(word)
            operand_next = True
        else:
            if not operand_next:
                raise ValueError("two operands meet")
            out.append(word)
            operand_next = False
    if operand_next or "(" in held:
        raise ValueError("the expression is cut short")
    return out + held[::-1]


def evaluate(expression: str) -> tuple[float, set[str]]:
    """Freedom of a licence expression and the identifiers it names."""
    stack: list[tuple[float, frozenset[str]]] = []
    for token in to_postfix(_TOKEN.findall(expression)):
        if token not in _BINDS:
            stack.append((identifier_freedom(token), frozenset([token])))
            continue
        (right, others), (left, names) = stack.pop(), stack.pop()
        if token == "with":
            # What follows `with` names an exception, no licence.
            stack.append((min(1.0, left + EXCEPTION), names))
        else:
            stack.append((max(left, right) if token == "or" else min(left, right), names | others))
    value, names = stack[0]
    return value, set(names)


def _without_finer(labels: set[str]) -> set[str]:
    """A finer notice stands for the phrase it contains."""
    finer = {b for b in labels for other in labels if other.startswith(b + "-") or other in ("l" + b, "a" + b)}
    return labels - finer


def scanner(notices: dict[str, str] | None = None) -> Callable[[bytes], tuple]:
    """A function from one text to (n_words, n_base, first, last, base_labels, labels, score)."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for phrase, label in {**NOTICES, **(notices or {}), **BASE, TAG_WORDS: ""}.items():
        automaton.add_word(f" {phrase} ", (len(phrase) + 1, label, phrase in BASE))
    automaton.make_automaton()
    tags = ahocorasick.Automaton()
    tags.add_word(TAG.decode(), len(TAG))
    tags.make_automaton()

    def as_line(text: bytes) -> str:
        # Bytes become characters one to one, so places need no decoding.
        return f" {b' '.join(text.translate(_NOT_A_WORD).split()).decode('latin-1')} "

    def scan(text: bytes) -> tuple:
        line = as_line(text)
        base: list[int] = []
        base_labels: set[str] = set()
        labels: set[str] = set()
        values: list[float] = []
        tagged = False
        for end, (length, label, is_base) in automaton.iter(line):
            if not label:
                tagged = True
                continue
            labels.add(label)
            if is_base:
                base.append(end - length)
                base_labels.add(label)
        notices = labels
        if tagged:
            low, rest, last_stop = text.translate(UPPER_TO_LOWER), [], 0
            named: set[str] = set()
            for end, length in tags.iter(low.decode("latin-1")):
                found = _END.search(low, end + 1)
                stop = found.start() if found else len(low)
                rest.append(low[last_stop : end + 1 - length])
                last_stop = max(last_stop, stop)
                try:
                    value, names = evaluate(low[end + 1 : stop].decode("utf-8", "replace"))
                    values.append(value)
                    named |= {n.replace(",", " ") for n in names}
                except ValueError:
                    named.add("invalid-expression")
            # Phrases on a tag's line are read as part of its expression; a break keeps their sides apart.
            outside = b"\n\x00\n".join([*rest, low[last_stop:]])
            notices = {label for part in outside.split(b"\x00") for _, (_, label, _) in automaton.iter(as_line(part)) if label}
            labels = labels | named
        values += [FREEDOM[x] for x in _without_finer(notices) if x in FREEDOM]
        first = line.count(" ", 0, min(base)) if base else None
        last = line.count(" ", 0, max(base)) if base else None
        return (
            line.count(" ") - 1 if len(line) > 2 else 0,
            len(base),
            first,
            last,
            ",".join(sorted(base_labels)),
            ",".join(sorted(labels)),
            min(values, default=UNKNOWN),
        )

    return scan


def license_scan(docs: DataFrame, notices: dict[str, str] | None = None) -> DataFrame:
    """One row per document; `notices` adds phrases and labels to the built-in ones."""
    return per_text(
        docs,
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint,"
        " base_labels string, labels string, score double",
        lambda: scanner(notices),
        "doc_id",
    )
