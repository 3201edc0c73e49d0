"""Quality rules as a bitmask ledger: measure once, judge by versioned policies afterwards.

`ledger` writes one row per document with its measurements and a mask of the rules it fails. A policy
is a mask of rules that count; applying another version or asking what a rule alone removes needs only
bitwise operations on the ledger, never the texts.

Null and empty texts have no words: they fail `few_words`. Repeated rows each give a row. All measures
cover whole texts; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomgrid.llm.common import per_text

# One bit per rule; the condition is SQL over the measurements, so a ledger can be checked anywhere.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "repeated_lines": "100 * n_dup_lines > 40 * n_lines",
    "symbols": "100 * n_symbols > 20 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "capitals": "2 * n_capitals > word_chars",
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}

POLICIES = {
    1: ("few_words", "repeated_words"),
    2: ("few_words", "repeated_words", "repeated_lines", "symbols", "short_words", "long_words", "capitals"),
}
BASE_POLICY = 1
CURRENT_POLICY = 2

_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"
_NOT_CAPITAL = bytes(b for b in range(256) if not 65 <= b <= 90)
_CONTINUATION = bytes(range(128, 192))
MANY_WORDS = 2_000_000
"""Distinct words up to which three word numbers fit one 64-bit integer."""


def policy_mask(version: int) -> int:
    return reduce(lambda mask, rule: mask | BITS[rule], POLICIES[version], 0)


def repeated_positions(words: list[bytes]) -> int:
    """Words covered by three-word windows that occur at least twice, first occurrences included."""
    n = len(words)
    if n < 4:
        return 0
    distinct = dict.fromkeys(words)
    number = dict(zip(distinct, range(len(distinct)), strict=True))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    base = len(number)
    pairs = ids[:-1] * base + ids[1:]
    if base > MANY_WORDS:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * base + ids[2:]
    _, which, count = np.unique(windows, return_inverse=True, return_counts=True)
    twice = count[which] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


def measure(text: bytes) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals)."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip(_SPACES)]
    solid = text.translate(None, _SPACES)
    return (
        len(words),
        len(solid.translate(None, _CONTINUATION)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_positions(words),
        len(lines),
        len(solid.translate(None, _NOT_CAPITAL)),
    )


def _prepare() -> Callable[[bytes], tuple]:
    return measure


def failed_bits(rules: dict[str, str] | None = None) -> Column:
    """Mask of the rules a measured row fails."""
    parts = [
        F.when(F.expr(condition), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        for i, condition in enumerate((rules or RULES).values())
    ]
    return reduce(Column.bitwiseOR, parts)


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements and failure mask per document."""
    measured = per_text(
        docs,
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
        " n_repeat_words bigint, n_lines bigint, n_capitals bigint",
        _prepare,
        "doc_id",
    )
    return measured.withColumn("failed", failed_bits())


def passes(version: int) -> Column:
    """Does a ledger row pass a policy?"""
    return F.col("failed").bitwiseAND(F.lit(policy_mask(version))) == 0


def judged(book: DataFrame, version: int = CURRENT_POLICY) -> DataFrame:
    return book.withColumn("base_failed", ~passes(BASE_POLICY)).withColumn("kept", passes(version))


def ablation(book: DataFrame, version: int = CURRENT_POLICY) -> DataFrame:
    """Per rule of a policy: documents it fails, and documents that only it fails.

    Rows are first counted per mask, of which there are at most 2 to the number of rules.
    """
    masked = book.select(F.col("failed").bitwiseAND(F.lit(policy_mask(version))).alias("mask"))
    counts = masked.groupBy("mask").agg(F.count(F.lit(1)).alias("docs"))
    rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).alias("bit")) for r in POLICIES[version]))
    each = counts.select("mask", "docs", F.inline(rules))
    hit = F.col("mask").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("docs")).otherwise(0)).alias("fails"),
        F.sum(F.when(hit & (F.bit_count("mask") == 1), F.col("docs")).otherwise(0)).alias("only_this"),
    )
