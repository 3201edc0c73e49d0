"""PII: format-preserving pseudonyms by a keyed Feistel permutation.

Card numbers, phone numbers, social security numbers, IBANs, IPv4 and IPv6 addresses, dates, e-mail local
parts, secrets behind their name and cloud access keys are replaced by values of the same form. The same value
becomes the same pseudonym in every document, so records stay linked, and no value maps to itself. Letters of an
e-mail address keep their case, and addresses that differ in case only stay linked.

A value is numbered within its format (0 to size-1). The permutation is P^-1(P(x) + 1 mod size) with P an
alternating Feistel network over a keyed hash: a bijection without fixed points. Numbers with a check
digit keep a right one: the payload is permuted and the check recomputed; 13 to 19 digits whose check fails are
no card number and stay. Dates stay dates of their century range and layout; invalid dates are no dates and
stay. Four numbers after `v`, `version` or `release` are no address. Bare ten digits are left, as they are times as
often as phones. The form of one value never depends on another, so ties cannot arise.

The key comes from the caller; the queries take it from the session setting `spark.fathomgrid.pseudonyms.key`.

Null texts stay null, empty texts and texts without such values stay as they are; repeated rows each give
a row; an empty table gives an empty one; very long texts are read whole in linear time and nothing is shuffled.
Other columns are untouched.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import ipaddress
import math
import re
import string
import sys
import unicodedata
import warnings
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomgrid.llm.common import byte_slices

KEY_SETTING = "spark.fathomgrid.pseudonyms.key"
TRIAL_KEY = "fathomgrid pseudonyms"
"""For trials on made-up data only: whoever reads this can invert what it made."""
ROUNDS = 8

_DAY0 = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2099, 12, 31).toordinal() - _DAY0 + 1

_MONTHS = "January February March April May June July August September October November December".split()
_MONTH = "|".join(f"{m}|{m[:3]}" for m in _MONTHS)

_FORMS = re.compile(
    rf"""
    (?P<email>(?<![\w.%+\-])[\w.%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+)
  | (?P<ip6>(?<![\w:.])(?:[0-9A-Fa-f]{{1,4}}:){{2,7}}(?::?[0-9A-Fa-f]{{1,4}})(?::[0-9A-Fa-f]{{1,4}}){{0,6}}(?![\w:]))
  | (?P<ip>(?<![\d.vV])(?<![Vv]ersion[ ])(?<![Rr]elease[ ])(?:\d{{1,3}}\.){{3}}\d{{1,3}}(?!\.?\d))
  | (?P<date>(?<!\d)(?:(?:19|20)\d\d-\d\d-\d\d|\d{{1,2}}(?P<mark>[./])\d{{1,2}}(?P=mark)(?:19|20)\d\d)(?!\d))
  | (?P<named_date>(?<!\d)\d{{1,2}}[ ](?:{_MONTH})[ ](?:19|20)\d\d(?!\d)
      |\b(?:{_MONTH})[ ]\d{{1,2}},[ ](?:19|20)\d\d(?!\d))
  | (?P<phone>(?:\+\d{{1,3}}[ .\-]?)?\(\d{{3}}\)[ ]?\d{{3}}[ .\-]\d{{4}}(?!\d)
      |(?<![\d+])\d{{3}}[.\-]\d{{3}}[.\-]\d{{4}}(?!\d)
      |\+\d{{1,3}}[ .\-]?\d{{3}}[ .\-]?\d{{3}}[ .\-]?\d{{4}}(?!\d)
      |\+\d{{1,3}}(?:[ \-]\d{{2,4}}){{2,4}}(?![\d.]))
  | (?P<ssn>(?<![\d\-])\d{{3}}-\d{{2}}-\d{{4}}(?![\d\-]))
  | (?P<access_key>\bA[KS]IA[0-9A-Z]{{16}}\b)
  | (?P<number>(?<!\d)(?:\d{{13,19}}|\d{{4}}(?P<sep>[ \-])\d{{4}}(?P=sep)\d{{4}}(?P=sep)\d{{1,7}}|\d{{4}}[ \-]\d{{6}}[ \-]\d{{5}})(?!\d))
    """,
    re.VERBOSE,
)
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_IBAN_LENGTHS = dict(
    x.split("=")
    for x in (
        "AD=24 AE=23 AL=28 AT=20 AZ=28 BA=20 BE=16 BG=22 BH=22 BR=29 BY=28 CH=21 CR=22 CY=28 CZ=24 DE=22 DK=18 DO=28"
        " EE=20 EG=29 ES=24 FI=18 FO=18 FR=27 GB=22 GE=22 GI=23 GL=18 GR=27 GT=28 HR=21 HU=28 IE=22 IL=23 IQ=23 IS=26"
        " IT=27 JO=30 KW=30 KZ=20 LB=28 LC=32 LI=21 LT=20 LU=20 LV=21 MC=27 MD=24 ME=22 MK=19 MR=27 MT=31 MU=30 NL=18"
        " NO=15 PK=24 PL=28 PS=29 PT=25 QA=29 RO=24 RS=22 SA=24 SC=31 SE=24 SI=19 SK=24 SM=27 ST=25 SV=28 TL=23 TN=24"
        " TR=26 UA=29 VA=22 VG=24 XK=20"
    ).split()
)
# In quotes, or bare right behind the sign with a letter and a digit near its start, as a word of prose has not.
_SECRET = re.compile(
    r"""\b(?:token|secret|password|passwd|api[_\-]?key|access[_\-]?key)\s*[=:]\s*["']([^"'\s]{6,})["']
      |\b(?:secret|password|passwd|api[_\-]?key|access[_\-]?key)(?:=|:[ ]?)
        ((?=[\w\-]{0,63}\d)(?=[\w\-]{0,63}[A-Za-z])[\w\-]{8,}+)(?![^\s,;.&])""",
    re.IGNORECASE | re.VERBOSE | re.ASCII,
)
_MAYBE = re.compile(r"[0-9@]")


class Permuter:
    """Keyed permutations of 0..size-1 per kind of value."""

    def __init__(self, key: bytes):
        self.key = hashlib.sha256(key).digest()

    def _round(self, kind: str, number: int, value: int) -> int:
        data = b"%s|%d|%d" % (kind.encode(), number, value)
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=32).digest(), "big")

    def _pass(self, kind: str, x: int, a: int, b: int, back: bool) -> int:
        left, right = divmod(x, b)
        for i in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2 == 0:
                left = (left + sign * self._round(kind, i, right)) % a
            else:
                right = (right + sign * self._round(kind, i, left)) % b
        return left * b + right

    def swap(self, kind: str, x: int, size: int) -> int:
        """Another number below `size`, one to one."""
        if size < 2:
            return x
        a = math.isqrt(size - 1) + 1
        y = self._walk(kind, x, a, size, False)
        return self._walk(kind, (y + 1) % size, a, size, True)

    def _walk(self, kind: str, x: int, a: int, size: int, back: bool) -> int:
        # Cycle walking: the square is hardly larger than the format.
        x = self._pass(kind, x, a, a, back)
        while x >= size:
            x = self._pass(kind, x, a, a, back)
        return x


def luhn_digit(payload: str) -> int:
    total = 0
    for i, d in enumerate(reversed(payload)):
        n = int(d) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def _refill(form: str, digits: str) -> str:
    """Put digits back where the form has digits."""
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in form)


class Pseudonyms:
    """Replaces the values in one text and counts them by kind."""

    def __init__(self, key: bytes):
        self.permuter = Permuter(key)
        self.known: dict[tuple[str, str], str] = {}

    def digits(self, kind: str, digits: str) -> str:
        return str(self.permuter.swap(f"{kind}{len(digits)}", int(digits), 10 ** len(digits))).zfill(len(digits))

    def letters(self, kind: str, value: str) -> str:
        """Letters and digits are permuted within their alphabets as one mixed-radix number; case and the rest stay."""
        x, size = 0, 1
        for c in value:
            base, at = _place(c)
            if base:
                x, size = x * base + at, size * base
        x = self.permuter.swap(f"{kind}{_form(value)}", x, size)
        out = []
        for c in reversed(value):
            base, _ = _place(c)
            if base:
                x, at = divmod(x, base)
                c = _alphabet(c)[at]
            out.append(c)
        return "".join(reversed(out))

    def email(self, value: str) -> str | None:
        local, _, domain = value.rpartition("@")
        if not any(map(str.isalnum, local)):
            return None
        # Case is put back letter by letter: only ASCII letters have it lowered before.
        lower = "".join(c.lower() if c < "\x80" else c for c in local)
        new = self.letters("email" + domain.lower(), lower)
        return "".join(n.upper() if c != m else n for c, m, n in zip(local, lower, new)) + "@" + domain

    def ip(self, value: str) -> str | None:
        parts = [int(p) for p in value.split(".")]
        if max(parts) > 255:
            return None
        x = self.permuter.swap("ip", int.from_bytes(bytes(parts), "big"), 1 << 32)
        return ".".join(map(str, x.to_bytes(4, "big")))

    def ip6(self, value: str) -> str | None:
        # `::` among few groups is more often a name of a program than an address.
        groups = [g for g in value.split(":") if g]
        if len(groups) < 3 or not any(c.isdigit() for c in value):
            return None
        try:
            number = int(ipaddress.IPv6Address(value))
        except ValueError:
            return None
        return str(ipaddress.IPv6Address(self.permuter.swap("ip6", number, 1 << 128)))

    def access_key(self, value: str) -> str:
        return value[:4] + self.letters("access_key", value[4:])

    def date(self, value: str) -> str | None:
        if value[4] == "-":
            day = _day_of(*map(int, value.split("-")))
            return day and self._day(day).isoformat()
        mark = "/" if "/" in value else "."
        first, second, year = value.split(mark)
        day, month_first = _day_of(int(year), int(second), int(first)), False
        if day is None and mark == "/":
            day, month_first = _day_of(int(year), int(first), int(second)), True
        if day is None:
            return None
        new = self._day(day)
        width = 2 if len(first) == len(second) == 2 else 1
        pair = [f"{new.day:0{width}d}", f"{new.month:0{width}d}"]
        return mark.join([*(reversed(pair) if month_first else pair), f"{new.year:04d}"])

    def named_date(self, value: str) -> str | None:
        words = value.replace(",", "").split(" ")
        name, number = (words[0], words[1]) if value[0].isalpha() else (words[1], words[0])
        month = next(i for i, m in enumerate(_MONTHS, 1) if m.startswith(name))
        day = _day_of(int(words[2]), month, int(number))
        if day is None:
            return None
        new = self._day(day)
        whole = name in _MONTHS
        name = _MONTHS[new.month - 1] if whole else _MONTHS[new.month - 1][:3]
        return f"{name} {new.day}, {new.year:04d}" if value[0].isalpha() else f"{new.day} {name} {new.year:04d}"

    def _day(self, day: datetime.date) -> datetime.date:
        return datetime.date.fromordinal(_DAY0 + self.permuter.swap("date", day.toordinal() - _DAY0, _DAYS))

    def phone(self, value: str) -> str | None:
        head = re.match(r"\+\d{1,3}(?=[ .\-(])", value)
        rest = value[head.end() :] if head else value
        digits = "".join(c for c in rest if c.isdigit())
        if not 6 <= len(digits) <= 15:
            return None
        return (head[0] if head else "") + _refill(rest, self.digits("phone", digits))

    def ssn(self, value: str) -> str | None:
        return _refill(value, self.digits("ssn", value.replace("-", "")))

    def number(self, value: str) -> str | None:
        digits = "".join(c for c in value if c.isdigit())
        if luhn_digit(digits[:-1]) != int(digits[-1]):
            return None
        payload = self.digits("luhn", digits[:-1])
        return _refill(value, payload + str(luhn_digit(payload)))

    def iban(self, value: str) -> str | None:
        plain = value.replace(" ", "")
        if _mod97(plain[4:] + plain[:4]) != 1:
            return None
        body = self.letters("iban" + plain[:2], plain[4:])
        whole = plain[:2] + f"{98 - _mod97(body + plain[:2] + '00'):02d}" + body
        left = iter(whole)
        return "".join(c if c == " " else next(left) for c in value)

    def secret(self, value: str) -> str:
        for alphabet in ("0123456789abcdef", "0123456789ABCDEF"):
            if all(c in alphabet for c in value):
                x = self.permuter.swap(f"hex{len(value)}", int(value, 16), 16 ** len(value))
                return format(x, f"0{len(value)}{'x' if alphabet[-1] == 'f' else 'X'}")
        return self.letters("secret", value)

    def of(self, kind: str, value: str) -> str | None:
        at = (kind, value)
        if at not in self.known:
            if len(self.known) > 200_000:  # Memory only: values are recomputed alike.
                self.known.clear()
            self.known[at] = getattr(self, kind)(value)
        return self.known[at]

    def text(self, text: str) -> tuple[str, list[str]]:
        """The text with pseudonyms, and the kind of each replaced value."""
        kinds: list[str] = []
        if not _MAYBE.search(text) and '"' not in text and "'" not in text:  # A bare secret has a digit.
            return text, kinds

        def put(kind: str, value: str) -> str:
            new = self.of(kind, value)
            if new is None:
                return value
            kinds.append(kind)
            return new

        def secret(m: re.Match) -> str:
            at = m.lastindex
            return m[0][: m.start(at) - m.start()] + put("secret", m[at]) + m[0][m.end(at) - m.start() :]

        # Secrets come first and are set aside, so that no other form is found inside one.
        done: list[str] = []
        last = 0
        for m in _SECRET.finditer(text):
            done.append(self._forms(text[last : m.start()], put))
            done.append(secret(m))
            last = m.end()
        done.append(self._forms(text[last:], put))
        return "".join(done), kinds

    def _forms(self, text: str, put: Callable[[str, str], str]) -> str:
        # No form spans lines, so lines without a digit or at-sign are not looked at.
        return "\n".join(self._line(x, put) if _MAYBE.search(x) else x for x in text.split("\n"))

    def _line(self, line: str, put: Callable[[str, str], str]) -> str:
        def one(m: re.Match) -> str:
            return put(next(k for k in _KINDS if m[k] is not None), m[0])

        out, last, at = [], 0, 0
        while m := _IBAN.search(line, at):
            value = _iban_in(line, m)
            if value is None:  # Another may begin inside of what is none.
                at = m.start() + 2
                continue
            out += [_FORMS.sub(one, line[last : m.start()]), put("iban", value)]
            last = at = m.start() + len(value)
        return "".join([*out, _FORMS.sub(one, line[last:])])


def _day_of(year: int, month: int, day: int) -> datetime.date | None:
    try:
        return datetime.date(year, month, day)
    except ValueError:
        return None


def _iban_in(line: str, m: re.Match) -> str | None:
    """The IBAN at the start of a match: of its country's length, or the longest that ends a token and checks."""
    ends = [i for i in range(m.end(), m.start() + 14, -1) if line[i - 1] != " " and not _WORD.match(line, i)]
    values = [line[m.start() : i] for i in ends]
    own = int(_IBAN_LENGTHS.get(m[0][:2], 0))
    values.sort(key=lambda v: len(v.replace(" ", "")) != own)
    return next((v for v in values if len(v.replace(" ", "")) >= 15 and _mod97_of(v) == 1), None)


_KINDS = [k for k in _FORMS.groupindex if k not in ("mark", "sep")]
_WORD = re.compile(r"\w")
_ASCII = {c: a for a in (string.digits, string.ascii_lowercase, string.ascii_uppercase) for c in a}


@functools.cache
def _alphabets() -> dict[str, str]:
    """Of each letter or digit beyond ASCII those of its kind in its block of 256; lone ones form one alphabet."""
    groups: dict[tuple, list[str]] = {}
    for c in map(chr, range(128, sys.maxunicode + 1)):
        if c.isalnum():
            groups.setdefault((ord(c) >> 8, unicodedata.category(c)), []).append(c)
    lone = "".join(g[0] for g in groups.values() if len(g) == 1)
    return {c: "".join(g) if len(g) > 1 else lone for g in groups.values() for c in g}


def _alphabet(c: str) -> str:
    return _ASCII.get(c, "") if c < "\x80" else _alphabets().get(c, "")


def _place(c: str) -> tuple[int, int]:
    alphabet = _alphabet(c)
    return (len(alphabet), alphabet.index(c)) if alphabet else (0, 0)


def _form(value: str) -> str:
    return "".join({"0": "9"}.get(a[0], a[0]) if (a := _alphabet(c)) else c for c in value)


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _mod97_of(value: str) -> int:
    plain = value.replace(" ", "")
    return _mod97(plain[4:] + plain[:4])


_FOUND = T.StructType([T.StructField("text", T.StringType()), T.StructField("kinds", T.ArrayType(T.StringType()))])


def key_of(spark: SparkSession) -> bytes:
    """The key in the session's settings; without one the trial key, with a warning."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        warnings.warn(f"{KEY_SETTING} is not set: pseudonyms of the trial key can be inverted", stacklevel=2)
    return (key or TRIAL_KEY).encode()


def with_pseudonyms(docs: DataFrame, key: bytes) -> DataFrame:
    """`docs` with its text replaced, and last a column `pseudonym_kinds`: the kind of each replaced value.

    A column of that name in `docs` gives way to it. Rows are worked on in parts of a few megabytes of text.
    """

    def part(made: Pseudonyms, texts: pa.RecordBatch) -> pa.StructArray:
        rows = [(None, []) if t is None else made.text(t) for t in texts.column("text").to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.string()))],
            names=["text", "kinds"],
        )

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        made = Pseudonyms(key)
        for batch in batches:
            whole = pa.RecordBatch.from_arrays([batch], names=["text"])
            parts = [part(made, texts) for texts in byte_slices(whole)]
            yield pa.concat_arrays(parts) if parts else part(made, whole)

    replaced = F.arrow_udf(run, _FOUND, F.ArrowUDFType.SCALAR_ITER)
    # The row as one value, so that no column of it can be taken for another.
    found = docs.select(F.struct("*").alias("row"), replaced(F.col("text")).alias("found"))
    kept = [c for c in docs.columns if c != "pseudonym_kinds"]
    columns = [F.col("found.text").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in kept]
    return found.select(*columns, F.col("found.kinds").alias("pseudonym_kinds"))
