"""Format-preserving pseudonyms for personal data by a Feistel network.

Found and validated: e-mail addresses, IBANs (mod 97), payment cards (Luhn), US social
security numbers (issuable ranges), calendar dates (1900 .. 2099, in digits or with the month's English
name), IPv4 addresses and telephone numbers (with a calling code, a trunk zero or in the
North American form; ten digits without any mark are not taken for one).  Each is read as a number below the size of its format, permuted
by a keyed Feistel network with cycle walking, and written back in the same
format: separators, padding, case, calling codes and top-level domains stay, and check
digits are computed anew, so a pseudonym validates like its original.  The
permutation depends on the key and the kind only, so equal values, also when written
with other separators, get equal pseudonyms in all documents, and different
values different ones; the key's holder can invert it (``Feistel.invert``).  A date
with slashes is read month first unless that is impossible.

Numbers that do not validate are left alone.

Scale: one pass over whole texts, no shuffle and no table of seen values; the search is linear
in the text.

Defined results: a null text stays null; overlapping finds go to the kind that comes first in
``KINDS``; rows that share a doc_id are treated each for itself; a null doc_id is kept;
an empty table gives an empty result; ``pseudonymise`` carries other columns through.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, map_batches

# --- fixed values: calling codes of one and two digits (all others have three), names of months
CALLING_CODES = {1, 7, 20, 27, 30, 31, 32, 33, 34, 36, 39, 40, 41, 43, 44, 45, 46, 47, 48, 49, 51, 52, 53, 54, 55, 56, 57,
                 58, 60, 61, 62, 63, 64, 65, 66, 81, 82, 84, 86, 90, 91, 92, 93, 94, 95, 98}
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November",
          "December"]

KINDS = ["email", "iban", "card", "ssn", "date", "ip", "phone"]
#: For tests and the registered query; a deployment passes its own.
KEY = b"pseudonym key of the registered query"
ROUNDS = 10

# The longest runs of what the patterns of numbers are made of.  No border is asked for and marks behind the
# last digit belong to it, so the patterns find in the runs what they find in the whole text.
_NUMBER = re.compile(r"[+(]?\d[\d ().:/\-]{6,}")
_EMAIL = re.compile(r"[\w%+-](?:[\w.%+-]*[\w%+-])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}")
_WORD = re.compile(r"\w")
_HOST = re.compile(r"(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d\d(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_IBAN_SIGN = re.compile(r"[A-Z]{2}\d\d ?[A-Z0-9]")
_CARD = re.compile(r"(?<![\d.])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{4,5})(?!\d)")
_SSN = re.compile(r"(?<![\d-])(\d{3})-(\d{2})-(\d{4})(?![\d-])")
_DATE = re.compile(r"(?<![\d./-])(?:(\d{4})([-/.])(\d{1,2})\2(\d{1,2})|(\d{1,2})([-/.])(\d{1,2})\6(\d{4}))(?![\d/-])(?!\.\d)")
# A version number (v1.2.3.4) is no address.
_IP = re.compile(r"(?<![\d.])(?<!\b[vV])(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})(?!\d)(?!\.\d)")
_PHONE = re.compile(r"(?<![\d(+])(?:(?:\+1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]?\d{4}|\+1[ .-]?\d{3}[ .-]?\d{3}[ .-]?\d{4}"
                    r"|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,8}(?!\d)){1,4}"
                    r"|0\d{1,4}[ -]\d{3,4}[ -]\d{3,4})(?!\d)(?![-./]\d)")
_WRITTEN = re.compile(r"(?<![\w.,/-])(?:(\d{1,2})(?:st|nd|rd|th)? ({0}),? (\d{4})|({0}) (\d{1,2})(?:st|nd|rd|th)?,? (\d{4}))(?![\w-])"
                      .replace("{0}", "|".join(f"{m}|{m[:3]}" if len(m) > 3 else m for m in MONTHS)))

#: Kinds that are looked for in runs of ``_NUMBER``, in the order of ``KINDS``.
NUMBERS = (("card", _CARD), ("ssn", _SSN), ("date", _DATE), ("ip", _IP), ("phone", _PHONE))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of what ``_EMAIL`` finds, looked for around each @: the characters before one are read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and (text[start - 1] in ".%+-" or _WORD.match(text[start - 1])):
            start -= 1
        while start < at and text[start] == ".":
            start += 1
        m = _HOST.match(text, at + 1) if start < at and text[at - 1] != "." else None
        if m is not None:
            yield start, m.end()
        # No later match can begin before what was read.
        done = m.end() if m is not None else at + 1
        at = text.find("@", done)


class Feistel:
    """A keyed permutation of 0 .. size-1 for any size: an alternating Feistel network
    over two residues whose product is the least that covers the size, with cycle walking."""

    def __init__(self, key: bytes, tag: str, size: int, rounds: int = ROUNDS):
        self.size = size
        self.a = math.isqrt(max(size - 1, 0)) + 1
        self.b = -(-size // self.a)
        self.rounds = rounds
        self._seed = hashlib.sha256(key).digest() + hashlib.sha256(f"{tag}/{size}".encode()).digest()
        self._bytes = (max(self.a, self.b).bit_length() + 7) // 8 + 8

    def _f(self, i: int, x: int) -> int:
        data = self._seed + bytes([i]) + x.to_bytes(self._bytes, "big")
        return int.from_bytes(hashlib.shake_256(data).digest(self._bytes), "big")

    def _once(self, v: int) -> int:
        left, right = v // self.b, v % self.b
        for i in range(self.rounds):
            if i % 2:
                right = (right + self._f(i, left)) % self.b
            else:
                left = (left + self._f(i, right)) % self.a
        return left * self.b + right

    def _back(self, v: int) -> int:
        left, right = v // self.b, v % self.b
        for i in reversed(range(self.rounds)):
            if i % 2:
                right = (right - self._f(i, left)) % self.b
            else:
                left = (left - self._f(i, right)) % self.a
        return left * self.b + right

    def apply(self, v: int) -> int:
        v = self._once(v)
        while v >= self.size:
            v = self._once(v)
        return v

    def invert(self, v: int) -> int:
        v = self._back(v)
        while v >= self.size:
            v = self._back(v)
        return v


def luhn_digit(digits: str) -> str:
    """The digit that makes ``digits`` + it pass the Luhn test."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _fill(shape: str, letters: str) -> str:
    """``shape`` with its digits and letters replaced in order."""
    rest = iter(letters)
    return "".join(next(rest) if c.isalnum() else c for c in shape)


_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2099, 12, 31).toordinal() - _FIRST_DAY + 1


class Pseudonyms:
    """Finds personal data and gives each value its pseudonym."""

    def __init__(self, key: bytes = KEY, direction: str = "apply"):
        self._key, self._direction = key, direction
        self._networks = lru_cache(4096)(lambda tag, size: Feistel(key, tag, size))

    def _permute(self, tag: str, v: int, size: int) -> int:
        return getattr(self._networks(tag, size), self._direction)(v)

    def _characters(self, tag: str, text: str) -> str:
        """Letters a-z and digits permuted within their kinds, all at once; others stay."""
        radix = [26 if "a" <= c <= "z" else 10 if "0" <= c <= "9" else 1 for c in text]
        v, size = 0, 1
        for c, r in zip(text, radix):
            v = v * r + (ord(c) - (97 if r == 26 else 48) if r > 1 else 0)
            size *= r
        if size == 1:
            return text
        shape = "".join("a" if r == 26 else "0" if r == 10 else c for c, r in zip(text, radix))
        v, out = self._permute(f"{tag}:{shape}", v, size), []
        for c, r in zip(reversed(text), reversed(radix)):
            v, d = divmod(v, r)
            out.append(chr(d + (97 if r == 26 else 48)) if r > 1 else c)
        return "".join(reversed(out))

    def email(self, text: str) -> str | None:
        low = "".join(c.lower() if c.isascii() else c for c in text)
        head, _, top = low.rpartition(".")
        new = self._characters("email", head) + "." + top
        return "".join(n.upper() if c.isascii() and c.isupper() else n for c, n in zip(text, new))

    def iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or _mod97(plain) != 1:
            return None
        body = self._characters(f"iban:{plain[:2]}", plain[4:].lower()).upper()
        check = 98 - _mod97(plain[:2] + "00" + body)
        return _fill(text, f"{plain[:2]}{check:02d}{body}")

    def card(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if luhn_digit(digits[:-1]) != digits[-1] or not digits.strip("0"):
            return None
        n = len(digits) - 1
        new = f"{self._permute(f'card:{n}', int(digits[:-1]), 10 ** n):0{n}d}"
        return _fill(text, new + luhn_digit(new))

    def ssn(self, text: str) -> str | None:
        area, group, serial = map(int, text.split("-"))
        if area in (0, 666) or area > 899 or not group or not serial:
            return None
        v = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        v, serial = divmod(self._permute("ssn", v, 898 * 99 * 9999), 9999)
        area, group = divmod(v, 99)
        return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def date(self, text: str) -> str | None:
        m = _DATE.fullmatch(text)
        if m is None:
            return None
        if m[1]:
            parts, order, mark = (m[1], m[3], m[4]), "ymd", m[2]
        else:
            parts, mark = (m[5], m[7], m[8]), m[6]
            order = "mdy" if mark == "/" and int(m[5]) <= 12 else "dmy"
        try:
            day = datetime.date(*(int(parts[order.index(k)]) for k in "ymd")).toordinal() - _FIRST_DAY
        except ValueError:
            return None
        if not 0 <= day < _DAYS:
            return None
        new = datetime.date.fromordinal(self._permute("date", day, _DAYS) + _FIRST_DAY)
        # A part of one digit stays unpadded where the text writes parts so.
        loose = any(len(p) == 1 for p in parts)
        value = {"y": f"{new.year:04d}", "m": str(new.month) if loose else f"{new.month:02d}",
                 "d": str(new.day) if loose else f"{new.day:02d}"}
        return mark.join(value[k] for k in order)

    def ip(self, text: str) -> str | None:
        octets = [int(x) for x in text.split(".")]
        if max(octets) > 255:
            return None
        return ".".join(map(str, self._permute("ip", int.from_bytes(bytes(octets), "big"), 1 << 32).to_bytes(4, "big")))

    def written(self, text: str) -> str | None:
        """A date with the month's name; the new one has a name of the same form, and no ordinal ending
        that would not fit."""
        m = _WRITTEN.fullmatch(text)
        day, name, year = (m[1], m[2], m[3]) if m[1] else (m[5], m[4], m[6])
        month = next(k for k, x in enumerate(MONTHS) if x[:3] == name[:3]) + 1
        try:
            number = datetime.date(int(year), month, int(day)).toordinal() - _FIRST_DAY
        except ValueError:
            return None
        if not 0 <= number < _DAYS:
            return None
        new = datetime.date.fromordinal(self._permute("date", number, _DAYS) + _FIRST_DAY)
        named = MONTHS[new.month - 1][:3] if len(name) == 3 and name != "May" else MONTHS[new.month - 1]
        digits = f"{new.day:02d}" if len(day) == 2 and day[0] == "0" else str(new.day)
        if re.search(r"\d(?:st|nd|rd|th)", text):
            digits += "th" if 10 <= new.day % 100 <= 20 else {1: "st", 2: "nd", 3: "rd"}.get(new.day % 10, "th")
        comma = "," if "," in text else ""
        return f"{digits} {named}{comma} {new.year:04d}" if m[1] else f"{named} {digits}{comma} {new.year:04d}"

    def phone(self, text: str) -> str | None:
        """A telephone number as calling code and national number; the national number is permuted, so
        a number has one pseudonym with and without its code, trunk zero and marks."""
        digits = re.sub(r"\D", "", text)
        if text[0] == "+":
            if digits[0] == "0":
                return None
            lead = next((n for n in (1, 2) if int(digits[:n]) in CALLING_CODES), 3)
        else:
            lead = int(digits[0] == "0")  # the trunk zero
        national = digits[lead:]
        n = len(national)
        if not (7 if text[0] == "+" else 9) <= n <= 15 - lead:
            return None
        return _fill(text, digits[:lead] + f"{self._permute(f'phone:{n}', int(national), 10 ** n):0{n}d}")

    def find(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, kind, pseudonym) in the order of the text."""
        got: list[tuple[int, int, str, str]] = []

        def take(kind: str, pattern: re.Pattern, at: int, end: int, taken: list, method: str = "") -> list:
            """Finds in the parts of text[at:end] that no earlier kind has ``taken``."""
            new = []
            for b, after in [*((a, b) for a, b, _, _ in taken if b > at and a < end), (end, end)]:
                for m in pattern.finditer(text, at, max(at, b)):
                    value = getattr(self, method or kind)(m[0])
                    if value is not None:
                        new.append((m.start(), m.end(), kind, value))
                at = max(at, after)
            return new

        if "@" in text:
            got = [(a, b, "email", self.email(text[a:b])) for a, b in emails(text)]
        if _IBAN_SIGN.search(text):
            got = sorted(got + take("iban", _IBAN, 0, len(text), got))
        if any(m[:3] in text for m in MONTHS):
            got = sorted(got + take("date", _WRITTEN, 0, len(text), got, "written"))
        # The finds so far and the runs of numbers are in order: each run meets those that touch it.
        first, more = 0, []
        for run in _NUMBER.finditer(text):
            a, b = run.span()
            while first < len(got) and got[first][1] <= a:
                first += 1
            last = first
            while last < len(got) and got[last][0] < b:
                last += 1
            here = got[first:last]
            for kind, pattern in NUMBERS:
                new = take(kind, pattern, a, b, here)
                if new:
                    here = sorted(here + new)
                    more += new
        return sorted(got + more)

    def replace(self, text: str) -> tuple[str, list[tuple[int, int, str, str]]]:
        found = self.find(text)
        out, at = [], 0
        for a, b, _, new in found:
            out += [text[at:a], new]
            at = b
        return "".join([*out, text[at:]]), found


def pseudonymise(docs: DataFrame, key: bytes = KEY, text_col: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in ``text_col``, and a count ``n_<kind>`` of each kind."""
    bounded_batches(docs.sparkSession)
    counts = [f"n_{k}" for k in KINDS]
    docs = docs.select([c for c in docs.columns if c not in counts])
    names, at = docs.columns, docs.columns.index(text_col)
    held: list[Pseudonyms] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(Pseudonyms(key))
        texts, kinds = [], []
        for text in batch.column(at).to_pylist():
            new, found = held[0].replace(text) if text else (text, [])
            texts.append(new)
            kinds.append([k for _, _, k, _ in found])
        columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
        return pa.record_batch([*columns, *(pa.array([x.count(k) for x in kinds], pa.int64()) for k in KINDS)],
                               names=[*names, *counts])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields),
                        *(f"{c} long" for c in counts)])
    return map_batches(docs, run, schema)


def pseudonyms_of(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """doc_id, text and the counts of every document."""
    return pseudonymise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), key)
