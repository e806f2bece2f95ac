"""Format-preserving pseudonyms for personal data by a keyed Feistel permutation.

Values are found by format and validated: payment cards (Luhn), IBANs (mod 97), calendar
dates, IPv4 addresses, telephone and social-security numbers (group rules), e-mail
local parts, credentials in quotes after a naming word. Each is mapped to a number within its
format's range, permuted by a balanced Feistel network keyed with ``key`` (with cycle
walking where the range is no product of the halves), and written back in the same
format: separators, lengths and check digits hold, so a valid card becomes another
valid card. The permutation depends on key, kind and value alone, so equal values stay
linked across documents, and whoever has the key can invert it.

Text outside the values is untouched; a number that fails its validation stays, and so do dates with two-digit
years or month names, credentials without quotes, IPv6 addresses and e-mail names before a domain with letters
other than a-z. Of two values that overlap the one that starts first is replaced. Null stays null, an empty text empty, any
length is read whole, values of any length are replaced whole; repeated rows give equal rows; an empty table gives
no rows; other columns pass through.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from functools import lru_cache
from math import isqrt, prod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewell.llm.common import append_columns, fresh

ROUNDS = 10
KEY = b"replace with a secret of your own"  # a parameter of every function below

# Fixed formats.
_RUN = re.compile(r"[+(]?[0-9](?:[0-9 ().\-/]*[0-9])?")
_NUMBER = re.compile(
    r"(?P<ipv4>(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])(?!\.[0-9]))"
    r"|(?P<iso>(?<![0-9])[0-9]{4}(?P<s1>[-/.])[0-9]{1,2}(?P=s1)[0-9]{1,2}(?![0-9]))"
    r"|(?P<dmy>(?<![0-9])[0-9]{1,2}(?P<s2>[-/.])[0-9]{1,2}(?P=s2)[0-9]{4}(?![0-9]))"
    r"|(?P<ssn>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))"
    r"|(?P<phone>\+[0-9]{1,3} ?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
    r"|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])"
    r"|(?<![0-9])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
    r"|(?<![0-9.-])[0-9]{3}(?P<s3>[ .-])[0-9]{3}(?P=s3)[0-9]{4}(?![0-9]))"
    r"|(?P<card>(?<![0-9])(?:[0-9]{4}(?P<s4>[ -])[0-9]{4}(?P=s4)[0-9]{4}(?P=s4)[0-9]{1,4}(?:(?P=s4)[0-9]{1,3})?"
    r"|[0-9]{4}(?P<s5>[ -])[0-9]{6}(?P=s5)[0-9]{5}|[0-9]{13,19})(?![0-9]))")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_LOCAL = re.compile(r"[\w.+%-]*[\w+%-]$")
_LOCAL_PART = re.compile(r"[\w.+%-]")
_DOMAIN = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.)+[A-Za-z]{2,24}")
_SECRET = re.compile(r"(?i)\b(?:token|secret|passw(?:or)?d|api[_-]?key)[ \t]{0,4}[=:][ \t]{0,4}([\"'])([A-Za-z0-9+/_=.-]{8,})\1")
_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_ACCENT = "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ"
_CLASS = {c: a for a in (_LOWER, _UPPER, _DIGIT, _ACCENT) for c in a}
# Days of the years 1800 to 2199 are permuted among themselves, and so are all others.
_DAY0, _DAYS = datetime.date(1800, 1, 1).toordinal(), datetime.date(2200, 1, 1).toordinal() - datetime.date(1800, 1, 1).toordinal()
_OTHER_DAYS = datetime.date.max.toordinal() - _DAYS

FOUND = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_found", T.LongType()),
                      T.StructField("kinds", T.MapType(T.StringType(), T.LongType())),
                      T.StructField("spans", T.ArrayType(T.IntegerType()))])


class Feistel:
    """Keyed permutations of range(n), one family per kind of value."""

    def __init__(self, key: bytes, rounds: int = ROUNDS):
        self.key, self.rounds = hashlib.blake2b(key, digest_size=32).digest(), rounds

    def _noise(self, kind: str, n: int, turn: int, half: int, modulus: int) -> int:
        size = (modulus.bit_length() + 7) // 8 + 8
        out = b""
        while len(out) < size:
            note = f"{kind}/{n}/{turn}/{half}/{len(out)}".encode()
            out += hashlib.blake2b(note, key=self.key).digest()
        return int.from_bytes(out[:size], "big") % modulus

    def permute(self, kind: str, n: int, value: int, inverse: bool = False) -> int:
        """The image of ``value`` in range(n)."""
        if n < 2:
            return value
        a = isqrt(n - 1) + 1
        while True:
            left, right = divmod(value, a)
            for turn in (reversed(range(self.rounds)) if inverse else range(self.rounds)):
                if turn % 2:
                    left = (left + (-1 if inverse else 1) * self._noise(kind, n, turn, right, a)) % a
                else:
                    right = (right + (-1 if inverse else 1) * self._noise(kind, n, turn, left, a)) % a
            value = left * a + right
            if value < n:  # else walk the cycle on
                return value


def luhn_digit(digits: str) -> str:
    """The check digit that follows ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


class Pseudonyms:
    """Text to text with pseudonyms, for one key."""

    def __init__(self, key: bytes = KEY, inverse: bool = False):
        self.net, self.inverse = Feistel(key), inverse
        self.value = lru_cache(maxsize=50_000)(self._value)

    def _turn(self, kind: str, n: int, v: int) -> int:
        return self.net.permute(kind, n, v, self.inverse)

    def _digits(self, kind: str, digits: str) -> str:
        return f"{self._turn(f'{kind}{len(digits)}', 10 ** len(digits), int(digits)):0{len(digits)}d}"

    def _symbols(self, kind: str, text: str) -> str:
        """Every letter or digit by another of its class, as one mixed-radix number."""
        sets = [_CLASS.get(c, c) for c in text]
        value = 0
        for c, s in zip(text, sets, strict=True):
            value = value * len(s) + s.index(c)
        shape = "".join(s[0] for s in sets)
        value = self._turn(f"{kind}{shape}", prod(map(len, sets)), value)
        out = []
        for s in reversed(sets):
            value, i = divmod(value, len(s))
            out.append(s[i])
        return "".join(reversed(out))

    def _day(self, kind: str, day: datetime.date, fits) -> datetime.date | None:
        v = day.toordinal() - _DAY0
        near = 0 <= v < _DAYS
        if not near:
            v = day.toordinal() - 1 if v < 0 else day.toordinal() - 1 - _DAYS
        while True:
            v = self._turn(kind if near else f"{kind} far", _DAYS if near else _OTHER_DAYS, v)
            new = datetime.date.fromordinal(_DAY0 + v if near else v + 1 if v + 1 < _DAY0 else v + 1 + _DAYS)
            if fits(new):
                return new

    def _value(self, kind: str, text: str) -> str | None:
        """The pseudonym of a value, or None if it isn't valid."""
        digits = "".join(c for c in text if c in _DIGIT)
        if kind == "card":
            if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1]:
                return None
            new = self._digits(kind, digits[:-1])
            return _refill(text, new + luhn_digit(new))
        if kind == "ipv4":
            parts = [int(x) for x in text.split(".")]
            if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
                return None
            v = self._turn(kind, 1 << 32, int.from_bytes(bytes(parts), "big"))
            return ".".join(str(b) for b in v.to_bytes(4, "big"))
        if kind in ("iso", "dmy"):
            parts = re.split("[-/.]", text)
            sizes = [len(x) for x in parts]
            padded = any(x[0] == "0" for x in parts if len(x) == 2)
            month_first = kind == "dmy" and int(parts[0]) <= 12
            places = (0, 1, 2) if kind == "iso" else (2, 0, 1) if month_first else (2, 1, 0)  # of year, month, day
            try:
                day = datetime.date(*(int(parts[i]) for i in places))
            except ValueError:
                return None

            def written(d: datetime.date) -> list[str] | None:
                """The date's parts in the same form: a part of one digit stays one, of two digits two; beside a part
                of one digit a leading zero stays one."""
                out = ["", "", ""]
                for i, x in zip(places, (d.year, d.month, d.day), strict=True):
                    out[i] = f"{x:0{sizes[i]}d}"
                same = [len(x) for x in out] == sizes and (kind == "iso" or month_first or d.day > 12)
                mixed = min(sizes) == 1 and padded != any(out[i][0] == "0" for i in places[1:])
                return out if same and not mixed else None

            if written(day) != parts:
                return None
            new = written(self._day("date", day, written))
            return _refill(text, "".join(new))
        if kind == "ssn":
            area, group, serial = digits[:3], digits[3:5], digits[5:]
            if area in ("000", "666") or area >= "900" or group == "00" or serial == "0000":
                return None
            a = int(area) - 1 - (int(area) > 666)
            v = self._turn(kind, 898 * 99 * 9999, (a * 99 + int(group) - 1) * 9999 + int(serial) - 1)
            v, serial = divmod(v, 9999)
            a, group = divmod(v, 99)
            return _refill(text, f"{a + 1 + (a >= 665):03d}{group + 1:02d}{serial + 1:04d}")
        if kind == "phone":
            lead = re.match(r"\+([0-9]{1,3})(?![0-9])", text)
            lead = len(lead[1]) if lead else (1 if text[0] == "+" else 0)
            if not 7 <= len(digits) <= 15:
                return None
            return _refill(text, digits[:lead] + self._digits(kind, digits[lead:]))
        if kind == "iban":
            flat = text.replace(" ", "")
            if not 15 <= len(flat) <= 34 or _mod97(flat[4:] + flat[:4]) != 1:
                return None
            body = self._symbols(kind + flat[:2], flat[4:])
            full = f"{flat[:2]}{98 - _mod97(body + flat[:2] + '00'):02d}{body}"
            chars = iter(full)
            return "".join(c if c == " " else next(chars) for c in text)
        return self._symbols(kind, text)  # email, secret

    def spans(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, kind, pseudonym) of the valid values of a text, in order, apart."""
        found = []
        at = text.find("@")
        while at >= 0:
            start = max(0, at - 64)
            while start > 0 and _LOCAL_PART.match(text, start):
                start -= 1  # a longer one; texts between two @ are searched once
            near = _LOCAL.search(text[start:at])
            if near and near[0][0] != "." and _DOMAIN.match(text, at + 1):
                found.append((at - len(near[0]), at, "email", near[0]))
            at = text.find("@", at + 1)
        if re.search(r"(?i)token|secret|passw|api", text):
            found += [(m.start(2), m.end(2), "secret", m[2]) for m in _SECRET.finditer(text)]
        found += [(m.start(), m.end(), "iban", m[0]) for m in _IBAN.finditer(text)]
        for run in _RUN.finditer(text):
            if run.end() - run.start() >= 7:
                found += self._numbers(text, run.start(), run.end())
        out: list[tuple[int, int, str, str]] = []
        for start, end, kind, value in sorted(found, key=lambda f: (f[0], -f[1])):
            if out and start < out[-1][1]:
                continue
            new = self.value(kind, value)
            if new is not None:
                out.append((start, end, kind, new))
        return out

    def _numbers(self, text: str, at: int, end: int):
        """The valid values in a run of digits and separators. A match that isn't valid is tried
        without its last groups, then the search goes on after its first group."""
        while m := _NUMBER.search(text, at, end):
            start, stop, valid = m.start(), m.end(), None
            while stop - start >= 7:
                valid = _NUMBER.match(text, start, stop)
                if valid and self.value(_kind(valid), valid[0]) is not None:
                    break
                valid = None
                while stop > start and text[stop - 1] in _DIGIT:
                    stop -= 1
                while stop > start and text[stop - 1] not in _DIGIT:
                    stop -= 1
            if valid:
                yield start, valid.end(), _kind(valid), valid[0]
                at = valid.end()
            else:
                at = re.compile(r"[^0-9]*[0-9]+").match(text, start, end).end()

    def apply(self, text: str) -> tuple[str, list[tuple[int, int, str, str]]]:
        spans = self.spans(text)
        out, at = [], 0
        for start, end, _, new in spans:
            out += [text[at:start], new]
            at = end
        return "".join([*out, text[at:]]), spans


def _kind(m: re.Match) -> str:
    return next(k for k in ("ipv4", "iso", "dmy", "ssn", "phone", "card") if m[k] is not None)


def _refill(form: str, digits: str) -> str:
    """``form`` with its digits replaced one by one."""
    new = iter(digits)
    return "".join(next(new) if c in _DIGIT else c for c in form)


def _replace(docs: DataFrame, name: str, key: bytes, text: str = "text") -> DataFrame:
    def make():
        names = Pseudonyms(key)

        def fn(column):
            got = [(None, []) if t is None else names.apply(t) for t in column.to_pylist()]
            kinds = []
            for _, spans in got:
                count: dict[str, int] = {}
                for _, _, kind, _ in spans:
                    count[kind] = count.get(kind, 0) + 1
                kinds.append(sorted(count.items()))
            return {"text": [t for t, _ in got], "n_found": [len(s) for _, s in got], "kinds": kinds,
                    "spans": [[x for s in spans for x in s[:2]] for _, spans in got]}
        return fn

    return append_columns(docs, text, FOUND, name, make)


def pseudonymise(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text with pseudonyms, n_found, kinds (count of
    each kind), spans (start, end, ... of the values in the original text)."""
    got = fresh("found")
    return _replace(docs.select("doc_id", "text"), got, key).select("doc_id", f"{got}.*")


def with_pseudonyms(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` (and ``n_chars``, where present, of the new text)."""
    got = fresh("found")
    new = {"text": F.col(got)["text"].alias("text"), "n_chars": F.length(F.col(got)["text"]).cast("long").alias("n_chars")}
    return _replace(docs, got, key).select(*(new.get(c, F.col(c)) for c in docs.columns))
