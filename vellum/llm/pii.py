"""PII: format-preserving Feistel pseudonyms of validated numbers and dates.

Values are found in whole texts, validated, ranked into a contiguous range of
integers (their format's domain), permuted there under a secret key, and
written back in the same format with the same separators, so that a card stays
a card of its brand with a right check digit, a date a date, an address an
address. The permutation depends on the key and the kind only: equal values
get equal pseudonyms in every document, whatever their separators or case,
and different values different ones. It is the conjugate of a one-step
rotation by a Feistel network, hence a single cycle: no value keeps its own
text (in a domain of more than one), and ``restore`` undoes it with the key.

Kinds: payment cards (brand prefix, Luhn), IBANs (mod 97), US social security
numbers, phone numbers (+1 and other international ones), IPv4 and IPv6 addresses, calendar
dates (1900 to 2099; ISO, numeric, English month names with or without ordinals; one domain for all
notations), the local parts of e-mail addresses, and long
hexadecimal secrets behind token, key, secret or password. Numbers that fail
their validation are left alone, and so are bare ones whose neighbouring words make them
a version or an amount.

Numbers with the month first can only tell dates whose day is after the 12th. Where
such a date's pseudonym is another one, it is written year first with the
month's name between the same separators (``2021/Mar/05``), a notation that is read
back as the month-first one; so a date has one pseudonym in every notation.
Notations of one value that differ in more than separators and case (leading zeros, an IPv6
address not in its short form) come back from ``restore`` in the usual one.

Defined results: a NULL text stays NULL and has no values; an empty text has
none; repeated rows are treated alike; an empty table gives no rows; all
columns are kept, whatever their names (an older column of the name asked for
the spans is replaced); texts of any length are scanned whole.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import ipaddress
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.common import prepare, table

ROUNDS = 8
_LETTERS, _DIGITS, _HEX = "abcdefghijklmnopqrstuvwxyz", "0123456789", "0123456789abcdef"
#: A key for tests and for the registered query; real use passes its own.
DEMO_KEY = b"demonstration key, not a secret"

FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2099, 12, 31).toordinal() - FIRST_DAY + 1
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")


class Feistel:
    """A keyed permutation of 0..n-1 for any n: alternating modular rounds on two halves, walked back into range."""

    def __init__(self, key: bytes, kind: str, n: int):
        self.key, self.kind, self.n = hashlib.blake2b(key, digest_size=32).digest(), kind.encode(), n
        self.a = math.isqrt(n - 1) + 1 if n > 1 else 1
        self.b = -(-n // self.a)

    def _round(self, number: int, half: int) -> int:
        data = b"%b|%d|%d|%d" % (self.kind, self.n, number, half)
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=64).digest(), "big")

    def forward(self, x: int) -> int:
        while True:
            left, right = divmod(x, self.b)
            for r in range(0, ROUNDS, 2):
                left = (left + self._round(r, right)) % self.a
                right = (right + self._round(r + 1, left)) % self.b
            x = left * self.b + right
            if x < self.n:
                return x

    def backward(self, x: int) -> int:
        while True:
            left, right = divmod(x, self.b)
            for r in range(ROUNDS - 2, -1, -2):
                right = (right - self._round(r + 1, left)) % self.b
                left = (left - self._round(r, right)) % self.a
            x = left * self.b + right
            if x < self.n:
                return x

    def pseudonym(self, x: int, step: int = 1) -> int:
        """One step along the single cycle that the keyed order forms; ``step=-1`` goes back."""
        return self.backward((self.forward(x) + step) % self.n)


# --- formats: each gives (domain name, size, rank, writer) or None ----------------

#: Long values are a list of these, part after part.
Format = tuple[str, int, int, Callable[[int], str]]


def _into(template: str, characters: str) -> str:
    """The template with its digits replaced in order."""
    it = iter(characters)
    return "".join(next(it) if c.isdigit() else c for c in template)


def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


#: Brand prefixes and lengths of payment cards (fixed values).
CARD_BRANDS = (
    (r"4", (13, 16, 19)),
    (r"5[1-5]", (16,)),
    (r"2(?:22[1-9]|2[3-9]\d|[3-6]\d\d|7[01]\d|720)", (16,)),
    (r"3[47]", (15,)),
    (r"3(?:0[0-5]|[689])", (14,)),
    (r"6(?:011|5|4[4-9])", (16, 19)),
    (r"35(?:2[89]|[3-8]\d)", (16,)),
)


def card(text: str) -> Format | None:
    digits = re.sub(r"\D", "", text)
    for prefix, lengths in CARD_BRANDS:
        m = re.match(prefix, digits)
        if m and len(digits) in lengths and luhn_digit(digits[:-1]) == digits[-1]:
            head, width = m[0], len(digits) - m.end() - 1

            def write(x: int) -> str:
                body = f"{head}{x:0{width}d}"
                return _into(text, body + luhn_digit(body))

            return f"card {head} {len(digits)}", 10**width, int(digits[m.end() : -1]), write
    return None


def ssn(text: str) -> Format | None:
    area, group, serial = (int(x) for x in re.split(r"\D", text))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    rank = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1

    def write(x: int) -> str:
        x, s = divmod(x, 9999)
        a, g = divmod(x, 99)
        a += 1 + (a >= 665)
        return _into(text, f"{a:03d}{g + 1:02d}{s + 1:04d}")

    return "ssn", 898 * 99 * 9999, rank, write


def phone(text: str) -> Format | None:
    digits = re.sub(r"\D", "", text)
    if text.startswith("+") and digits[0] != "1":
        if not 8 <= len(digits) <= 15:
            return None
        head, width = digits[:2], len(digits) - 2
        return f"phone {head} {len(digits)}", 10**width, int(digits[2:]), lambda x: _into(text, f"{head}{x:0{width}d}")
    head, own = digits[:-10], digits[-10:]
    if len(own) != 10 or head not in ("", "1"):
        return None
    if own[0] in "01" or own[3] in "01":
        # Not a number of the plan, but marked as one by its country code: permuted among such numbers.
        if not text.startswith("+"):
            return None
        starts = 2 * 10**9  # those whose area starts with 0 or 1; then those whose exchange does
        rank = int(own) if own[0] in "01" else starts + ((int(own[:3]) - 200) * 200 + int(own[3:6])) * 10_000 + int(own[6:])

        def spell(x: int) -> str:
            if x < starts:
                return _into(text, f"{head}{x:010d}")
            y, line = divmod(x - starts, 10_000)
            area, exchange = divmod(y, 200)
            return _into(text, f"{head}{area + 200}{exchange:03d}{line:04d}")

        return "phone unassigned", starts + 800 * 200 * 10_000, rank, spell
    rank = ((int(own[:3]) - 200) * 800 + int(own[3:6]) - 200) * 10_000 + int(own[6:])

    def write(x: int) -> str:
        x, line = divmod(x, 10_000)
        area, exchange = divmod(x, 800)
        return _into(text, f"{head}{area + 200}{exchange + 200}{line:04d}")

    return "phone 1", 800 * 800 * 10_000, rank, write


def ipv4(text: str) -> Format | None:
    parts = [int(x) for x in text.split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
        return None
    rank = int.from_bytes(bytes(parts), "big")
    return "ipv4", 1 << 32, rank, lambda x: ".".join(map(str, x.to_bytes(4, "big")))


def ipv6(text: str) -> Format | None:
    try:
        address = ipaddress.IPv6Address(text)
    except ValueError:
        return None
    groups = text.split(":")
    if not any(c in text for c in _DIGITS) or text.count(":") < 2 or not all(len(g) <= 4 for g in groups):
        return None
    whole = len(groups) == 8 and all(len(g) == 4 for g in groups)
    upper = text.upper() == text and text.lower() != text

    def write(x: int) -> str:
        new = ipaddress.IPv6Address(x)
        out = new.exploded if whole else new.compressed
        return out.upper() if upper else out

    return "ipv6", 1 << 128, int(address), write


def _date(year: int, month: int, day: int, write: Callable[[datetime.date], str]) -> Format | None:
    try:
        rank = datetime.date(year, month, day).toordinal() - FIRST_DAY
    except ValueError:
        return None
    if not 0 <= rank < DAYS:
        return None
    return "date", DAYS, rank, lambda x: write(datetime.date.fromordinal(x + FIRST_DAY))


def iso_date(text: str) -> Format | None:
    sep = text[4]
    y, m, d = text.split(sep)
    pad = _padding(m, d)
    return _date(int(y), int(m), int(d), lambda t: f"{t.year}{sep}{t.month:0{pad}d}{sep}{t.day:0{pad}d}")


def _padding(*numbers: str) -> int:
    return 2 if all(len(n) == 2 for n in numbers) else 1


def _month_first(t: datetime.date, sep: str, pad: int) -> str:
    """Month first where the day tells it; else the year first and the month's name, in lower case for numbers without zeros."""
    if t.day > 12:
        return f"{t.month:0{pad}d}{sep}{t.day}{sep}{t.year}"
    name = MONTHS[t.month - 1][:3]
    return f"{t.year}{sep}{name if pad == 2 else name.lower()}{sep}{t.day:0{pad}d}"


def numeric_date(text: str) -> Format | None:
    """Day first; month first only where day first is no date, that is for days after the 12th."""
    sep = re.search(r"\D", text)[0]
    a, b, y = text.split(sep)
    pad = _padding(a, b)
    day_first = _date(int(y), int(b), int(a), lambda t: f"{t.day:0{pad}d}{sep}{t.month:0{pad}d}{sep}{t.year}")
    return day_first or _date(int(y), int(a), int(b), lambda t: _month_first(t, sep, pad))


def month_between(text: str) -> Format | None:
    """The other spelling of a month-first date: only days up to the 12th have it."""
    sep = text[4]
    y, name, d = text.split(sep)
    month = next((i for i, m in enumerate(MONTHS, 1) if m[:3] == name.capitalize()), 0)
    if not month or int(d) > 12 or not (name.islower() or name.istitle()):
        return None
    return _date(int(y), month, int(d), lambda t: _month_first(t, sep, 1 if name.islower() else 2))


def _ordinal(day: int) -> str:
    return "th" if 11 <= day <= 13 else {1: "st", 2: "nd", 3: "rd"}.get(day % 10, "th")


def named_date(text: str) -> Format | None:
    # Not the letters of an ordinal, nor "of".
    word = re.search(r"(?<!\d)[A-Za-z]{3,}", text)[0]
    month = next((i for i, m in enumerate(MONTHS, 1) if m.lower().startswith(word.lower()) and len(word) in (3, len(m))), 0)
    numbers = [int(x) for x in re.findall(r"\d+", text)]
    if not month or len(numbers) != 2:
        return None

    def write(t: datetime.date) -> str:
        name = MONTHS[t.month - 1]
        name = name[:3] if len(word) == 3 and MONTHS[month - 1] != word.capitalize() else name
        name = name.upper() if word.isupper() else name.lower() if word.islower() else name
        out = text[: text.index(word)] + "\0" + text[text.index(word) + len(word) :]
        values = iter((t.day, t.year))

        def number(m: re.Match) -> str:
            ending = _ordinal(t.day) if m[2] else ""
            return f"{next(values)}{ending.upper() if m[2] and m[2].isupper() else ending}"

        return re.sub(r"(\d+)(st|nd|rd|th)?", number, out, flags=re.I).replace("\0", name)

    return _date(numbers[1], month, numbers[0], write)


def _mixed(text: str, alphabets: list[str]) -> tuple[int, int, Callable[[int], str]]:
    """(size, rank, writer) of a string whose i-th free character comes from ``alphabets[i]`` (empty: fixed)."""
    size, rank = 1, 0
    for c, a in zip(text, alphabets, strict=True):
        if a:
            size, rank = size * len(a), rank * len(a) + a.index(c)

    def write(x: int) -> str:
        out = []
        for c, a in zip(reversed(text), reversed(alphabets), strict=True):
            if a:
                x, at = divmod(x, len(a))
                c = a[at]
            out.append(c)
        return "".join(reversed(out))

    return size, rank, write




#: Longer texts are permuted in parts of so many characters, each in a domain of its place.
_PART = 128


def _in_parts(name: str, text: str, alphabets: list[str], spelt: Callable[[str, int], str], rest: str = "") -> list[Format]:
    """A permutation of the text's free characters a part at a time; ``rest`` follows the last part."""
    out = []
    if len(text) > _PART:
        name = hashlib.blake2b(name.encode(), digest_size=16).hexdigest()
    for at in range(0, len(text), _PART):
        size, rank, write = _mixed(text[at : at + _PART], alphabets[at : at + _PART])
        place = "" if len(text) <= _PART else f" {at}"
        tail = rest if at + _PART >= len(text) else ""
        out.append((f"{name}{place}", size, rank, lambda x, w=write, at=at, tail=tail: spelt(w(x), at) + tail))
    return out


def email(text: str) -> list[Format] | None:
    local, _, domain = text.rpartition("@")
    low = local.lower() if len(local.lower()) == len(local) else local
    alphabets = [_LETTERS if c in _LETTERS else _DIGITS if c in _DIGITS else "" for c in low]
    if not any(alphabets):
        return None
    shape = "".join("a" if a == _LETTERS else "9" if a else c for a, c in zip(alphabets, low, strict=True))
    cased = lambda s, at: "".join(c.upper() if o.isupper() else c for c, o in zip(s, local[at:], strict=False))
    return _in_parts(f"email {shape}@{domain.lower()}", low, alphabets, cased, f"@{domain}")


def secret(text: str) -> list[Format]:
    low = text.lower()
    return _in_parts(f"hex {len(low)}", low, [_HEX] * len(low), lambda s, _: s.upper() if text != low else s)


def _mod97(rearranged: str) -> int:
    return int("".join(str(int(c, 36)) for c in rearranged)) % 97


def iban(text: str) -> Format | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _mod97(plain[4:] + plain[:4]) != 1:
        return None
    country, body = plain[:2], plain[4:].lower()
    alphabets = [_LETTERS if c in _LETTERS else _DIGITS for c in body]
    size, rank, write = _mixed(body, alphabets)
    shape = "".join("a" if a == _LETTERS else "9" for a in alphabets)

    def spell(x: int) -> str:
        new = write(x).upper()
        it = iter(f"{country}{98 - _mod97(new + country + '00'):02d}{new}")
        return "".join(c if c == " " else next(it) for c in text)

    return f"iban {country} {shape}", size, rank, spell


@dataclass(frozen=True)
class Kind:
    """A pattern whose group 1 (or whole match) is a candidate, and its format; ``around``: no such character beside it."""

    name: str
    pattern: re.Pattern
    read: Callable[[str], Format | list[Format] | None]
    before: str = r"[\w.+-]"
    after: str = r"\w"


_MONTH = "|".join(f"{m[:3]}(?:{m[3:]})?" if len(m) > 3 else m for m in MONTHS)
_SHORT_MONTH = "|".join(m[:3] for m in MONTHS)
#: In order of precedence; every pattern starts with a plain set of characters, which keeps scanning fast.
KINDS = (
    Kind("email", re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), email, before="", after=r"[\w]"),
    Kind("secret", re.compile(r"[=:][ \t]*[\"']?([0-9a-fA-F]{16,})"), secret, before="", after=r"\w"),
    Kind("iban", re.compile(r"[A-Z][A-Z]\d\d(?: ?[A-Z0-9]){11,}"), iban, before=r"\w"),
    Kind("ipv4", re.compile(r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"), ipv4, before=r"[\w.]", after=r"\w|\.\d"),
    Kind("ipv6", re.compile(r"[0-9A-Fa-f:](?:[0-9A-Fa-f]{0,4}:){1,7}[0-9A-Fa-f:]{0,5}"), ipv6, before=r"[\w:.]", after=r"[\w:]|\.\d"),
    Kind("date", re.compile(r"\d{4}(?:([-/.])\d\d\1\d\d|([-/])\d{1,2}\2\d{1,2})"), iso_date, before=r"[\w.-]", after=r"(?![Tt][0-2]\d(?::?[0-5]\d|[Zz]|[+.,-]|\b))\w|-\d"),
    Kind("date", re.compile(r"\d{1,2}([-/.])\d{1,2}\1\d{4}"), numeric_date, before=r"[\w.-]", after=r"[\w]|-\d"),
    Kind("date", re.compile(rf"\d{{4}}([-/.])(?:{_SHORT_MONTH})\1\d{{1,2}}", re.I), month_between, before=r"[\w.-]", after=r"[\w]|-\d"),
    Kind("date", re.compile(rf"\d{{1,2}}(?:st|nd|rd|th)? (?:of )?(?:{_MONTH}),? \d{{4}}", re.I), named_date, before=r"\w"),
    Kind("date", re.compile(rf"(?:{_MONTH}) \d{{1,2}}(?:st|nd|rd|th)?, \d{{4}}", re.I), named_date, before=r"\w"),
    Kind("ssn", re.compile(r"\d{3}-\d\d-\d{4}"), ssn, before=r"[\w-]", after=r"[\w]|-\d"),
    Kind("phone", re.compile(r"\+\d(?:[ .-]?\(?\d+\)?)+"), phone, before=r"[\w+]"),
    Kind("phone", re.compile(r"[\d(](?:[ .-]?\(?\d{2,3}\)?){1,2}[ .-]?\d{3}[ .-]\d{4}"), phone, before=r"[\w+]|\d-"),
    Kind("card", re.compile(r"\d(?:[ -]?\d){12,}"), card, before=r"\w", after=r"\w"),
)
_LOCAL_LETTER = re.compile(r"[\w.%+-]")
_SECRET_NAME = re.compile(r"(?:token|key|secret|password|passwd|pwd)[\"']?[ \t]*$", re.I)
_WORTH = re.compile(r"[0-9@]")
#: Words before a bare number that make it no address or phone, and words behind it that make it an amount.
_NUMBERED = re.compile(r"\b(?:version|ver|v|release|build|firmware|revision|rev|section|chapter|model|serial|sku)[.:#]?\s*$", re.I)
_COUNTED = re.compile(r"\s+(?:rows?|lines?|items?|records?|units?|pieces?|points?|pages?|steps?|users?|times|bytes|euros?|dollars?|km|kg|mm|cm)\b", re.I)


def _candidates(kind: Kind, text: str) -> Iterator[tuple[int, int]]:
    for m in kind.pattern.finditer(text):
        a, b = m.span()
        if kind.name == "email":
            # The whole run before the sign, however long; a run ends where an earlier sign stands, so runs do not meet.
            start = a
            while start > 0 and _LOCAL_LETTER.match(text[start - 1]):
                start -= 1
            if start == a:
                continue
            a = start
        elif kind.name == "secret":
            if not _SECRET_NAME.search(text, max(0, a - 24), a):
                continue
            a, b = m.span(1)
        elif kind.name == "phone" and text[b - 1] == ")" and text.count("(", a, b) < text.count(")", a, b):
            b -= 1
        yield a, b


def _fits(kind: Kind, text: str, a: int, b: int) -> bool:
    if kind.before and a and re.match(kind.before, text[a - 1]):
        return False
    if kind.after and re.match(kind.after, text[b : b + 6]):
        return False
    bare = kind.name == "ipv4" or (kind.name == "phone" and text[a].isdigit() and "(" not in text[a:b])
    return not (bare and (_NUMBERED.search(text[max(0, a - 16) : a]) or _COUNTED.match(text[b : b + 16])))


def _windows(kind: Kind, text: str, a: int, b: int, separators: str) -> Iterator[tuple[int, int]]:
    """The candidate; where it may have run into neighbouring numbers, also the runs of its words that are short enough."""
    most = {"card": 19, "phone": 15, "iban": 34}.get(kind.name)
    words = [(a + m.start(), a + m.end()) for m in re.finditer(f"[^{separators}]+", text[a:b])] if most else []
    if len(words) < 2:
        yield a, b
        return
    sizes = [sum(c.isalnum() for c in text[x:y]) for x, y in words]
    for i in range(len(words)):
        total, j = 0, i
        while j < len(words) and total + sizes[j] <= most:
            total += sizes[j]
            j += 1
        for k in range(j - 1, i - 1, -1):
            yield words[i][0], words[k][1]


#: Candidates are cut at blanks; what is not found so, at every separator.
_CUTS = (" ", " .-")
_SEPARATED = re.compile(r"[.-]")


def _free(spans: list[tuple], starts: list[int], a: int, b: int) -> bool:
    """Does a..b meet none of these ordered spans?"""
    i = bisect.bisect_left(starts, b)
    return not i or spans[i - 1][1] <= a


class Pseudonyms:
    """Finds values in texts and replaces them under one key; equal values are computed once."""

    def __init__(self, key: bytes, step: int = 1, remember: int = 100_000):
        self.key, self.step, self.remember = key, step, remember
        self.known: dict[tuple[str, int, int], int] = {}

    def _moved(self, domain: str, size: int, rank: int) -> int:
        at = domain, size, rank
        if at not in self.known:
            if len(self.known) >= self.remember:
                self.known.clear()
            self.known[at] = Feistel(self.key, domain, size).pseudonym(rank, self.step)
        return self.known[at]

    def spans(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, kind, replacement) of every value, in order, without overlaps."""
        if not _WORTH.search(text):
            return []
        found: list[tuple[int, int, str, str]] = []
        for kind in KINDS:
            # In order and free of overlap, so a span can only meet its neighbours in either list.
            starts, new, last = [f[0] for f in found], [], -1
            for span in _candidates(kind, text):
                here: list[tuple[int, int, str, str]] = []
                for separators in _CUTS:
                    here_starts, more, end = [f[0] for f in here], [], last
                    for a, b in _windows(kind, text, *span, separators):
                        if a < end or not _fits(kind, text, a, b) or not (_free(found, starts, a, b) and _free(here, here_starts, a, b)):
                            continue
                        form = kind.read(text[a:b])
                        if form is not None:
                            more.append((a, b, kind.name, self._spelt(form)))
                            end = b
                    here = sorted(here + more)
                    if (here and here[0][:2] == span) or not _SEPARATED.search(text, *span):
                        break
                if here:
                    new += here
                    last = here[-1][1]
            if new:
                found = sorted(found + new)
        return found

    def _spelt(self, form: Format | list[Format]) -> str:
        parts = form if isinstance(form, list) else [form]
        return "".join(write(self._moved(domain, size, rank)) for domain, size, rank, write in parts)

    def replace(self, text: str) -> tuple[str, list[tuple[int, int, str, str]]]:
        spans, out, at = self.spans(text), [], 0
        for a, b, _, new in spans:
            out += [text[at:a], new]
            at = b
        return "".join([*out, text[at:]]) if spans else text, spans


SPANS = T.ArrayType(
    T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
        T.StructField("kind", T.StringType()), T.StructField("pseudonym", T.StringType()),
    ])
)


def pseudonymise(df: DataFrame, key: bytes, text_col: str = "text", spans_col: str | None = "spans", step: int = 1) -> DataFrame:
    """All columns with the text's values replaced, and the spans that were replaced in the old text."""
    prepare(df.sparkSession)
    names, position = df.columns, df.columns.index(text_col)
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("pseudonym", pa.string())]))
    out_names = [f"_k{i}" for i in range(len(names))] + ["_spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = Pseudonyms(key, step)
        for batch in batches:
            texts, spans = [], []
            for t in batch.column(position):
                new, found = (None, []) if (t := t.as_py()) is None else worker.replace(t)
                texts.append(new)
                spans.append([dict(zip(("start", "end", "kind", "pseudonym"), s, strict=True)) for s in found])
            columns = list(batch.columns)
            columns[position] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, spans_type)], names=out_names)

    fields = [T.StructField(f"_k{i}", df.schema[i].dataType) for i in range(len(names))]
    done = df.toDF(*out_names[:-1]).mapInArrow(run, T.StructType([*fields, T.StructField("_spans", SPANS)]))
    kept = [F.col(f"_k{i}").alias(c) for i, c in enumerate(names) if c != spans_col]
    return done.select(*kept, *([F.col("_spans").alias(spans_col)] if spans_col else []))


def restore(df: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """The texts before pseudonymise, for the holder of the key."""
    return pseudonymise(df, key, text_col, None, step=-1)


def op2_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its values pseudonymised, how many there were, and of which kinds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pseudonymise(docs, DEMO_KEY)
    kinds = F.array_sort(F.array_distinct(F.col("spans.kind")))
    return out.select("doc_id", "text", F.size("spans").alias("n_values"), F.array_join(kinds, ",").alias("kinds"))
