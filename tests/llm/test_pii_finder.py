"""The finder against a slow one that tries every piece of a text, and its limits."""

import datetime
import ipaddress
import random
import re
import time

import pytest

from vellum.llm.pii import DEMO_KEY, MONTHS, Pseudonyms

P, BACK = Pseudonyms(DEMO_KEY), Pseudonyms(DEMO_KEY, -1)


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def is_email(s):
    return re.fullmatch(r"[A-Za-z0-9._%+-]*[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", s)


def is_ipv4(s):
    return s.count(".") == 3 and all(p.isdigit() and str(int(p)) == p and int(p) < 256 for p in s.split("."))


def is_ipv6(s):
    try:
        return bool(ipaddress.IPv6Address(s)) and any(c.isdigit() for c in s) and "." not in s and "%" not in s
    except ValueError:
        return False


def is_date(s):
    for form in ("%Y-%m-%d", "%Y/%m/%d", "%d/%m/%Y", "%d-%m-%Y", "%m/%d/%Y", "%m-%d-%Y", "%d %B %Y", "%B %d, %Y"):
        try:
            day = datetime.datetime.strptime(s, form)
        except ValueError:
            continue
        if 1900 <= day.year <= 2099 and re.search(r"(?<!\d)\d{4}(?!\d)", s) and s == s.strip() and "  " not in s:
            return True
    return False


def is_ssn(s):
    m = re.fullmatch(r"(\d{3})-(\d\d)-(\d{4})", s)
    return m and m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000"


def is_phone(s):
    return bool(re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", s))


def is_card(s):
    d = re.sub("[ -]", "", s)
    return re.fullmatch(r"\d([ -]?\d){12,18}", s) and luhn(d) and (d[0] == "4" and len(d) in (13, 16, 19) or d[:2] in ("51", "52", "53", "54", "55") and len(d) == 16)


SLOW = [("email", is_email), ("ipv6", is_ipv6), ("ipv4", is_ipv4), ("date", is_date), ("ssn", is_ssn), ("phone", is_phone), ("card", is_card)]


def brute(text):
    """Longest valid pieces from the left, a kind after the other; nothing of a word beside them."""
    taken = []
    for kind, valid in SLOW:
        a = 0
        while a < len(text):
            for b in range(min(len(text), a + 45), a, -1):
                beside = (a and re.match(r"[\w.+-]", text[a - 1])) or re.match(r"\w|[.:-]\w", text[b : b + 2])
                if not beside and valid(text[a:b]) and not any(a < y and x < b for x, y, _ in taken):
                    taken.append((a, b, kind))
                    a = b - 1
                    break
            a += 1
    return sorted(taken)


def some_value(rng):
    day = datetime.date.fromordinal(rng.randint(datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()))
    body = f"4{rng.randrange(10**14):014d}"
    number = next(body + c for c in "0123456789" if luhn(body + c))
    return rng.choice([
        f"{rng.choice('abz')}{rng.choice(['', '.q', '_7'])}{rng.randrange(99)}@mail{rng.randrange(9)}.example.com",
        ".".join(str(rng.randrange(300)) for _ in range(4)), str(ipaddress.IPv6Address(rng.getrandbits(128) if rng.random() < 0.7 else 0x20010DB8 << 96)),
        day.isoformat(), day.strftime("%d/%m/%Y"), day.strftime("%m/%d/%Y"), f"{day.day} {MONTHS[day.month - 1]} {day.year}", f"{MONTHS[day.month - 1]} {day.day}, {day.year}",
        f"{rng.randrange(1000):03d}-{rng.randrange(100):02d}-{rng.randrange(10000):04d}", f"+1 ({rng.randrange(1000):03d}) {rng.randrange(1000):03d}-{rng.randrange(10000):04d}",
        number, f"{number[:4]}-{number[4:8]}-{number[8:12]}-{number[12:]}", str(int(number) ^ 1), f"{rng.randrange(10**6)}", "12:34:56", "2021-13-45",
    ])


def test_the_finder_finds_what_a_slow_one_finds():
    rng = random.Random(11)
    for _ in range(120):
        text = ""
        for _ in range(rng.randint(1, 7)):
            text += rng.choice(["see ", "Das Wort, ", "\n", "x; ", "(", "“"]) + some_value(rng) + rng.choice([", ", ") ", "!\n", "; and then "])
        assert [s[:3] for s in P.spans(text)] == brute(text), text


def test_one_date_has_one_pseudonym_in_every_notation():
    rng = random.Random(4)
    for _ in range(300):
        day = datetime.date.fromordinal(rng.randint(datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()))
        alone = datetime.date.fromisoformat(P.replace(day.isoformat())[0])
        th = lambda d: f"{d.day}{'th' if 10 < d.day < 14 else {1: 'st', 2: 'nd', 3: 'rd'}.get(d.day % 10, 'th')}"
        spellings = [lambda d: d.strftime("%d.%m.%Y"), lambda d: f"{d.day} {MONTHS[d.month - 1]} {d.year}", lambda d: f"{th(d)} of {MONTHS[d.month - 1]} {d.year}"]
        if 5 not in (day.month, alone.month):  # of May nobody can tell whether it is short
            spellings.append(lambda d: f"{MONTHS[d.month - 1][:3]} {th(d)}, {d.year}".upper())
        for spell in spellings:
            new, spans = P.replace(spell(day))
            assert [s[2] for s in spans] == ["date"] and new == spell(alone)
            assert BACK.replace(new)[0] == spell(day)
        if day.day > 12:
            for sep in "/-.":
                text = f"{day.month:02d}{sep}{day.day}{sep}{day.year}"
                new = P.replace(text)[0]
                assert new == (f"{alone.month:02d}{sep}{alone.day}{sep}{alone.year}" if alone.day > 12 else f"{alone.year}{sep}{MONTHS[alone.month - 1][:3]}{sep}{alone.day:02d}")
                assert BACK.replace(new)[0] == text


def test_unpadded_dates_and_both_spellings_of_an_address():
    padded, bare = P.replace("2020-01-05")[0], P.replace("2020-1-5")[0]
    assert datetime.date.fromisoformat(padded) == datetime.date(*map(int, bare.split("-")))
    short, long = P.replace("2001:db8::1")[0], P.replace("2001:0DB8:0000:0000:0000:0000:0000:0001")[0]
    assert ipaddress.IPv6Address(short) == ipaddress.IPv6Address(long) and long == long.upper() and BACK.replace(short)[0] in ("2001:db8::1", "2001:0db8:0000:0000:0000:0000:0000:0001")


@pytest.mark.parametrize("text", ["200-300-4000 rows", "Version 10.2.3.4", "v10.2.3.4", "release 1.2.3.4,", "a::b std::vector", "12:34:56", "2020.1.5", "firmware: 1.10.0.7"])
def test_versions_and_amounts_are_left(text):
    assert P.replace(text) == (text, [])


def test_a_phone_behind_a_number_is_found():
    assert [s[2] for s in P.spans("order 1234567 555-234-4567")] == ["phone"]


@pytest.mark.parametrize("n", [2, 64, 65, 70, 127, 128, 129, 300, 200_000])
def test_long_local_parts_and_secrets_are_taken_whole(n):
    for text in ("Ab3"[:1] + "x" * (n - 1) + "@a.org", "key=" + ("a1" * max(8, n))[: max(16, n)]):
        new, spans = P.replace(text)
        assert len(spans) == 1 and spans[0][1] == len(text) and BACK.replace(new)[0] == text
        if n > 16:
            body = new.split("=")[-1].split("@")[0]
            assert len(set(body)) > 3 and "xxxxxx" not in body and "a1a1a1a1" not in body


@pytest.mark.parametrize("value", ["10.{0}.{1}.7 ", "u{2}@x.org ", "4111111111111111 ", "2021-03-05, ", "+1 (743) 555-3824; ", "12 34-"])
def test_a_text_of_a_hundred_thousand_values_takes_seconds(value):
    n = 20_000 if value == "12 34-" else 100_000
    text = "".join(value.format(i % 256, i // 256 % 256, i % 1000) for i in range(n))
    start = time.process_time()
    spans = P.spans(text)
    assert time.process_time() - start < 40
    assert len(spans) == (0 if value == "12 34-" else 100_000)
