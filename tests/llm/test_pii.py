import datetime

import pytest

from vellum.llm import pii
from vellum.llm.pii import DEMO_KEY, Feistel, Pseudonyms, pseudonymise, restore

P = Pseudonyms(DEMO_KEY)
BACK = Pseudonyms(DEMO_KEY, -1)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1000, 4099])
def test_permutation_is_one_cycle_without_fixed_points(n):
    f = Feistel(b"k", "kind", n)
    images = [f.pseudonym(i) for i in range(n)]
    assert sorted(images) == list(range(n)) and (n == 1 or all(a != i for i, a in enumerate(images)))
    assert [f.pseudonym(a, -1) for a in images] == list(range(n))
    at, seen = 0, 0
    while True:
        at, seen = f.pseudonym(at), seen + 1
        if at == 0:
            break
    assert seen == n


def test_equal_values_stay_linked_in_any_notation():
    out, spans = P.replace("4111 1111 1111 1111, 4111-1111-1111-1111 and 4111111111111111!! 2021-03-05 05/03/2021 5 March 2021 MARCH 5, 2021")
    cards = [s for s in spans if s[2] == "card"]
    assert len({"".join(c for c in s[3] if c.isdigit()) for s in cards}) == 1 and luhn("".join(c for c in cards[0][3] if c.isdigit()))
    assert cards[0][3][4] == " " and cards[1][3][4] == "-" and all(s[3].startswith("4") for s in cards)
    dates = [s[3] for s in spans if s[2] == "date"]
    day = datetime.date.fromisoformat(dates[0])
    assert dates[1] == day.strftime("%d/%m/%Y") and dates[2] == f"{day.day} {pii.MONTHS[day.month - 1]} {day.year}"
    assert dates[3] == f"{pii.MONTHS[day.month - 1].upper()} {day.day}, {day.year}"
    assert "1111" not in out and "2021" not in out.replace(str(day.year), "")


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("+1 (743) 555-3824", "phone"), ("743-555-3824", "phone"), ("(743) 555-3824", "phone"), ("+1 (073) 555-8658", "phone"),
        ("+49 30 901820", "phone"), ("233.233.171.252", "ipv4"), ("hein.19@mail5.example.com", "email"), ("A@b.org", "email"),
        ("123-45-6789", "ssn"), ("GB82 WEST 1234 5698 7654 32", "iban"), ("DE89370400440532013000", "iban"), ("378282246310005", "card"),
        ("6011111111111117", "card"), ("1999-12-31", "date"), ("31.12.1999", "date"), ("12/31/1999", "date"), ("Feb 3, 2001", "date"),
        ('token = "11acdfb36bb72224148e6160f674b4be45601bff"', "secret"), ("KEY: 9233A8ECF7C5B09FE5949719B6B82BC439E9329B", "secret"),
    ],
)
def test_each_format_is_kept_found_again_and_undone(text, kind):
    for around in ("{}", "see {}.", "×{}!!", "{}### x", "\n{}\n"):
        t = around.format(text)
        new, spans = P.replace(t)
        assert [s[2] for s in spans] == [kind] and new != t
        assert [s[2] for s in P.spans(new)] == [kind]
        assert BACK.replace(new)[0] == t


def test_numbers_that_fail_validation_are_left():
    for text in ("2123465659789240", "4111111111111112", "999.1.1.1", "1.2.3.4.5", "2021-02-30", "666-12-1234", "version 2.0", "1234567890123456789012345",
                 "9111111111111111", "GB82 WEST 1234 5698 7654 33", "1850-01-01", "call 12345", "a@b", "@home", "key = 12ab"):
        assert P.replace(text) == (text, [])


def test_neighbouring_numbers_are_told_apart():
    new, spans = P.replace("123 4465758382889437 4465758382889437 99 +1 (499) 555-6503 999")
    assert [s[2] for s in spans] == ["card", "card", "phone"] and new.startswith("123 ") and new.endswith(" 999")
    assert spans[0][3] == spans[1][3]


def test_keys_differ_and_domains_do_not_collide():
    assert P.replace("4111111111111111")[0] != Pseudonyms(b"other").replace("4111111111111111")[0]
    phones = [f"+1 ({a:03d}) {e:03d}-0000" for a in (0, 17, 200, 999) for e in (0, 199, 200, 999)]
    images = [P.replace(p)[0] for p in phones]
    assert len(set(images)) == len(phones) and all(BACK.replace(i)[0] == p for i, p in zip(images, phones))


def test_operator_with_nulls_long_texts_clashes_and_repeats(spark):
    long = "filler text " * 30_000 + "4111111111111111 " + "more " * 10_000
    rows = [(1, None, "a", 1), (2, "", "b", 2), (3, "x re.46@mail8.example.com y", None, 3), (3, "x re.46@mail8.example.com y", None, 3), (None, long, "d", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _spans string, kinds int")
    out = pseudonymise(df, DEMO_KEY)
    assert out.columns == ["doc_id", "text", "_spans", "kinds", "spans"]
    got = {(r.doc_id, r.kinds): r for r in out.collect()}
    assert got[1, 1].text is None and got[1, 1].spans == [] and got[2, 2].text == ""
    assert got[3, 3].text == P.replace(rows[2][1])[0] and got[None, 4].text == P.replace(long)[0] != long
    assert [(s.kind, s.start) for s in got[None, 4].spans] == [("card", long.index("4111"))]
    assert pseudonymise(out, DEMO_KEY).columns == out.columns
    back = restore(out.drop("spans"), DEMO_KEY)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    assert pseudonymise(df.limit(0), DEMO_KEY).count() == 0
