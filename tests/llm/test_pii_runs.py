import pytest

from vellum.llm.pii import DEMO_KEY, Pseudonyms

P, BACK = Pseudonyms(DEMO_KEY), Pseudonyms(DEMO_KEY, -1)
VISA, MASTER = "4111111111111111", "5500005555555559"


@pytest.mark.parametrize("tail", ["T03:04:05Z", "T03:04:05.123+01:00", "T0304", "t23:59", "T03Z", " 03:04:05"])
def test_a_timestamps_date_is_that_of_the_date_alone(tail):
    alone = P.replace("2024-01-02")[0]
    new, spans = P.replace(f"at 2024-01-02{tail}, done")
    assert new == f"at {alone}{tail}, done" and [s[2] for s in spans] == ["date"] and alone != "2024-01-02"
    assert BACK.replace(new)[0] == f"at 2024-01-02{tail}, done"


@pytest.mark.parametrize("text", ["2024-01-02Texas", "2024-01-02T", "2024-01-02T99:99", "2024-01-02x", "2024-01-02-03"])
def test_other_words_behind_a_date_are_no_time(text):
    assert P.replace(text) == (text, [])


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        (f"{VISA}-{MASTER}", ["card", "card"]), (f"2024-{VISA}", ["card"]), (f"{VISA}-2024", ["card"]), (f"12 34-{VISA} {MASTER}-7", ["card", "card"]),
        (f"2024-{VISA} {MASTER}", ["card", "card"]), (f"4111-1111-1111-1111-{MASTER}", ["card", "card"]), ("+49 30 901820.+1 743 555 3824", ["phone", "phone"]),
    ],
)
def test_joined_numbers_are_told_apart(text, kinds):
    new, spans = P.replace(text)
    assert [s[2] for s in spans] == kinds and BACK.replace(new)[0] == text
    one = {v: P.replace(v)[0] for v in (VISA, MASTER)}
    for v, p in one.items():
        assert (p in new) == (v in text) and v not in new


def test_joined_numbers_that_fail_are_left():
    for text in ("4111111111111112-5500005555555558", "2024-4111111111111112", "1-2-3-4-5-6-7-8-9-0-1-2-3-4"):
        assert P.replace(text) == (text, [])
