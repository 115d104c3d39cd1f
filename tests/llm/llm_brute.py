"""Brute-force counterparts of the operators, on plain Python values."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(text, k):
    words = WORD.findall((text or "").translate(_LOW))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def components(keys, linked):
    """Index of the first member of each key's component, by repeated merging."""
    comp = list(range(len(keys)))
    for i in range(len(keys)):
        for j in range(i):
            if linked(i, j) and comp[i] != comp[j]:
                a, b = sorted((comp[i], comp[j]))
                comp = [a if c == b else c for c in comp]
    return comp


def near_groups(texts, k, percent=80):
    sets = [shingles(t, k) for t in texts]

    def linked(i, j):
        x, y = sets[i], sets[j]
        return bool(x) and bool(y) and 100 * len(x & y) >= percent * len(x | y)

    return sets, components(texts, linked)


def varied_texts(rng, n=40):
    """Texts with exact copies, near copies, short ones, shared passages, blanks of all kinds."""
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=30))
    out = []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randint(20, 120))
        out.append(" ".join(words))
        if i % 3 == 0:
            out.append(out[-1])
        if i % 4 == 0:
            changed = list(words)
            for _ in range(rng.randint(1, 3)):
                changed[rng.randrange(len(changed))] = "changed"
            out.append("\t".join(changed).upper())
        if i % 5 == 0:
            out.append(passage + " " + " ".join(rng.choices(vocabulary, k=10)))
    return out + ["", "   \n\t", None, "one", "ONE", "one two three", "one  two\vthree", "É é", passage]
