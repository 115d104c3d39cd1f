"""License scans: TF-IDF cosine to licence templates, then inheritance from the nearest ancestor directory.

Built from DataFrame functions alone. A header is a line that holds an anchor
stem (licen, copyright, rights reserved, spdx, public domain); it is cut into
windows of at most 64 words that overlap by half, so that long lines are
covered whole. A window's sparse vector has the weight count * idf for each
of its terms, idf = ln((1 + N) / (1 + df)) + 1 over the N templates (a term of no
template has df 0); the cosines come from the templates' own sparse weights, as
postings of terms in a constant map. Scanning is a narrow pass without a
shuffle. A file's own licence is the template of its best window if that
reaches the threshold and holds the template's numbers (ties to the smaller
template name). Near relatives of the templates (other versions and clauses) are
compared by the same weights, so that they are told from them. What a text says
it is not licensed under, up to 14 words, is taken out before. An SPDX expression
of several licences is given whole, with its operators.

Beside these one-line notices, the usual wordings (titles, SPDX tags, standard
headers, the characteristic passages of full texts) are looked for: titles as
whole lines, all others in the words of the text, whose lines are joined for it,
by windows of about the wording's own length around each anchor. Around an anchor
only wordings are compared whose weights lie to the threshold's square or more on
words that are there at all: no other can reach the cosine. A wording also
needs its numbers and names (2, 0, apache) in the window, and no rival's
(lesser, affero). A stated licence goes before a family without a version
(GPL-1.0-or-later) or a text that others include (BSD-2-Clause), and these
before the mere reservation of rights.

A directory's licence is that of its licence files (LICENSE, COPYING, NOTICE
by name, or a given condition; best score, ties to the larger name). Distinct
directories, not files, are exploded into their ancestors and joined by path;
the deepest ancestor with a licence is inherited by files without their own.

Defined results: a NULL or empty text has no own licence; a NULL path has no
directory, so nothing is inherited; repeated rows are scanned alike, row by
row; an empty table gives no rows; further columns are kept where asked, whatever
their names, but for those called like a result, which are replaced. Long texts
are scanned whole; the work grows with their lines and anchors.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm.common import checkpointed, prepare, table

#: Notices of common licences (fixed values: the texts by which they are declared).
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use are permitted under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Released into the public domain under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0.",
    "proprietary": "All rights reserved.",
}
_GPL_NOTICE = "This work is licensed under the GNU {}General Public License, version {}."
#: Near relatives of the templates, in the same wordings.
RELATIVES = {
    "BSD-2-Clause": "Redistribution and use are permitted under the BSD 2-Clause License.",
    "GPL-1.0": _GPL_NOTICE.format("", "1"),
    "LGPL-2.0": _GPL_NOTICE.format("Lesser ", "2"),
    "LGPL-2.1": _GPL_NOTICE.format("Lesser ", "2.1"),
    "MIT-0": "Released under the MIT-0 License.",
    **{f"CC-{terms}-{version}": f"Licensed under CC {terms} {version}."
       for terms in ("BY", "BY-NC", "BY-NC-ND", "BY-NC-SA", "BY-ND", "BY-SA") for version in ("1.0", "2.0", "2.5", "3.0", "4.0")
       if f"CC-{terms}-{version}" not in TEMPLATES},
}
#: What is denied: up to 14 words after "not licensed under", cut short by a stop, a semicolon or "but".
_BUT = r"\bbut\b"
DENIED = (
    r"\b(not|never|no longer)\s+(\w+\s+){0,2}(licen[cs]ed|released|distributed|available|published|provided|covered)\s+(under|by)\b"
    r"([^\w.;]+\w+(\.\d+)*){0,14}"
)
#: Names by which licences go, in the notation of the templates' keys.
CALLED = {
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU AGPL version 3", "AGPL v3 License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache Software License 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License", "2-Clause Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "Modified BSD License", "3-Clause New BSD License"),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0 International License", "CC BY 4.0 License"),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0 License"),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0 License"),
    "CC0-1.0": ("CC0 1.0 Universal License", "Creative Commons CC0 1.0 Public Domain Dedication"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL version 2", "GPL v2 License"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL version 3", "GPL v3 License"),
    "ISC": ("ISC License",),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU LGPL version 2.1", "LGPL v2.1 License"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU LGPL version 3", "LGPL v3 License"),
    "MIT": ("MIT License", "The MIT License (MIT)"),
    "MIT-0": ("MIT-0 License", "MIT No Attribution License"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0 License"),
    "Unlicense": ("The Unlicense", "Unlicense License"),
}
_GNU = "under the terms of the GNU {}General Public License as published by the Free Software Foundation"
#: Standard headers, and passages that tell full texts.
PASSAGES = {
    "AGPL-1.0-or-later": (_GNU.format("Affero "), "it under the terms of the GNU Affero General Public License as published by"),
    "AGPL-3.0": (_GNU.format("Affero ") + ", either version 3 of the License, or (at your option) any later version.",
                 "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "under the Apache License, Version 2.0 (the \"License\")",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    ),
    "BSD-2-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "BSD-3-Clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "GPL-1.0-or-later": (_GNU.format(""), "it under the terms of the GNU General Public License as published by"),
    "GPL-2.0": (_GNU.format("") + "; either version 2 of the License, or (at your option) any later version.", _GNU.format("") + "; version 2 of the License.",
                "it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
                "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    "GPL-3.0": (_GNU.format("") + ", either version 3 of the License, or (at your option) any later version.", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
            "copyright notice and this permission notice appear in all copies.",),
    "LGPL-2.0-or-later": (_GNU.format("Lesser "), "it under the terms of the GNU Lesser General Public License as published by"),
    "LGPL-2.1": (_GNU.format("Lesser ") + "; either version 2.1 of the License, or (at your option) any later version.",
                 "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    "LGPL-3.0": (_GNU.format("Lesser ") + ", either version 3 of the License, or (at your option) any later version.",
                 "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License Version 2.0"),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
SPDX = {
    **{name: (name,) for name in CALLED},
    **{f"{g}-{v}": (f"{g}-{v}", f"{g}-{v}-only", f"{g}-{v}-or-later")
       for g, v in (("AGPL", "3.0"), ("GPL", "2.0"), ("GPL", "3.0"), ("LGPL", "2.1"), ("LGPL", "3.0"))},
}
#: What others include or say more exactly; the rest goes before.
GENERAL = {"proprietary": 0, "AGPL-1.0-or-later": 1, "GPL-1.0-or-later": 1, "LGPL-2.0-or-later": 1, "BSD-2-Clause": 1}
_TELLING = {"mit", "apache", "mozilla", "mpl", "bsd", "isc", "gnu", "gpl", "lgpl", "agpl", "lesser", "affero", "cc", "cc0", "unlicense", "creative",
            "sa", "nc", "sharealike", "noncommercial", "simplified", "new", "modified", "v2", "v3", "style"}
_RIVALS = {"lesser", "library", "affero", "lgpl", "agpl", "nc", "sa", "nd", "sharealike", "noncommercial", "noderivatives", "noderivs"}
_LICENSES = tuple((name, text) for name, texts in CALLED.items() for text in texts)
#: A name that says no license needs a word that does.
TITLES = tuple((name, text if "licen" in text.lower() else f"License: {text}") for name, text in _LICENSES)
WORDINGS = (
    *TEMPLATES.items(),
    *(
        (name, f"{'' if 'licen' in text.lower() else 'licensed '}{lead} the {text.removeprefix('The ')}")
        for name, text in _LICENSES
        for lead in ("under", "under the terms of")
    ),
    *((name, f"SPDX-License-Identifier: {tag}") for name, tags in SPDX.items() for tag in tags),
    *((name, text) for name, texts in PASSAGES.items() for text in texts),
)
ANCHORS = ("licen", "copyright", "rights reserved", "spdx", "public domain")
THRESHOLD = 0.75
WINDOW = 64
#: No window around an anchor reaches further: 50 words, 15 before them, and 16 after.
REACH = 66
_TAG = r"\(*\s*[A-Za-z0-9][A-Za-z0-9.+-]*(?:\s*\))*"
SPDX_EXPRESSION = rf"(?i:spdx(?:-license-identifier)?):\s*({_TAG}(?:\s+(?:AND|OR|WITH)\s+{_TAG})*)"
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)(\.[a-z0-9]+)?$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms_of(text: str) -> list[str]:
    return [t for t in re.split(r"[^a-z0-9]+", text.lower()) if t]


def weights(templates: dict[str, str], relatives: dict[str, str] | None = None) -> tuple[dict[str, float], float, dict[str, dict[str, float]]]:
    """(idf of each template term, idf of any other term, unit TF-IDF vector of each template and relative)."""
    counts = {name: Counter(terms_of(text)) for name, text in {**templates, **(relatives or {})}.items()}
    df = Counter(t for name in templates for t in counts[name])
    n = len(templates)
    idf = {t: math.log((1 + n) / (1 + d)) + 1 for t, d in sorted(df.items())}
    other = math.log(1 + n) + 1
    vectors = {}
    for name in sorted(counts):
        raw = {t: c * idf.get(t, other) for t, c in sorted(counts[name].items())}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        vectors[name] = {t: w / norm for t, w in raw.items()}
    return idf, other, vectors


def numbers_of(vector: dict[str, float]) -> list[str]:
    return sorted(t for t in vector if t.isdigit())


def stated(low: Column) -> Column:
    """A lower-cased text without what it denies."""
    return F.regexp_replace(F.regexp_replace(low, _BUT, ";"), DENIED, " ; ")


def _map(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def _windows(words: Column, window: int) -> Column:
    """Runs of at most ``window`` words, each starting half a window after the last."""
    half = window // 2
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - half - 1, F.lit(0)), F.lit(half))
    return F.transform(starts, lambda s: F.slice(words, s + 1, F.lit(window)))


def _counts(window: Column) -> Column:
    """struct(t, n) of the distinct terms of a window."""
    return F.transform(F.array_distinct(window), lambda t: F.struct(t.alias("t"), F.size(F.filter(window, lambda x: x == t)).alias("n")))


def _length(counts: Column, known: Column, other: float, vocabulary: list[str]) -> Column:
    """The length of a window's vector. The vocabulary is looked up by hash; only its terms look into the map, which is searched through."""

    def squared(c: Column) -> Column:
        w = c["n"] * F.when(c["t"].isin(vocabulary), F.try_element_at(known, c["t"])).otherwise(F.lit(other))
        return w * w

    return F.sqrt(F.aggregate(F.transform(counts, squared), F.lit(0.0), lambda a, x: a + x))


def _postings(columns: list[dict[str, float]]) -> Column:
    """A constant map from each term to its value in every one of the columns."""
    dense = {t: [c.get(t, 0.0) for c in columns] for t in sorted({t for c in columns for t in c})}
    return F.from_json(F.lit(json.dumps(dense)), "map<string,array<double>>")


def _best_match(window: Column, templates: dict[str, str], relatives: dict[str, str], threshold: float) -> Column:
    """struct(score, order, template) of the template nearest to the words of one window; NULL below the threshold."""
    idf, other, vectors = weights(templates, relatives)
    known = _map(idf)
    postings = _postings([{t: w * idf.get(t, other) for t, w in v.items()} for v in vectors.values()])
    names = F.from_json(F.lit(json.dumps([{"name": n, "numbers": numbers_of(v)} for n, v in vectors.items()])), "array<struct<name:string,numbers:array<string>>>")
    zeros = F.array_repeat(F.lit(0.0), len(vectors))
    vocabulary, used = list(idf), sorted({t for v in vectors.values() for t in v})

    def scored(counts: Column) -> Column:
        hit = F.filter(counts, lambda c: c["t"].isin(used))
        sums = F.aggregate(hit, zeros, lambda a, c: F.zip_with(a, F.element_at(postings, c["t"]), lambda x, y: x + c["n"] * y))

        def told(norm: Column) -> Column:
            each = F.transform(
                sums,
                lambda x, i: F.struct(F.round(x / norm, 6).alias("score"), (-i).alias("order"), F.get(names, i)["name"].alias("template"), F.get(names, i)["numbers"].alias("numbers")),
            )
            return F.array_max(
                F.filter(each, lambda m: (m["score"] >= threshold) & F.forall(m["numbers"], lambda t: F.array_contains(window, t)))
            )

        return F.when(F.size(hit) > 0, _let(_length(counts, known, other, vocabulary), told))

    return _let(_counts(window), scored)


def own_licence(text: Column, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD, window: int = WINDOW) -> Column:
    """struct(score, template) of the best header of a text; NULL below the threshold."""
    # Texts without any anchor are passed over before anything is rewritten or split.
    return F.when(_anchored(F.lower(text), ANCHORS), _let(stated(F.translate(text, _UPPER, _LOWER)), lambda low: _noticed(low, templates, threshold, window)))


def _anchored(low: Column, anchors: tuple[str, ...]) -> Column:
    return reduce(or_, [F.contains(low, F.lit(a)) for a in anchors])


def _noticed(low: Column, templates: dict[str, str], threshold: float, window: int) -> Column:
    """struct(score, template) of the best header line of a lower-cased text; NULL below the threshold."""
    relatives = RELATIVES if templates is TEMPLATES else {}
    lines = F.filter(F.split(low, "\n"), lambda line: _anchored(line, ANCHORS))
    words = lambda line: F.filter(F.split(line, "[^a-z0-9]+"), lambda w: w != "")
    windows = F.flatten(F.transform(lines, lambda line: _windows(words(line), window)))
    best = F.array_max(F.transform(windows, lambda w: _best_match(w, templates, relatives, threshold)))
    return _let(best, lambda m: F.when(m.isNotNull(), F.struct(m["score"].alias("score"), m["template"].alias("template"))))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


_WORDING = "struct<name:string,rank:int,order:int,weights:map<string,double>,telling:array<string>,rivals:array<string>>"


def _constants(wordings: tuple[tuple[str, str], ...]) -> tuple[tuple[Column, float, list[str]], list[dict]]:
    """((idf map, idf of any other term, vocabulary), what is compared of each wording); as JSON, a constant stays small in a plan."""
    idf, other, vectors = weights({i: text for i, (_, text) in enumerate(wordings)})
    order = {name: -i for i, name in enumerate(sorted({name for name, _ in wordings}))}
    rows = [
        {
            "name": name, "rank": GENERAL.get(name, 2), "order": order[name], "weights": {t: w * idf[t] for t, w in vectors[i].items()},
            "telling": sorted(t for t in vectors[i] if t.isdigit() or t in _TELLING), "rivals": sorted(_RIVALS - set(vectors[i])),
        }
        for i, (name, _) in enumerate(wordings)
    ]
    return (F.from_json(F.lit(json.dumps(idf)), "map<string,double>"), other, list(idf)), rows


def _matches(window: Column, wordings: Column, idf: tuple[Column, float, list[str]], threshold: float) -> Column:
    """The greatest struct(rank, score, order, template) of the wordings that a window's words reach the threshold with."""

    def scored(told: Column) -> Column:
        def one(cs: Column, norm: Column, wording: Column) -> Column:
            products = F.transform(cs, lambda c: c["n"] * F.coalesce(F.try_element_at(wording["weights"], c["t"]), F.lit(0.0)))
            score = F.round(F.aggregate(products, F.lit(0.0), lambda a, x: a + x) / norm, 6)
            return F.struct(wording["rank"].alias("rank"), score.alias("score"), wording["order"].alias("order"), wording["name"].alias("template"))

        def all_of(cs: Column) -> Column:
            return _let(_length(cs, *idf), lambda v: F.array_max(F.filter(F.transform(told, lambda wording: one(cs, v, wording)), lambda m: m["score"] >= threshold)))

        return F.when(F.size(told) > 0, _let(_counts(window), all_of))

    # Most windows lack the telling terms of every wording and are done here.
    told = F.filter(
        wordings, lambda wording: F.forall(wording["telling"], lambda t: F.array_contains(window, t)) & ~F.arrays_overlap(window, wording["rivals"])
    )
    return _let(told, scored)


def _about(n: int) -> int:
    """The window length for a wording of ``n`` words."""
    return n if n <= 16 else min((18, 20, 22, 25, 28, 32, 36, 40, 45, 50), key=lambda b: abs(b - n))


def _anchors(words: Column) -> Column:
    """Positions of the words that an anchor is told by."""

    def is_anchor(i: Column) -> Column:
        w = F.element_at(words, i + 1)
        before = F.when(i > 0, F.element_at(words, F.greatest(i, F.lit(1))))
        pair = ((w == "reserved") & (before == "rights")) | ((w == "domain") & (before == "public"))
        return F.contains(w, F.lit("licen")) | F.contains(w, F.lit("copyright")) | (w == "spdx") | F.coalesce(pair, F.lit(False))

    places = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, is_anchor)


def _worded(words: Column, all_wordings: tuple[tuple[str, str], ...], threshold: float) -> Column:
    """The best match of all wordings in the windows around the anchors of a text's words."""
    idf, rows = _constants(all_wordings)
    for (_, text), row in zip(all_wordings, rows, strict=True):
        # Short wordings hold an anchor themselves, longer ones lie beside one.
        n = row["length"] = _about(len(terms_of(text)))
        row["steps"] = list(range(1 - n, 1)) if n <= 16 else list(range(-n - 15, 17, n // 8))
    constant = F.from_json(F.lit(json.dumps(rows)), f"array<{_WORDING[:-1]},length:int,steps:array<int>>>")
    _, _, vectors = weights({i: text for i, (_, text) in enumerate(all_wordings)})
    masses = _postings([{t: round(w * w, 6) for t, w in vectors[i].items()} for i in range(len(all_wordings))])
    zeros = F.array_repeat(F.lit(0.0), len(all_wordings))
    least = threshold * threshold - 1e-3  # below the rounding of the masses

    def of_wording(p: Column, wording: Column) -> Column:
        starts = F.array_distinct(F.transform(wording["steps"], lambda d: F.greatest(p + d, F.lit(0))))
        starts = F.filter(starts, lambda s: s < F.size(words))
        window = lambda s: F.slice(words, s + 1, wording["length"])
        return F.array_max(F.transform(starts, lambda s: _let(window(s), lambda w: _matches(w, F.array(wording), idf, threshold))))

    def around(p: Column) -> Column:
        def alive(near: Column) -> Column:
            each = F.transform(F.filter(near, lambda t: t.isin(idf[2])), lambda t: F.element_at(masses, t))
            mass = F.aggregate(each, zeros, lambda a, m: F.zip_with(a, m, lambda x, y: x + y))
            return _let(
                mass,
                lambda m: F.filter(
                    constant, lambda w, i: (F.get(m, i) >= least) & F.forall(w["telling"], lambda t: F.array_contains(near, t))
                ),
            )

        first = F.greatest(p - REACH, F.lit(0))
        near = F.array_distinct(F.slice(words, first + 1, p - first + REACH + 1))
        return _let(_let(near, alive), lambda ws: F.array_max(F.transform(ws, lambda w: of_wording(p, w))))

    return F.array_max(F.transform(_anchors(words), around))


def spdx_expression(text: Column) -> Column:
    """The licences of a text's first SPDX tag, joined by AND, OR and WITH, if one of them is known; else NULL."""
    expression = F.regexp_extract(text, SPDX_EXPRESSION, 1)
    canonical = F.from_json(F.lit(json.dumps({tag.lower(): name for name, tags in SPDX.items() for tag in tags})), "map<string,string>")
    parts = F.filter(F.split(F.regexp_replace(expression, r"([()])", " $1 "), r"\s+"), lambda x: x != "")
    known = lambda x: F.map_contains_key(canonical, F.lower(x))
    spelt = F.array_join(F.transform(parts, lambda x: F.coalesce(F.try_element_at(canonical, F.lower(x)), x)), " ")
    return F.when((expression != "") & F.exists(parts, known), F.regexp_replace(F.regexp_replace(spelt, r"\( ", "("), r" \)", ")"))


def header_licence(
    text: Column,
    templates: dict[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    wordings: tuple[tuple[str, str], ...] | None = None,
    titles: tuple[tuple[str, str], ...] | None = None,
) -> Column:
    """struct(score, template) of the best notice, title, tag, header or passage of a text; NULL below the threshold.

    The known wordings and titles belong to the known templates; other templates are looked for alone."""
    if wordings is None:
        wordings = WORDINGS if templates is TEMPLATES else tuple(templates.items())
    if titles is None:
        titles = TITLES if templates is TEMPLATES else ()
    split = lambda t: F.filter(F.split(t, "[^a-z0-9]+"), lambda w: w != "")
    anchors = ("licen", "copyright", "reserved", "spdx", "domain")
    ranked = lambda m: F.struct(
        F.when(m["template"] == "proprietary", F.lit(0)).otherwise(F.lit(2)).alias("rank"), m["score"].alias("score"), F.lit(0).alias("order"), m["template"].alias("template")
    )
    tagged = lambda e: F.when(e.isNotNull(), F.struct(F.lit(3).alias("rank"), F.lit(1.0).alias("score"), F.lit(0).alias("order"), e.alias("template")))

    def best_of(low: Column) -> Column:
        found = [
            _let(_noticed(low, templates, threshold, WINDOW), lambda notice: F.when(notice.isNotNull(), ranked(notice))),
            _let(split(low), lambda ws: _worded(ws, wordings, threshold)),
        ]
        if templates is TEMPLATES:
            found.append(F.when(F.contains(low, F.lit("spdx")), _let(spdx_expression(text), tagged)))
        if titles:
            idf, rows = _constants(titles)
            constant = F.from_json(F.lit(json.dumps(rows)), f"array<{_WORDING}>")
            lines = F.filter(F.transform(F.filter(F.split(low, "\n"), lambda line: _anchored(line, anchors)), split), lambda ws: F.size(ws) <= 16)
            found.append(F.array_max(F.transform(lines, lambda ws: _matches(ws, constant, idf, threshold))))
        return _let(F.array_max(F.array(*found)), lambda m: F.when(m.isNotNull(), F.struct(m["score"].alias("score"), m["template"].alias("template"))))

    # Other case rules than A-Z alone only make more texts pass here.
    return F.when(_anchored(F.lower(text), anchors), _let(stated(F.translate(text, _UPPER, _LOWER)), best_of))


def parent(path: Column) -> Column:
    """The directory of a path; the root is the empty string."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def ancestors(directory: Column) -> Column:
    """The directory itself and all directories above it, up to the root."""
    parts = F.filter(F.split(directory, "/"), lambda x: x != "")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def inherited(files: DataFrame, is_licence_file: Column | None = None) -> DataFrame:
    """Adds ``licence``, ``licence_dir`` (NULL if it is the file's own) and ``levels_up`` (0 if own) to rows
    (path, own_licence, own_score, ...)."""
    if is_licence_file is None:
        is_licence_file = F.regexp_extract("path", r"([^/]*)$", 1).rlike(LICENCE_FILE)
    made = ("path", "own_licence", "own_score", "licence", "licence_dir", "levels_up")
    order = [c for c in files.columns if c not in made[3:]]
    rest = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(order)]
    files = checkpointed(
        files.select("path", "own_licence", "own_score", F.struct(*rest).alias("_rest"), parent(F.col("path")).alias("_dir"),
                     F.coalesce(is_licence_file, F.lit(False)).alias("_states"))
    )
    holding = (
        files.where("_states AND own_licence IS NOT NULL AND _dir IS NOT NULL")
        .groupBy(F.col("_dir").alias("_above"))
        .agg(F.max(F.struct("own_score", "own_licence")).alias("_s"))
        .select("_above", F.col("_s.own_licence").alias("_licence"))
    )
    holding = checkpointed(holding)
    climbing = checkpointed(files.where("_dir IS NOT NULL").select("_dir").distinct().select("_dir", F.explode(ancestors(F.col("_dir"))).alias("_above")))
    nearest = (
        climbing.join(holding, "_above")
        .groupBy("_dir")
        .agg(F.max_by(F.struct("_above", "_licence"), F.length("_above")).alias("_n"))
        .select("_dir", F.col("_n._above").alias("_above"), F.col("_n._licence").alias("_licence"))
    )
    nearest = checkpointed(nearest)
    depth = lambda d: F.size(F.filter(F.split(d, "/"), lambda x: x != ""))
    own = F.col("own_licence").isNotNull()
    return files.join(nearest, "_dir", "left").select(
        *[F.col(f"_rest.c{i}").alias(c) for i, c in enumerate(order)],
        F.coalesce("own_licence", "_licence").alias("licence"),
        F.when(~own, F.col("_above")).alias("licence_dir"),
        F.when(own, F.lit(0)).when(F.col("_above").isNotNull(), depth(F.col("_dir")) - depth(F.col("_above")) + 1).alias("levels_up"),
    )


def scan_licences(
    files: DataFrame,
    path: Column,
    text_col: str = "text",
    keep: list[str] | None = None,
    templates: dict[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    is_licence_file: Column | None = None,
) -> DataFrame:
    """Per file: kept columns, path, own_licence, own_score, licence, licence_dir, levels_up."""
    prepare(files.sparkSession)
    made = ("path", "own_licence", "own_score", "licence", "licence_dir", "levels_up")
    kept = [F.col(f"`{c}`") for c in (keep or []) if c not in made]
    scanned = files.select(F.struct(*kept, path.alias("path")).alias("_file"), header_licence(F.col(text_col), templates, threshold).alias("_own"))
    scanned = scanned.select("_file.*", F.col("_own.template").alias("own_licence"), F.col("_own.score").alias("own_score"))
    return inherited(scanned, is_licence_file)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, its own or inherited.

    ``documents`` has no paths: source and language stand for directories. In
    each (source, language) the notice-bearing document of the smallest id is
    the directory's licence file, in each source the one among all its
    languages is the source's.
    """
    docs = table(spark, sf_dir, "documents")
    scanned = docs.select("doc_id", "source", "lang", header_licence(F.col("text")).alias("_own"))
    scanned = checkpointed(scanned.select("doc_id", "source", "lang", F.col("_own.template").alias("own_licence"), F.col("_own.score").alias("own_score")))
    place = F.concat_ws("/", "source", "lang")
    holders = scanned.where("own_licence IS NOT NULL")
    first = holders.groupBy(place.alias("_in")).agg(F.min("doc_id").alias("_first"))
    top = holders.where("source IS NOT NULL").groupBy(F.col("source").alias("_in")).agg(F.min("doc_id").alias("_first"))
    files = scanned.withColumn("path", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))).drop("source", "lang")
    named = lambda rows: rows.join(holders, F.col("_first") == F.col("doc_id")).select(
        "doc_id", "own_licence", "own_score", F.concat_ws("/", "_in", F.lit("LICENSE")).alias("path")
    )
    licence_files = named(checkpointed(first)).unionByName(named(checkpointed(top))).withColumn("_is", F.lit(True))
    everything = files.withColumn("_is", F.lit(False)).unionByName(licence_files)
    out = inherited(everything, F.col("_is")).where("NOT _is")
    return out.select("doc_id", "path", "own_licence", "own_score", "licence", "licence_dir", "levels_up")


def _oracle() -> str:
    idf, other, vectors = weights(TEMPLATES, RELATIVES)
    numbers = ", ".join(f"('{name}', {numbers_of(v)}::VARCHAR[])" for name, v in vectors.items())
    terms = ", ".join(f"('{t}', {w!r})" for t, w in idf.items())
    parts = ", ".join(f"('{name}', '{t}', {w * idf.get(t, other)!r})" for name, v in vectors.items() for t, w in v.items())
    anchors = " OR ".join(f"contains(line, '{a}')" for a in ANCHORS)
    half = WINDOW // 2
    return f"""
WITH idf(term, w) AS (VALUES {terms}), tpl(template, term, w) AS (VALUES {parts}), need(template, numbers) AS (VALUES {numbers}),
low AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS line FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(regexp_replace(regexp_replace(line, '{_BUT}', ';', 'g'), '{DENIED}', ' ; ', 'g'), chr(10))) AS line
  FROM low WHERE {anchors}
), words AS (
  SELECT doc_id, row_number() OVER () AS line_id, list_filter(regexp_split_to_array(line, '[^a-z0-9]+'), lambda w: w <> '') AS ws
  FROM lines WHERE {anchors}
), win AS (
  SELECT doc_id, line_id, s AS pos, ws[s + 1 : s + {WINDOW}] AS ws
  FROM (SELECT *, unnest(range(0, greatest(len(ws) - {half} - 1, 0) + 1, {half})) AS s FROM words)
), tf AS (
  SELECT doc_id, line_id, pos, term, count(*) AS n FROM (SELECT doc_id, line_id, pos, unnest(ws) AS term FROM win) GROUP BY ALL
), norm AS (
  SELECT doc_id, line_id, pos, sqrt(sum((n * coalesce(w, {other!r})) * (n * coalesce(w, {other!r})))) AS norm
  FROM tf LEFT JOIN idf USING (term) GROUP BY ALL
), score AS (
  SELECT doc_id, line_id, pos, template, round(sum(n * w) / any_value(norm), 6) AS score
  FROM tf JOIN tpl USING (term) JOIN norm USING (doc_id, line_id, pos) GROUP BY ALL
), best AS (
  SELECT doc_id, score, template FROM score JOIN need USING (template) JOIN win USING (doc_id, line_id, pos)
  WHERE score >= {THRESHOLD} AND list_has_all(ws, numbers)
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, template) = 1
), files AS (
  SELECT d.doc_id, concat_ws('/', source, lang) AS dir, source, concat_ws('/', source, lang, CAST(d.doc_id AS VARCHAR)) AS path,
         b.template AS own_licence, b.score AS own_score
  FROM documents d LEFT JOIN best b ON b.doc_id = d.doc_id
), lang_dir AS (
  SELECT dir, arg_min(own_licence, doc_id) AS licence FROM files WHERE own_licence IS NOT NULL GROUP BY dir
), source_dir AS (
  SELECT source, arg_min(own_licence, doc_id) AS licence FROM files WHERE own_licence IS NOT NULL GROUP BY source
)
SELECT f.doc_id, f.path, f.own_licence, f.own_score, coalesce(f.own_licence, l.licence, s.licence) AS licence,
       CASE WHEN f.own_licence IS NOT NULL THEN NULL WHEN l.licence IS NOT NULL THEN f.dir WHEN s.licence IS NOT NULL THEN f.source END AS licence_dir,
       CASE WHEN f.own_licence IS NOT NULL THEN 0 WHEN l.licence IS NOT NULL THEN 1 WHEN s.licence IS NOT NULL THEN 2 END AS levels_up
FROM files f LEFT JOIN lang_dir l ON l.dir = f.dir LEFT JOIN source_dir s ON s.source = f.source
"""


ORACLE_SQL = _oracle()
