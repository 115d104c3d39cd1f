from pyspark.sql import functions as F

from vellum.llm.licenses import TITLES, WORDINGS, header_licence, scan_licences

APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
GNU = """# This program is free software{0} you can redistribute it and/or modify
# it under the terms of the GNU {1}General Public License as published by
# the Free Software Foundation{2} either version {3} of the License, or
# (at your option) any later version."""
MIT = """Copyright (c) 2019 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
"""
BSD = """Copyright (c) 2011, Foo Inc.
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice.
"""
NEITHER = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""

CASES = [
    ("MIT License", "MIT"), ("The MIT License (MIT)", "MIT"), ("// SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), ("SPDX-License-Identifier: MIT", "MIT"),
    ("/* SPDX-License-Identifier: GPL-2.0-or-later */", "GPL-2.0"), ("Copyright 2020 Example Corp. Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    (APACHE, "Apache-2.0"), (APACHE.replace("\n", " "), "Apache-2.0"), (APACHE.replace(" ", "\n * "), "Apache-2.0"),
    ("# Copyright (c) 2019 The Foo Authors. All rights reserved.", "proprietary"),
    ("# Copyright (c) 2019 The Foo Authors. All rights reserved.\n" + APACHE, "Apache-2.0"),
    ("it under the terms of the GNU General Public License as published by", "GPL-1.0-or-later"),
    (GNU.format(":", "", ",", "3"), "GPL-3.0"), (GNU.format(";", "", ";", "2"), "GPL-2.0"), (GNU.format(";", "Lesser ", ";", "2.1"), "LGPL-2.1"),
    (GNU.format(":", "Lesser ", ",", "3"), "LGPL-3.0"), (GNU.format(":", "Affero ", ",", "3"), "AGPL-3.0"),
    (MIT, "MIT"), (MIT.replace("\n", " "), "MIT"), (BSD, "BSD-2-Clause"), (BSD + NEITHER, "BSD-3-Clause"),
    ("word " * 3000 + "this file is available under the MIT License, " + "more " * 3000, "MIT"),
    (None, None), ("", None), ("license", None), ("a driving license is needed in the public domain", None), ("SPDX-License-Identifier: Foo-1.0", None),
    ("Licensed under the Foo License, Version 2.0.", None), ("Licensed under the Apache License, Version 1.1.", None), ("Copyright 2020 Some Body", None),
    ("all copyright questions go to the office, which has reserved the room", None), ("the software license agreement of the company " * 50, None),
]


def test_usual_headers_tags_titles_and_texts_are_found(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, text string")
    got = {r.i: r.o and r.o.template for r in df.select("i", header_licence(F.col("text")).alias("o")).collect()}
    assert [(t, got[i]) for i, (t, _) in enumerate(CASES)] == CASES
    out = {r.path: r.own_licence for r in scan_licences(df, F.col("i").cast("string")).collect()}
    assert [out[str(i)] for i in range(len(CASES))] == [want for _, want in CASES]


def test_every_wording_is_found_as_its_own(spark):
    texts = [*TITLES, *WORDINGS]
    df = spark.createDataFrame([(i, f"# Copyright 1999\nx = a\n# {t}\ny = b") for i, (_, t) in enumerate(texts)], "i int, text string")
    got = {r.i: r.o and r.o.template for r in df.select("i", header_licence(F.col("text")).alias("o")).collect()}
    assert {(n, t, got[i]) for i, (n, t) in enumerate(texts) if got[i] != n} == set()


def test_wordings_need_no_python_and_no_shuffle(spark):
    plan = spark.createDataFrame([("a", "b")], "p string, text string").select(header_licence(F.col("text")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


#: Near relatives, denials, expressions: what is told wrongly if the nearest known notice is taken.
RELATED = [
    ("Redistribution and use are permitted under the BSD 2-Clause License.", "BSD-2-Clause"), ("Licensed under CC BY 3.0.", "CC-BY-3.0"),
    ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"), ("Licensed under CC BY-SA 3.0.", "CC-BY-SA-3.0"), ("Licensed under CC BY 5.0.", None),
    ("Licensed under CC BY-NC-SA 2.5.", "CC-BY-NC-SA-2.5"), ("MIT-0 License", "MIT-0"), ("Released under the MIT-0 License.", "MIT-0"),
    ("This work is licensed under the GNU General Public License, version 1.", "GPL-1.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"),
    ("This work is licensed under the GNU General Public License, version 9.", None),
    ("This work is not licensed under the GNU General Public License, version 3.", None), ("It was never released under the MIT License.", None),
    ("This work is not licensed under the GNU General Public License, version 3, but is licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("This file is not licensed under the MIT License. Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("# SPDX-License-Identifier: MIT OR Apache-2.0", "MIT OR Apache-2.0"), ("SPDX-License-Identifier: (mit OR GPL-2.0-only)  AND ISC", "(MIT OR GPL-2.0) AND ISC"),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", "GPL-2.0 WITH Classpath-exception-2.0"),
    ("SPDX-License-Identifier: Foo-1.0 OR Bar-2.0", None), ("SPDX-License-Identifier: MIT and more", "MIT"),
]


def test_relatives_denials_and_expressions(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(RELATED)], "i int, text string")
    got = {r.i: r.o and r.o.template for r in df.select("i", header_licence(F.col("text")).alias("o")).collect()}
    assert [(t, got[i]) for i, (t, _) in enumerate(RELATED)] == RELATED


def test_thousands_of_anchors_in_a_text(spark):
    texts = ["the license of this copyright is of no known kind, " * 2000 + "under the MIT License " + "and its license goes on " * 2000, "licensed software " * 2000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: r.o and r.o.template for r in df.select("i", header_licence(F.col("text")).alias("o")).collect()}
    assert got == {0: "MIT", 1: None}
