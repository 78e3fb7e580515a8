"""Licence notices in planted documents, and clean ones left alone."""

import pytest

from tillmart.llm import licenses

OTHERS = [f"an ordinary line about {w} and the general public, version {n}" for n, w in enumerate("sun moon sea sky tree road".split() * 20)]


@pytest.fixture(scope="module")
def classifier():
    return licenses.fit(OTHERS)


def test_templates_and_variants(classifier):
    for family, templates in licenses.TEMPLATES.items():
        for template in templates:
            for line in (template, template.upper(), f"  // {template} Contributors 2024.", template.replace(" ", "   ")):
                assert classifier.judge(line)[0] == family, line


def test_others(classifier):
    for line in [*OTHERS, "", "License", "All licenses are fine.", "permission to land was granted", "Licensed under terms of our own making.", "the MIT campus"]:
        assert classifier.judge(line) is None, line


def test_documents(spark, classifier):
    mit, apache = licenses.TEMPLATES["MIT"][0], licenses.TEMPLATES["Apache-2.0"][0]
    rows = [(1, None), (2, ""), (3, f"text\n{mit}\nmore\n{apache}"), (3, f"text\n{mit}\nmore\n{apache}"), (None, mit), (4, "word " * 200_000 + "\n" + mit), (5, "License talk")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, families string")
    found = licenses.scanned(spark, docs, classifier).collect()
    assert [r.families for r in found] == [[], [], ["Apache-2.0", "MIT"], ["Apache-2.0", "MIT"], ["MIT"], ["MIT"], []]
    assert [n.line for n in found[2].notices] == [1, 3]
    assert licenses.scanned(spark, docs.limit(0), licenses.train(spark, docs.limit(0))).collect() == []


def test_corpus(spark):
    """Every line of the corpus that is one of its notices is found, and no other line is."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT"}
    known |= {"This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0"}
    found = {r.doc_id: r.families for r in licenses.scanned(spark, docs, licenses.train(spark, docs)).collect()}
    wanted = {r.doc_id: sorted({f for line, f in known.items() if line in r.text.split("\n")}) for r in docs.collect()}
    assert found == wanted


GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at"""


@pytest.mark.parametrize("leader", ["", "# ", "// ", " * "])
def test_wrapped_notices(spark, classifier, leader):
    """Standard headers in lines of 80 columns, alone, in the midst of a long paragraph, and with lines that a comment leader leaves bare."""
    headers = [(GPL, "GPL-3.0", 0, 3), (MIT, "MIT", 0, 1), (BSD, "BSD", 0, 2), (APACHE, "Apache-2.0", 0, 1)]
    around = "\n".join(["an ordinary line about the sun and the sea"] * 40)
    texts = [header for header, *_ in headers] + [f"{around}\n{header}\n{around}" for header, *_ in headers]
    texts.append(f"{GPL}\n\n{MIT}")
    texts = ["\n".join(leader + line for line in text.split("\n")) for text in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = [[(n.family, n.line, n.last_line) for n in r.notices] for r in licenses.scanned(spark, docs, classifier).collect()]
    wanted = [[(family, first + n, last + n)] for n in (0, 40) for _, family, first, last in headers]
    assert found == [*wanted, [("GPL-3.0", 0, 3), ("MIT", 5, 6)]]


def test_paragraphs_apart(classifier):
    assert classifier.scan("Permission is hereby granted, free of charge,\n\nto any person obtaining a copy of this software") == []


def test_wrapped_notices_in_training():
    """Lines of wrapped notices are no examples of the unknown class."""
    trained = licenses.fit([*OTHERS, *[line for text in (GPL, MIT, BSD, APACHE) for line in text.split("\n")] * 40])
    assert [trained.scan(text)[0].family for text in (GPL, MIT, BSD, APACHE)] == ["GPL-3.0", "MIT", "BSD", "Apache-2.0"]


def test_two_licences(classifier):
    """All families of a line, whether they have notices of their own or share one."""
    both = [
        "Released under the MIT License. Licensed under the Apache License, Version 2.0.",
        "Licensed under the MIT license or the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0, or released under the MIT License, at your option.",
        "Dual licensed under the MIT or Apache License, Version 2.0",
        "SPDX-License-Identifier: MIT OR Apache-2.0",
        "SPDX-License-Identifier: Apache-2.0 OR MIT",
    ]
    for line in both:
        assert sorted({x.family for x in classifier.scan(line)}) == ["Apache-2.0", "MIT"], line
    found = classifier.scan("Licensed under CC BY 4.0. The images are licensed under CC BY-SA 4.0.")
    assert sorted(x.family for x in found) == ["CC-BY-4.0", "CC-BY-SA-4.0"]


def test_names(classifier):
    """A template that names its family is not covered by words that don't, and a longer name is not a shorter one."""
    for line in ("Released under the BSD License.", "the film was released under the new license of the label", "Use of this source code is governed by an MIT-style license."):
        assert classifier.scan(line) == [], line
    for family in ("LGPL-3.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "MPL-2.0"):
        for template in licenses.TEMPLATES[family]:
            assert {x.family for x in classifier.scan(template)} == {family}, template


def test_long_line(classifier):
    """Every template is found in a line of 40,000 foreign words."""
    for family, templates in licenses.TEMPLATES.items():
        for template in templates:
            found = classifier.scan(f"{'sun moon ' * 10_000}{template}{' sea sky' * 10_000}")
            assert [x.family for x in found] == [family], template


def test_keys(spark, classifier):
    """No stretch that covers a template lacks all keys, and short notices without the word licence are found in documents."""
    for template in licenses._SOUGHT:
        assert sum(w not in classifier.keys for w in template.words) < template.need, template.words
    lines = {"This text is available under CC BY 4.0.": "CC-BY-4.0", "Available under CC BY-SA 4.0": "CC-BY-SA-4.0", "Shared under CC BY-NC 4.0": "CC-BY-NC-4.0", "Released under the MIT": "MIT"}
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id int, text string")
    assert [r.families for r in licenses.scanned(spark, docs, classifier).collect()] == [[family] for family in lines.values()]


NEAR = {
    "GPL-2.0": [GPL.replace("version 3", "version 2"), GPL.replace("version 3", "version 2").replace("software:", "software;"), "SPDX-License-Identifier: GPL-2.0-or-later", "SPDX-License-Identifier: GPL-2.0-only", "Released under GPLv2."],
    "GPL-3.0": ["SPDX-License-Identifier: GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only", "It is distributed under the GNU GPL v3", "Licensed under GPLv3"],
    "AGPL-3.0": [GPL.replace("GNU General", "GNU Affero General"), "SPDX-License-Identifier: AGPL-3.0-or-later", "Licensed under the AGPLv3."],
    "LGPL-2.1": [GPL.replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1").replace("program", "library"), "SPDX-License-Identifier: LGPL-2.1-only"],
    "LGPL-3.0": [GPL.replace("GNU General", "GNU Lesser General").replace("program", "library"), "This library is licensed under the GNU Lesser General Public License, version 3."],
    "GPL": [GPL.split(" as published")[0] + "."],
    "Apache-1.1": ["Licensed under the Apache License, Version 1.1", "This code is released under the Apache Software License, version 1.1."],
    "Apache-2.0": ["The samples are available under the Apache 2.0 license.", "Licensed under Apache-2.0", "Everything here is distributed under Apache License 2.0"],
    "MIT": ["MIT License", "The MIT License", "This package is made available under the MIT licence.", "// SPDX-License-Identifier: MIT", "Do not remove this notice. Licensed under the MIT License.", "Code is licensed under the MIT License, text is not."],
    "ISC": ["ISC License", "Released under the ISC license", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License", "SPDX-License-Identifier: BSD-2-Clause", "Released under the Simplified BSD License"],
    "BSD-3-Clause": ["Licensed under the 3-clause BSD license", "SPDX-License-Identifier: BSD-3-Clause"],
    "MPL-1.1": ['The contents of this file are subject to the Mozilla Public License Version 1.1\n(the "License"); you may not use this file except in compliance with the License.', "SPDX-License-Identifier: MPL-1.1"],
    "MPL-2.0": ["SPDX-License-Identifier: MPL-2.0", "Licensed under the Mozilla Public License 2.0"],
    "CC-BY-3.0": ["Licensed under CC BY 3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."],
    "CC-BY-4.0": ["Text is available under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0.", "Photos are released under CC-BY-NC-SA-4.0"],
    "CC-BY-NC-ND-4.0": ["This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."],
    "CC0-1.0": ["Released under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"],
    "EPL-2.0": ["Made available under the Eclipse Public License 2.0"],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "Unlicense": ["SPDX-License-Identifier: Unlicense", "Released under the Unlicense."],
}
NONE = [
    "This software is not licensed under the terms of the MIT license.", "It was never released under the Apache License, Version 2.0.", "The parts are no longer available under the GPL-3.0.",
    "This file cannot be distributed under GPLv2.", "neither released under the MIT License", "the campus of MIT is large", "The Apache License, Version 2.0 was written in 2004.",
    "we talked about the MIT License and the GPL-3.0", "Licensed under the Apache License, Version 3.0", "Licensed under the Orchard License, Version 2.0.", "Released under the GNU Library General Public License",
    "SPDX-License-Identifier: LicenseRef-Own", "Use of this source code is governed by an MIT-like license.", "subject to the general public", "Licensed under CC BY-XX", "permission is hereby granted to land",
]


def test_relatives_and_negations(classifier):
    """Lines that are no examples of the training: at least 0.95 of what is reported is right, and of what is there is found."""
    wanted = [(line, family) for family, lines in NEAR.items() for line in lines]
    found = [(line, x.family) for line in [line for line, _ in wanted] + NONE for x in classifier.scan(line)]
    right = len(set(found) & set(wanted))
    wrong = set(found) ^ set(wanted)
    assert right >= 0.95 * len(found) and right >= 0.95 * len(wanted), wrong
    assert not [x for x in found if x[0] in NONE]


def test_against_all_names_and_places(classifier):
    """Every pair of names in one sentence gives both families; brute force over the names."""
    names = {family: texts[0] for family, texts in licenses.NAMED.items()}
    for one, first in names.items():
        for two, second in names.items():
            if one != two:
                got = {x.family for x in classifier.scan(f"Licensed under the {first} or the {second}.")}
                assert got == {one, two}, (first, second)
