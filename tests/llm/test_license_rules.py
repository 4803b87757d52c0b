"""Operator 1's rules, suppression, priority and score against a plain evaluation of every rule without keywords."""

import re

from tagflow.llm import licenses

GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RULES = [(label, re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])"), priority) for label, _, _, pattern, priority, _ in licenses.rules()]
SCORE = {0: 0.0, 1: 0.5, 2: 0.75, 3: 0.9, 4: 1.0}


def examples():
    """A text for every family and template by hand-expanded names, texts that nest them, and near misses."""
    names = {
        "gpl-2.0": "GNU General Public License version 2", "gpl-3.0": "GNU General Public License v3", "lgpl-2.1": "GNU Lesser General Public License version 2.1", "lgpl-3.0": "Lesser General Public Licence 3.0",
        "agpl-3.0": "GNU Affero General Public License", "apache-2.0": "Apache License, Version 2.0", "apache-1.1": "Apache Software License 1.1", "mit": "MIT/X11 License", "mit-0": "MIT No Attribution",
        "bsd-2-clause": "Simplified BSD License", "bsd-3-clause": "BSD 3-Clause License", "bsd-4-clause": "original BSD", "0bsd": "Zero-Clause BSD", "isc": "ISC License", "mpl-1.1": "Mozilla Public License 1.1", "mpl-2.0": "Mozilla Public License, v. 2.0",
        "epl-1.0": "Eclipse Public License 1.0", "epl-2.0": "Eclipse Public License v2", "cddl-1.0": "Common Development and Distribution License", "cc0-1.0": "Creative Commons CC0 1.0 Universal",
        "cc-by-3.0": "Creative Commons Attribution 3.0 Unported", "cc-by-4.0": "CC BY 4.0", "cc-by-sa-3.0": "CC-BY-SA 3.0", "cc-by-sa-4.0": "Creative Commons Attribution-ShareAlike 4.0 International", "cc-by-nc-4.0": "CC BY-NC 4.0",
        "cc-by-nd-4.0": "Creative Commons Attribution-NoDerivatives 4.0", "cc-by-nc-sa-4.0": "CC BY-NC-SA 4.0", "cc-by-nc-nd-4.0": "CC BY-NC-ND 4.0", "odbl-1.0": "Open Data Commons Open Database License v1.0", "unlicense": "The Unlicense",
        "wtfpl": "Do What The Fuck You Want To Public License", "zlib": "zlib/libpng license", "bsl-1.0": "Boost Software License 1.0", "artistic-2.0": "Perl Artistic License 2.0", "eupl-1.2": "European Union Public Licence 1.2",
        "ofl-1.1": "SIL Open Font License 1.1", "psf-2.0": "Python Software Foundation License 2", "postgresql": "PostgreSQL License", "ncsa": "University of Illinois/NCSA Open Source License", "ms-pl": "Microsoft Public License",
    }
    forms = ["{}", "this is licensed under the terms of the {} today", "it was released under {}", "are redistributed under the terms and conditions of the {}.", "governed by the {}", "subject to {} and more"]
    out = [form.format(name) for name in names.values() for form in forms]
    out += [f"SPDX-License-Identifier: {i}" for i in ("MIT", "GPL-2.0-or-later", "Apache-2.0", "CC-BY-NC-ND-4.0", "0BSD", "ISC", "WTFPL", "Zlib")]
    out += ["All rights reserved.", "Permission is hereby granted, free of charge, to any person obtaining a copy", "Redistribution and use in source and binary forms, with or without modification, are permitted", "placed in the public domain"]
    out += ["Permission to use, copy, modify, and/or distribute this software for any purpose", "creative commons", "CC BY NC", "cc by sa 2.0", "mitigate the license", "gnu general public licenses", "accby the license", "the license of by sa nc nd mit isc"]
    out += [" ".join(out[k : k + 7]) for k in range(0, 40, 3)] + [None, "", "  ", "licensed under the MIT license. " * 50, "CC\n\nBY 4.0 CC BY CC-BY-SA 4.0 apache license version 2"]
    return out


def expected(text):
    norm = GAP.sub(" ", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")).strip(" ")
    starts = [0, *(m.end() for m in re.finditer(" ", norm))]
    at = {p: k for k, p in enumerate(starts)}
    spans = []
    for label, pattern, priority in RULES:
        for m in pattern.finditer(norm):
            begin = at[m.start()]
            spans.append((begin, begin + len(m[0].split(" ")), priority, label))
    kept = [s for s in spans if not any((t[0], -t[1], -t[2], t[3]) < (s[0], -s[1], -s[2], s[3]) and t[0] <= s[0] and s[1] <= t[1] and t[2] >= s[2] for t in spans)]
    base = {label for phrase, label in licenses.BASE if f" {phrase} " in f" {norm} "}
    return ",".join(sorted({s[3] for s in kept} | base)), SCORE[max((s[2] for s in kept), default=0)]


def test_rules_suppression_and_score(spark):
    texts = examples()
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(rows).collect()}
    assert got == {i: expected(t) for i, t in enumerate(texts)}
    assert len({label for labels, _ in got.values() for label in labels.split(",")}) > 45


def test_every_match_holds_the_keywords():
    for text in examples():
        norm = GAP.sub(" ", (text or "").lower()).strip(" ")
        for _, word, also, pattern, _, _ in licenses.rules():
            if re.search(rf"(?<![^ ])(?:{pattern})(?![^ ])", norm):
                assert word in f" {norm} " and also in f" {norm} "
