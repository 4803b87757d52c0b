"""Operator 1: licence scans by ordered signature rules, in column functions alone.

Texts that hold none of a few root strings are done after that test and a word count. The rest
are turned into words parted by single spaces; a rule is tried only where its keyword is
found. A matched rule marks its places in the words, so positions come from one linear pass.
Detections inside another of the same or a higher priority are suppressed. There is no join,
shuffle or Python in the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Everything that is not part of a word once A-Z is lower-cased; for raw text A-Z counts as word.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# The base phrases and their labels.
BASE = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]

# Strings of which a text must hold one for any rule to match, and the same as a pattern for `cc by`.
ROOTS = ["licen", "spdx", "released", "distributed", "redistribut", "available", "provided", "published", "governed", "subject", "domain", "reserved", "permission", "creative", "bsd", "cc0", "attribution"]
CC_BY = r"cc[\x00-\x2F\x3A-\x60\x7B-\x7F]+by"

# Licence families as label, keyword (in the words parted by blanks, with one before and after), pattern of the name, pattern of the identifier (words parted by blanks).
FAMILIES = """
gpl-2.0|general public|(?:gnu )?general public licen[sc]e(?: gpl)?(?: version| v)? ?2(?: 0)?|gpl 2 0(?: only| or later)?
gpl-3.0|general public|(?:gnu )?general public licen[sc]e(?: gpl)?(?: version| v)? ?3(?: 0)?|gpl 3 0(?: only| or later)?
lgpl-2.1|lesser general|(?:gnu )?lesser general public licen[sc]e(?: version| v)? ?2 1|lgpl 2 1(?: only| or later)?
lgpl-3.0|lesser general|(?:gnu )?lesser general public licen[sc]e(?: version| v)? ?3(?: 0)?|lgpl 3 0(?: only| or later)?
agpl-3.0|affero|(?:gnu )?affero general public licen[sc]e(?: version| v)?(?: ?3(?: 0)?)?|agpl 3 0(?: only| or later)?
apache-2.0|apache|apache (?:software )?licen[sc]e(?: version| v)? ?2(?: 0)?|apache 2 0
apache-1.1|apache|apache (?:software )?licen[sc]e(?: version| v)? ?1 1|apache 1 1
mit| mit |mit(?: x11)? licen[sc]e|mit
mit-0| mit |mit no attribution(?: licen[sc]e)?|mit 0
bsd-2-clause|bsd|(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd)(?: licen[sc]e)?|bsd 2 clause
bsd-3-clause|bsd|(?:new bsd|modified bsd|bsd 3 clause|3 clause bsd)(?: licen[sc]e)?|bsd 3 clause
bsd-4-clause|bsd|(?:original bsd|bsd 4 clause|4 clause bsd)(?: licen[sc]e)?|bsd 4 clause
0bsd|bsd|(?:zero clause bsd|bsd zero clause)(?: licen[sc]e)?|0bsd
isc| isc |isc licen[sc]e|isc
mpl-1.1|mozilla|mozilla public licen[sc]e(?: version| v)? ?1 1|mpl 1 1
mpl-2.0|mozilla|mozilla public licen[sc]e(?: version| v)? ?2(?: 0)?|mpl 2 0
epl-1.0|eclipse|eclipse public licen[sc]e(?: version| v)? ?1(?: 0)?|epl 1 0
epl-2.0|eclipse|eclipse public licen[sc]e(?: version| v)? ?2(?: 0)?|epl 2 0
cddl-1.0|common development|common development and distribution licen[sc]e(?: version| v)?(?: ?1(?: 0)?)?|cddl 1 0
cc0-1.0|cc0|(?:creative commons )?cc0(?: 1 0)?(?: universal)?|cc0 1 0
cc-by-3.0| 3 0 |(?:cc by|creative commons attribution) 3 0(?: unported)?|cc by 3 0
cc-by-4.0| 4 0 |(?:cc by|creative commons attribution) 4 0(?: international)?|cc by 4 0
cc-by-sa-3.0| 3 0 |(?:cc by sa|creative commons attribution share ?alike) 3 0(?: unported)?|cc by sa 3 0
cc-by-sa-4.0| 4 0 |(?:cc by sa|creative commons attribution share ?alike) 4 0(?: international)?|cc by sa 4 0
cc-by-nc-4.0| 4 0 |(?:cc by nc|creative commons attribution non ?commercial) 4 0(?: international)?|cc by nc 4 0
cc-by-nd-4.0| 4 0 |(?:cc by nd|creative commons attribution no ?deriv(?:s|atives)) 4 0(?: international)?|cc by nd 4 0
cc-by-nc-sa-4.0| 4 0 |(?:cc by nc sa|creative commons attribution non ?commercial share ?alike) 4 0(?: international)?|cc by nc sa 4 0
cc-by-nc-nd-4.0| 4 0 |(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:s|atives)) 4 0(?: international)?|cc by nc nd 4 0
odbl-1.0| database licen|open (?:data commons open )?database licen[sc]e(?: v?1 0)?|odbl 1 0
unlicense| unlicense |the unlicense|unlicense
wtfpl| you want to |do what the f\\S* you want to public licen[sc]e|wtfpl
zlib| zlib |zlib(?: libpng)? licen[sc]e|zlib
bsl-1.0| boost software |boost software licen[sc]e(?: version| v)?(?: ?1(?: 0)?)?|bsl 1 0
artistic-2.0| artistic licen|(?:perl )?artistic licen[sc]e(?: version| v)? ?2(?: 0)?|artistic 2 0
eupl-1.2| european union public |european union public licen[sc]e(?: version| v)?(?: ?1 2)?|eupl 1 2
ofl-1.1| open font |(?:sil )?open font licen[sc]e(?: version| v)?(?: ?1 1)?|ofl 1 1
psf-2.0| python software |python software foundation licen[sc]e(?: version| v)?(?: ?2)?|psf 2 0
postgresql| postgresql |postgresql licen[sc]e|postgresql
ncsa| of illinois |university of illinois ncsa open source licen[sc]e|ncsa
ms-pl| microsoft public |microsoft public licen[sc]e|ms pl
""".strip()

# How a licence is named, with its priority (a higher one is the surer) and a second keyword; {n} is the name, {i} the identifier.
TEMPLATES = [
    (r"spdx licen[sc]e identifier {i}", 4, " identifier "),
    (r"(?:is |are )?licen[sc]ed under (?:the )?(?:terms of (?:the )?)?{n}", 3, "ed under "),
    (r"(?:is |are )?(?:released|published|made available|available) under (?:the )?(?:terms of (?:the )?)?{n}", 3, " under "),
    (r"(?:is |are )?(?:distributed|redistributed|provided) under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{n}", 3, "ed under "),
    (r"(?:is )?(?:governed by|subject to) (?:the )?(?:terms of (?:the )?)?{n}", 2, ""),
    (r"{n}", 1, ""),
]

# Single signatures as label, keyword, pattern and priority.
SINGLES = """
gpl|general public|gnu general public licen[sc]e|1
lgpl|lesser general|gnu lesser general public licen[sc]e|1
apache|apache|apache licen[sc]e|1
cc-by| cc by |cc by|1
cc-by-nc| cc by nc |cc by nc|1
cc-by-sa| cc by sa |cc by sa|1
creative-commons| creative commons |creative commons(?: licen[sc]e)?|1
public-domain|public domain|(?:dedicated to|released (?:in)?to|placed in) the public domain|2
proprietary| rights reserved |all rights reserved|1
mit| permission is hereby |permission is hereby granted free of charge to any person obtaining a copy|4
isc| permission to use |permission to use copy modify and or distribute this software for any purpose|4
bsd| redistribution and use |redistribution and use in source and binary forms with or without modification are permitted|4
""".strip()


def rules() -> list[tuple[str, str, str, str, int, str]]:
    """(label, keyword, second keyword, pattern, priority, base label or '') of all signatures, in order.

    Every match of a pattern holds both keywords.
    """
    out = []
    for line in FAMILIES.splitlines():
        label, word, rest = line.split("|", 2)
        name, ident = _names(rest)
        for form, priority, also in TEMPLATES:
            key = " spdx licen" if "{i}" in form else word
            out.append((label, key, also, form.replace("{n}", f"(?:{name})").replace("{i}", f"(?:{ident})"), priority, ""))
    for line in SINGLES.splitlines():
        label, word, rest = line.split("|", 2)
        pattern, priority = rest.rsplit("|", 1)
        out.append((label, word, "", pattern, int(priority), ""))
    return [(label, f" {phrase} ", "", phrase, 1, label) for phrase, label in BASE] + out


def _names(rest: str) -> tuple[str, str]:
    """The two patterns at the end of a family line, parted by the last bar outside brackets."""
    depth, cut = 0, -1
    for k, c in enumerate(rest):
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            cut = k
    return rest[:cut], rest[cut + 1 :]


def _rule_array() -> Column:
    return F.array(
        *(
            F.struct(F.lit(label).alias("label"), F.lit(word).alias("word"), F.lit(also).alias("also"), F.lit(f"(?<![^ ])(?:{pattern})(?![^ ])").alias("pattern"), F.lit(priority).alias("priority"), F.lit(base).alias("base"))
            for label, word, also, pattern, priority, base in rules()
        )
    )


def _places(norm: Column, rule: Column) -> Column:
    """Spans of a rule in the words: start, stop, priority, label, base."""
    marked = F.split(F.regexp_replace(norm, rule["pattern"], F.lit("\x01$0\x02")), " ")
    begin = F.filter(F.transform(marked, lambda w, i: F.when(w.startswith("\x01"), i)), lambda i: i.isNotNull())
    stop = F.filter(F.transform(marked, lambda w, i: F.when(w.endswith("\x02"), i + 1)), lambda i: i.isNotNull())
    return F.zip_with(begin, stop, lambda a, b: F.struct(a.alias("start"), (-b).alias("end"), (-rule["priority"]).alias("rank"), rule["label"].alias("label"), rule["base"].alias("base")))


def _kept(spans: Column) -> Column:
    """(labels, best priority) after suppression: spans come by start, then longest, then priority.

    The fold holds the farthest end of each priority; a span inside one of at least its own
    priority that came before is suppressed.
    """
    levels = 5
    start = F.struct(F.array_repeat(F.lit(0), levels).alias("ends"), F.array().cast("array<string>").alias("labels"), F.lit(0).alias("best"))

    def step(state: Column, s: Column) -> Column:
        priority, end = -s["rank"], -s["end"]
        inside = F.exists(F.slice(state["ends"], priority + 1, F.lit(levels)), lambda e: e >= end)
        ends = F.transform(state["ends"], lambda e, i: F.when(i == priority, F.greatest(e, end)).otherwise(e))
        return F.struct(
            F.when(inside, state["ends"]).otherwise(ends).alias("ends"),
            F.when(inside, state["labels"]).otherwise(F.array_union(state["labels"], F.array(s["label"]))).alias("labels"),
            F.when(inside, state["best"]).otherwise(F.greatest(state["best"], priority)).alias("best"),
        )

    return F.aggregate(spans, start, step)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row of `docs`.

    Null texts are empty: no words, empty label strings, a score of zero. Repeated rows stay, an
    empty table gives no rows, extra columns are ignored, a null doc_id stays null. A very long text is
    scanned whole, in time and memory in proportion to it. The score is 0.5, 0.75, 0.9 or 1 by
    the priority of the surest detection left, 0 without any.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    candidate = F.col("low").rlike(CC_BY)
    for root in ROOTS:
        candidate = F.col("low").contains(root) | candidate
    text, lowered = F.col("text"), docs.select("doc_id", text.alias("text"), F.lower(text).alias("low"))
    words = lowered.select(F.col("doc_id").cast("long"), F.regexp_count(text, F.lit(RAW_WORD)).cast("long").alias("n_words"), F.when(candidate, text).alias("held"))
    norm = words.select("doc_id", "n_words", F.trim(F.regexp_replace(F.translate("held", UPPER, UPPER.lower()), GAP, " ")).alias("norm"))
    padded = norm.withColumn("padded", F.concat(F.lit(" "), "norm", F.lit(" ")))
    fits = F.filter(_rule_array(), lambda r: F.col("padded").contains(r["word"]) & F.col("padded").contains(r["also"]) & F.regexp_like(F.col("norm"), r["pattern"]))
    matched = padded.select("doc_id", "n_words", "norm", F.when(F.col("norm").isNotNull(), fits).alias("fits"))
    spans = F.array_sort(F.flatten(F.transform("fits", lambda r: _places(F.col("norm"), r))))
    found = matched.select("doc_id", "n_words", spans.alias("spans"))
    base = F.filter("spans", lambda s: s["base"] != "")
    judged = found.select("doc_id", "n_words", base.alias("base"), _kept(F.col("spans")).alias("kept"))
    starts = F.transform("base", lambda s: s["start"])
    base_labels = F.array_distinct(F.transform("base", lambda s: s["base"]))
    every = F.array_sort(F.array_distinct(F.concat(F.transform("base", lambda s: s["base"]), F.col("kept.labels"))))
    best = F.col("kept.best")
    return judged.select(
        "doc_id",
        "n_words",
        F.when(F.col("base").isNull(), 0).otherwise(F.size("base")).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.concat_ws(",", F.array_sort(base_labels)).alias("base_labels"),
        F.concat_ws(",", every).alias("labels"),
        F.when(best >= 4, 1.0).when(best == 3, 0.9).when(best == 2, 0.75).when(best == 1, 0.5).otherwise(0.0).alias("score"),
    )
