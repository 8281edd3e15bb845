"""License scans by sentence rules.

Texts are cut into sentences at sentence ends and blank lines; a single newline
is a space. A sentence is normalised to its words (ASCII letters and digits,
lower case; comment marks and punctuation fall away) and mapped to the identifier
of a known licence sentence by a dictionary of normalised sentences, whose keys
are their first ``HEAD`` words. Sentences are looked up where a sentence, a line or
a part after a colon or semicolon begins, those of over twelve words at every
word; one of over six words may go on, a shorter one must end there.
A rule is an ordered sequence of identifiers; where it appears in a document's
sequence (unknown sentences in between allowed up to ``gap``) the licence is
found. Rules are tried longest first and a sentence serves one match.

Cases: null or empty text has no licence; repeated rows each get a row; ties go
to the longer rule, then the rule's order; empty table, empty result; whole
texts are read; extra columns are ignored.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthledger.llm.common import ship, table

ship(__name__)

#: Identifier -> sentence (* is up to 12 words), and the ordered rules over identifiers.
GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"
LGPL = "is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"
AGPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License"
FSF = " as published by the Free Software Foundation, either version "
ISC = "distribute this software for any purpose with or without fee is hereby granted"
SENTENCES = {
    "mit-ref": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mit-asis": 'The software is provided "as is", without warranty of any kind, express or implied',
    "apache-ref": "Licensed under the Apache License, Version 2.0.",
    "apache-use": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "gpl3-ref": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": GPL + FSF + "3 of the License",
    "gpl2-free": GPL + FSF + "2 of the License",
    "gpl2-only": GPL + " version 2",
    "gpl3-only": GPL + " version 3",
    "gpl-any": GPL,
    "gpl-warranty": "This program is distributed in the hope that it will be useful",
    "lgpl21-free": "This * " + LGPL + FSF + "2.1 of the License",
    "lgpl3-free": "This * " + LGPL + FSF + "3 of the License",
    "lgpl-any": "This * " + LGPL,
    "agpl-free": AGPL + FSF + "3 of the License",
    "agpl-any": AGPL,
    "mpl-form": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "isc-grant": "Permission to use, copy, modify, and/or " + ISC + ", provided that the above copyright notice and this permission notice appear in all copies",
    "isc-and": "Permission to use, copy, modify, and " + ISC + ", provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd-grant": "Permission to use, copy, modify, and/or " + ISC + ".",
    "cc0-deed": "The person who associated a work with this deed has dedicated the work to the public domain",
    "cc0-waive": "To the extent possible under law, * has waived all copyright and related or neighboring rights to",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "ccbync-ref": "Licensed under CC BY-NC 4.0.",
    "ccby-ref": "Licensed under CC BY 4.0.",
    "bsd-redist": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-name": "Neither the name of * may be used to endorse or promote products derived from this software",
}
RULES = (
    ("BSD-3-Clause", ("bsd-redist", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", ("bsd-redist", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-grant", "mit-asis")),
    ("Apache-2.0", ("apache-ref", "apache-use", "apache-copy")),
    ("GPL-3.0", ("gpl-free", "gpl-warranty")),
    ("GPL-3.0", ("gpl3-only", "gpl-warranty")),
    ("GPL-2.0", ("gpl2-free", "gpl-warranty")),
    ("GPL-2.0", ("gpl2-only", "gpl-warranty")),
    ("GPL", ("gpl-any", "gpl-warranty")),
    ("AGPL-3.0", ("agpl-free", "gpl-warranty")),
    ("AGPL", ("agpl-any", "gpl-warranty")),
    ("LGPL-2.1", ("lgpl21-free", "gpl-warranty")),
    ("LGPL-3.0", ("lgpl3-free", "gpl-warranty")),
    ("LGPL", ("lgpl-any", "gpl-warranty")),
    ("MIT", ("mit-ref",)),
    ("MIT", ("mit-grant",)),
    ("Apache-2.0", ("apache-ref",)),
    ("GPL-3.0", ("gpl3-ref",)),
    ("GPL-3.0", ("gpl-free",)),
    ("GPL-3.0", ("gpl3-only",)),
    ("GPL-2.0", ("gpl2-free",)),
    ("GPL-2.0", ("gpl2-only",)),
    ("GPL", ("gpl-any",)),
    ("AGPL-3.0", ("agpl-free",)),
    ("AGPL", ("agpl-any",)),
    ("LGPL-2.1", ("lgpl21-free",)),
    ("LGPL-3.0", ("lgpl3-free",)),
    ("LGPL", ("lgpl-any",)),
    ("MPL-2.0", ("mpl-form",)),
    ("ISC", ("isc-grant",)),
    ("ISC", ("isc-and",)),
    ("0BSD", ("0bsd-grant",)),
    ("CC0-1.0", ("cc0-deed",)),
    ("CC0-1.0", ("cc0-waive",)),
    ("Unlicense", ("unlicense",)),
    ("CC-BY-NC-4.0", ("ccbync-ref",)),
    ("CC-BY-4.0", ("ccby-ref",)),
    ("BSD", ("bsd-redist",)),
)
#: Fixed values: (licence, sentence that names it alone), titles of full texts among them.
REFERENCES = (
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This * is licensed under the MIT License"),
    ("Apache-2.0", "This * is licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
)
#: Names after an SPDX tag; an expression of several is not taken apart.
SPDX = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0",
    "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense",
)
NAMED = {f"named-{i}": r for i, r in enumerate(REFERENCES)} | {f"spdx-{n}": (n, f"SPDX-License-Identifier: {n}") for n in SPDX}
SENTENCES |= {k: s for k, (_, s) in NAMED.items()}
RULES += tuple((name, (k,)) for k, (name, _) in NAMED.items())
GAP = 2
HEAD = 5
ANY_WORDS = 12
CUT = re.compile(r"(?<=[.!?])\s+|\n[^\S\n]*\n\s*")
STOP = re.compile(r"(?<=[.!?:;])\s|\n[^\S\n]*\n|\Z")
LINE_END = re.compile(r"[^A-Za-z0-9\n]*?(?=(?<=[.!?:;])\s|\n|\Z)")
WORD = re.compile("[A-Za-z0-9]+")
FIELDS = "array<struct<license:string,first_sentence:int,last_sentence:int,start:int,stop:int>>"


def normal(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


class Words:
    """The normalised words of a text from a place on, read as far as asked for."""

    def __init__(self, text: str, at: int):
        self.left, self.words, self.ends = WORD.finditer(text, at), [], []

    def run(self, at: int, n: int) -> list[str]:
        while len(self.words) < at + n and (m := next(self.left, None)):
            self.words.append(m[0].lower())
            self.ends.append(m.end())
        return self.words[at : at + n]


class Sentence:
    """A known sentence: its runs of words between the places of any 1 to ``ANY_WORDS`` words."""

    def __init__(self, name: str, text: str):
        self.name, self.cuts = name, len(CUT.findall(text))
        self.runs = [normal(r) for r in text.split("*")]
        self.size = sum(map(len, self.runs)) + len(self.runs) - 1
        self.key = " ".join(self.runs[0][:HEAD])

    def end(self, words: Words) -> int | None:
        """Where the sentence ends if the text's words begin with it."""
        at = 0
        for i, run in enumerate(self.runs):
            gaps = range(1, ANY_WORDS + 1) if i else (0,)
            gap = next((g for g in gaps if words.run(at + g, len(run)) == run), None)
            if gap is None:
                return None
            at += gap + len(run)
        return words.ends[at - 1]


#: first words -> known sentences, longest first; and the number of words that keys have.
KNOWN: dict[str, list[Sentence]] = {}
for _s in sorted((Sentence(k, s) for k, s in SENTENCES.items()), key=lambda s: -s.size):
    KNOWN.setdefault(_s.key, []).append(_s)
SIZES = sorted({k.count(" ") + 1 for k in KNOWN})
LONG_KEYS = {k for k, s in KNOWN.items() if s[0].size > 12}


def heads(keys) -> str:
    """Pattern of the first two words of the keys: places worth a look."""
    two = sorted({"[^A-Za-z0-9]+".join(k.split()[:2]) for k in keys})
    return f"(?=({'|'.join(two)})(?![A-Za-z0-9]))"


LONG = re.compile(rf"(?<![A-Za-z0-9]){heads(LONG_KEYS)}", re.I | re.A)
START = re.compile(rf"(?:(?:\A|\n)[^A-Za-z0-9\n]*+|(?<=[.!?:;])\s[^A-Za-z0-9\n.!?:;]*+){heads(KNOWN)}", re.I | re.A)


def identify(text: str, at: int, begins: bool) -> tuple[str, int] | None:
    """(identifier, end) of the known sentence that begins at ``at``."""
    words = Words(text, at)
    found = [s for n in SIZES for s in KNOWN.get(" ".join(words.run(0, n)), ()) if begins or s.size > 12]
    for s in sorted(found, key=lambda s: -s.size):
        stop = s.end(words)
        if stop and sum(1 for _ in CUT.finditer(text, at, stop)) <= s.cuts:
            end = LINE_END.match(text, stop)
            if end:
                return s.name, at + len(text[at : end.end()].rstrip())
            if s.size > 6:
                return s.name, STOP.search(text, stop).start()
    return None


def known(text: str) -> list[tuple]:
    """(sentence number, start, stop, identifier) of the known sentences."""
    out, stop, cut, number = [], 0, 0, 0
    begins = {m.start(1) for m in START.finditer(text)}
    for at in sorted(begins | {m.start(1) for m in LONG.finditer(text)}):
        if at >= stop and (found := identify(text, at, at in begins)):
            number += sum(1 for _ in CUT.finditer(text, cut, at))
            cut, stop = at, found[1]
            out.append((number, at, stop, found[0]))
    return out


def scan_text(text: str | None) -> list[tuple]:
    text = text or ""
    seq = known(text)
    used, found = set(), []
    for name, rule in sorted(RULES, key=lambda r: -len(r[1])):
        for s in range(len(seq) - len(rule) + 1):
            run = seq[s : s + len(rule)]
            close = all(y[0] - x[0] <= GAP + 1 for x, y in zip(run, run[1:]))
            if close and tuple(x[3] for x in run) == rule and not used & set(range(s, s + len(rule))):
                used |= set(range(s, s + len(rule)))
                found.append((name, run[0][0], run[-1][0], run[0][1], run[-1][2]))
    return sorted(found, key=lambda f: (f[3], f[0]))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and the licences found, with sentence numbers and code points."""

    def run(batches):
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "found": [
                [dict(zip(("license", "first_sentence", "last_sentence", "start", "stop"), f)) for f in scan_text(t)] for t in b["text"]
            ]})

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id long, found {FIELDS}")


def op9(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    names = F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda f: f["license"]))), ",")
    spans = F.array_join(F.transform("found", lambda f: F.concat_ws(":", f["license"], f["start"].cast("string"), f["stop"].cast("string"))), ",")
    return found.select("doc_id", F.size("found").cast("long").alias("n_matches"), names.alias("licenses"), spans.alias("spans"))

