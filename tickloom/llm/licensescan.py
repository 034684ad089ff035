"""License scans: ordered signature rules over the words of whole texts.

A text is brought to lower-case words with one space between them, so that a rule sees neither punctuation nor line breaks. One pass of
an Aho-Corasick automaton over it finds which rules' keywords occur; only these rules' patterns run. What they find overlaps: a license's
name stands inside its notice. A detection counts unless its words lie within those of a detection of higher priority, or within a longer
one of the same priority.

Every text is judged alone, so documents are read once and nothing is shuffled; a task holds one batch of texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import col

#: The phrases whose places are counted, and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Score of a text in which only a phrase is found.
PHRASE_SCORE = 0.6

#: Label, name as a pattern of words, keywords of which any name has one, versions.
VERSIONED = (
    ("gpl", r"(?:gnu )?general public licen[cs]e|gnu gpl|gpl", ("general public", "gpl"), ("1 0", "2 0", "3 0")),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public licen[cs]e|(?:gnu )?lgpl", ("general public", "lgpl"), ("2 0", "2 1", "3 0")),
    ("agpl", r"(?:gnu )?affero general public licen[cs]e|(?:gnu )?agpl", ("affero general", "agpl"), ("1 0", "3 0")),
    ("gfdl", r"(?:gnu )?free documentation licen[cs]e|gnu fdl|gfdl", ("free documentation", "fdl"), ("1 1", "1 2", "1 3")),
    ("apache", r"apache(?: software)? licen[cs]e|apache", ("apache",), ("1 0", "1 1", "2 0")),
    ("mpl", r"mozilla public licen[cs]e|mpl", ("mozilla public", "mpl"), ("1 0", "1 1", "2 0")),
    ("npl", r"netscape public licen[cs]e", ("netscape public",), ("1 0", "1 1")),
    ("epl", r"eclipse public licen[cs]e|epl", ("eclipse public", "epl"), ("1 0", "2 0")),
    ("cpl", r"common public licen[cs]e", ("common public",), ("1 0",)),
    ("cddl", r"common development and distribution licen[cs]e|cddl", ("common development", "cddl"), ("1 0", "1 1")),
    ("eupl", r"european union public licen[cs]e|eupl", ("european union public", "eupl"), ("1 0", "1 1", "1 2")),
    ("osl", r"open software licen[cs]e", ("open software",), ("1 0", "1 1", "2 0", "2 1", "3 0")),
    ("afl", r"academic free licen[cs]e", ("academic free",), ("1 1", "1 2", "2 0", "2 1", "3 0")),
    ("artistic", r"artistic licen[cs]e", ("artistic",), ("1 0", "2 0")),
    ("ecl", r"educational community licen[cs]e", ("educational community",), ("1 0", "2 0")),
    ("bsl", r"boost software licen[cs]e", ("boost software",), ("1 0",)),
    ("busl", r"business source licen[cs]e", ("business source",), ("1 1",)),
    ("psf", r"(?:python software foundation|psf) licen[cs]e", ("python software", "psf"), ("2 0",)),
    ("zpl", r"zope public licen[cs]e", ("zope public",), ("1 1", "2 0", "2 1")),
    ("lppl", r"latex project public licen[cs]e|lppl", ("latex project", "lppl"), ("1 0", "1 1", "1 2", "1 3")),
    ("ofl", r"(?:sil )?open font licen[cs]e", ("open font",), ("1 0", "1 1")),
    ("odbl", r"open (?:data commons open )?database licen[cs]e|odbl", ("database", "odbl"), ("1 0",)),
    ("pddl", r"public domain dedication and licen[cs]e|pddl", ("public domain dedication", "pddl"), ("1 0",)),
    ("cecill", r"cecill(?: [bc])?(?: free software licen[cs]e)?", ("cecill",), ("1 0", "1 1", "2 0", "2 1")),
    ("upl", r"universal permissive licen[cs]e", ("universal permissive",), ("1 0",)),
    ("ms-pl", r"microsoft public licen[cs]e|ms pl", ("microsoft public", "ms pl"), ("1 0",)),
    ("ms-rl", r"microsoft reciprocal licen[cs]e|ms rl", ("microsoft reciprocal", "ms rl"), ("1 0",)),
    ("php", r"php licen[cs]e", ("php",), ("3 0", "3 01")),
    ("qpl", r"q public licen[cs]e", ("q public",), ("1 0",)),
    ("apsl", r"apple public source licen[cs]e", ("apple public",), ("1 0", "1 1", "1 2", "2 0")),
    ("rpl", r"reciprocal public licen[cs]e", ("reciprocal public",), ("1 1", "1 5")),
    ("sspl", r"server side public licen[cs]e|sspl", ("server side public", "sspl"), ("1 0",)),
    ("elastic", r"elastic licen[cs]e", ("elastic licen",), ("2 0",)),
    ("mulanpsl", r"mulan permissive software licen[cs]e|mulan psl", ("mulan",), ("1 0", "2 0")),
    ("opl", r"open publication licen[cs]e", ("open publication",), ("1 0",)),
    ("openssl", r"openssl licen[cs]e", ("openssl",), ()),
    ("mit", r"(?:mit|expat|x11) licen[cs]e", ("mit licen", "expat licen", "x11 licen"), ()),
    ("mit-0", r"mit(?: 0| no attribution) licen[cs]e|mit no attribution", ("mit 0", "mit no"), ()),
    ("isc", r"isc licen[cs]e", ("isc licen",), ()),
    ("0bsd", r"(?:0|zero clause) ?bsd(?: licen[cs]e)?", ("bsd",), ()),
    ("bsd", r"(?:berkeley software distribution|bsd)(?: style)? licen[cs]e", ("berkeley software", "bsd"), ()),
    ("bsd-2-clause", r"(?:simplified|freebsd) bsd licen[cs]e|bsd (?:2|two) clause(?: licen[cs]e)?|(?:2|two) clause bsd(?: licen[cs]e)?", ("bsd",), ()),
    ("bsd-3-clause", r"(?:new|revised|modified) bsd licen[cs]e|bsd (?:3|three) clause(?: licen[cs]e)?|(?:3|three) clause bsd(?: licen[cs]e)?", ("bsd",), ()),
    ("bsd-4-clause", r"(?:original|old) bsd licen[cs]e|bsd (?:4|four) clause(?: licen[cs]e)?|(?:4|four) clause bsd(?: licen[cs]e)?", ("bsd",), ()),
    ("zlib", r"zlib(?: libpng)? licen[cs]e", ("zlib",), ()),
    ("libpng", r"libpng licen[cs]e", ("libpng",), ()),
    ("ncsa", r"(?:university of illinois )?ncsa (?:open source )?licen[cs]e", ("ncsa",), ()),
    ("unlicense", r"the unlicense|unlicense org", ("unlicense",), ()),
    ("wtfpl", r"do what the f[a-z]* you want to public licen[cs]e|wtfpl", ("you want to public", "wtfpl"), ()),
    ("beerware", r"beer ?ware licen[cs]e", ("beer",), ()),
    ("blueoak", r"blue oak model licen[cs]e", ("blue oak",), ("1 0 0",)),
    ("json", r"json licen[cs]e", ("json licen",), ()),
    ("postgresql", r"postgresql licen[cs]e", ("postgresql licen",), ()),
    ("ijg", r"independent jpeg group licen[cs]e", ("independent jpeg",), ()),
    ("intel", r"intel open source licen[cs]e", ("intel open",), ()),
    ("vim", r"vim licen[cs]e", ("vim licen",), ()),
    ("ruby", r"ruby licen[cs]e", ("ruby licen",), ()),
    ("openrail", r"(?:creativeml |bigscience )?open ?rail(?: m)?(?: licen[cs]e)?", ("openrail", "open rail"), ()),
)
#: Conditions of a Creative Commons license in words and in letters, its versions, ports.
CC_CONDITIONS = (("nc", r"non ?commercial"), ("nd", r"no ?deriv(?:ative|atives|s)?(?: works)?"), ("sa", r"share ?alike"))
CC_LICENSES, CC_VERSIONS = ((), ("nc",), ("nd",), ("sa",), ("nc", "nd"), ("nc", "sa")), ("1 0", "2 0", "2 5", "3 0", "4 0")
#: Label, sentence of a license's own text or of a notice, keyword, priority, score.
SENTENCES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted free of charge", 1, 1.0),
    ("isc", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice", "with or without fee", 1, 1.0),
    ("0bsd", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted", "with or without fee", 2, 0.9),
    ("bsd-2-clause", r"redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms", 2, 0.8),
    ("bsd-3-clause", r"neither the name of(?: [^ ]+){1,12} nor the names of its contributors may be used to endorse", "to endorse", 1, 1.0),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display", "advertising materials", 1, 1.0),
    ("apache-2.0", r"you may not use this file except in compliance with the license you may obtain a copy of the license at", "in compliance with the license", 1, 1.0),
    ("gpl", r"is free software you can redistribute it and or modify it under the terms of the gnu general public license", "you can redistribute it", 2, 0.9),
    ("lgpl", r"is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", "you can redistribute it", 2, 0.9),
    ("agpl", r"is free software you can redistribute it and or modify it under the terms of the gnu affero general public license", "you can redistribute it", 2, 0.9),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license v 2 0", "source code form", 1, 1.0),
    ("bsl-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software", "any person or organization", 1, 1.0),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "without any express or implied warranty", 1, 1.0),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered", 1, 1.0),
    ("wtfpl", r"you just do what the f[a-z]* you want to", "you just do what", 1, 0.9),
    ("beerware", r"you can buy me a beer in return", "a beer in return", 1, 0.9),
    ("ofl", r"this font software is licensed under the sil open font license", "font software", 2, 0.95),
    ("public-domain", r"(?:released|dedicated|placed) (?:in|into|to) the public domain", "public domain", 4, 0.7),
    ("public-domain", r"has waived all copyright", "waived all copyright", 3, 0.8),
    ("cc0-1.0", r"cc0(?: 1 0)?(?: universal)?", "cc0", 3, 0.9),
    ("cc0-1.0", r"creative commons zero(?: v?1 0)?(?: universal)?", "commons zero", 3, 0.9),
    ("cc0-1.0", r"creativecommons org publicdomain zero 1 0", "publicdomain zero", 2, 1.0),
    ("cc-pdm-1.0", r"creativecommons org publicdomain mark 1 0|public domain mark 1 0", "mark 1 0", 2, 1.0),
    ("cc", r"creative commons licen[cs]e", "creative commons", 5, 0.5),
    ("all-rights-reserved", r"all rights reserved", "all rights reserved", 5, 0.5),
    ("proprietary", r"(?:proprietary and confidential|confidential and proprietary)", "proprietary", 4, 0.7),
    ("proprietary", r"unauthorized copying of this file(?: [^ ]+){0,6} is (?:strictly )?prohibited", "unauthorized copying", 3, 0.8),
    ("proprietary", r"end user licen[cs]e agreement", "end user licen", 4, 0.6),
    ("free-restricted", r"for (?:non ?commercial|personal|academic|research) use only", "use only", 4, 0.6),
    ("permissive-notice", r"permission is granted to (?:copy|make and distribute) (?:distribute and or modify )?(?:verbatim copies of )?this (?:document|manual)", "permission is granted", 4, 0.7),
)


@dataclass(frozen=True)
class Rule:
    """A detection of ``pattern``, between spaces, is labelled ``label``; the smallest priority wins. Every match holds one of ``keywords``."""

    label: str
    pattern: str
    keywords: tuple[str, ...]
    priority: int
    score: float


def _rules_of(label: str, name: str, keywords: tuple[str, ...], versions: tuple[str, ...]) -> Iterator[Rule]:
    """SPDX tag, address, notice and name of one license; the same for each version; for versions also "or any later"."""
    title, notice = f"(?:the )?(?:{name})", r"(?:licensed|released|distributed|available|published|provided) (?:under|with)(?: the)?(?: terms(?: and conditions)? of(?: the)?)?"
    words = label.replace("-", " ")
    for version in versions:
        own = label + "-" + version.replace(" ", ".")
        # "version 2.0", "v2", "2": the zero of a whole version may be left out
        number = version.removesuffix(" 0") + ("(?: 0)?" if version.endswith(" 0") else "")
        dated = rf"(?:{title})(?: version | ver | v ?| ?v?){number}"
        yield Rule(own, rf"spdx license identifier {words} {number}(?: only)?", ("spdx",), 1, 1.0)
        yield Rule(f"{own}-or-later", rf"spdx license identifier {words} {number} or later", ("spdx",), 0, 1.0)
        address = "apache org licenses license " if label == "apache" else f"(?:org|com|net|eu) licen[cs]es? (?:old licenses )?{words} ?v?"
        yield Rule(own, address + number, (words,), 1, 1.0)
        yield Rule(f"{own}-or-later", rf"{dated}(?: of the licen[cs]e)? or(?: at your option)?(?: any)? (?:later|newer)(?: version)?", keywords, 1, 0.95)
        yield Rule(own, rf"{notice} {dated}(?: only)?", keywords, 2, 0.95)
        yield Rule(own, dated, keywords, 3, 0.8)
    yield Rule(label, rf"spdx license identifier {words}", ("spdx",), 2, 1.0)
    if spoken := [way for way in _ways(name) if " " in way]:  # a bare word such as a project's name is no name of a license
        yield Rule(label, rf"{notice} (?:the )?(?:{'|'.join(spoken)})", keywords, 4, 0.8)
        yield Rule(label, "|".join(spoken), keywords, 5, 0.6)


def _ways(name: str) -> list[str]:
    """A pattern's alternatives outside its groups."""
    depth, parts = 0, [""]
    for c in name:
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            parts.append("")
        else:
            parts[-1] += c
    return parts


def _creative_commons() -> Iterator[Rule]:
    spoken = dict(CC_CONDITIONS)
    for conditions in CC_LICENSES:
        stem = "-".join(("cc", "by", *conditions))
        letters, names = " ".join(("by", *conditions)), "".join(rf"(?: and)? {spoken[c]}" for c in conditions)
        for version in CC_VERSIONS:
            own = stem + "-" + version.replace(" ", ".")
            yield Rule(own, rf"spdx license identifier cc {letters} {version}", ("spdx",), 1, 1.0)
            yield Rule(own, rf"creativecommons org licenses {letters} {version}", ("creativecommons",), 1, 1.0)
            yield Rule(own, rf"creative commons attribution{names} (?:v ?|version )?{version}(?: (?:international|unported|generic))?", ("commons attribution",), 2, 0.95)
            yield Rule(own, rf"cc {letters} (?:v ?|version )?{version}", ("cc by",), 3, 0.9)
        yield Rule(stem, rf"creative commons attribution{names}", ("commons attribution",), 4, 0.8)
        yield Rule(stem, rf"cc {letters}", ("cc by",), 5, 0.6)


@cache
def rules() -> tuple[Rule, ...]:
    """All signature rules, in order."""
    found = [r for row in VERSIONED for r in _rules_of(*row)] + [*_creative_commons()]
    found += [Rule(label, pattern, (keyword,), priority, score) for label, pattern, keyword, priority, score in SENTENCES]
    return tuple(sorted(found, key=lambda r: r.priority))  # stable: the order above breaks ties


@cache
def compiled() -> tuple[re.Pattern, ...]:
    return tuple(re.compile(rf"(?<= )(?:{r.pattern})(?= )") for r in rules())


@cache
def automaton():  # noqa: ANN201
    """Keywords to the rules that one of them admits."""
    import ahocorasick

    by: dict[str, list[int]] = {}
    for k, r in enumerate(rules()):
        for word in r.keywords:
            by.setdefault(word, []).append(k)
    found = ahocorasick.Automaton()
    for word, own in by.items():
        found.add_word(word, own)
    found.make_automaton()
    return found


#: What bytes become: A-Z lower-case, and a space for every byte of ASCII that is no letter or digit.
_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def normal(text: str | None) -> tuple[int, str]:
    """Number of words, and the words with a space before, between and after them; one character for each byte."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()
    return len(words), f" {b' '.join(words).decode('latin-1')} "


def detections(line: str, found: set[int]) -> list[tuple[int, int, int]]:
    """``(from, to, rule)`` of every match of the rules ``found`` in a line of words; from and to in characters."""
    return [(m.start(), m.end(), k) for k in sorted(found) for m in compiled()[k].finditer(line)]


def uncontained(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Detections that lie in no other of a smaller priority, in no longer one of the same, and in no equal one of an earlier rule.

    Priorities come one after the other; within one, spans in order of their start meet the furthest end before them. So the time is that of
    sorting, however many detections overlap.
    """
    order, kept = rules(), []
    starts, ends = np.empty(0, np.int64), np.empty(0, np.int64)  # of what is kept from smaller priorities: starts in order, furthest end so far
    for priority in sorted({order[k].priority for *_, k in spans}):
        own = sorted((s for s in spans if order[s[2]].priority == priority), key=lambda s: (s[0], -s[1], s[2]))
        at = np.searchsorted(starts, [a for a, _, _ in own], "right") - 1
        furthest, fresh = -1, []
        for (a, b, k), i in zip(own, at.tolist(), strict=True):
            if b > furthest and not (i >= 0 and ends[i] >= b):
                fresh.append((a, b, k))
            furthest = max(furthest, b)
        kept += fresh
        both = np.array(sorted((a, b) for a, b, _ in kept), np.int64).reshape(-1, 2)
        starts, ends = both[:, 0], np.maximum.accumulate(both[:, 1])
    return kept


def phrase_places(line: str) -> dict[str, list[int]]:
    """Words that the phrases start at, by label."""
    out = {}
    for phrase, label in PHRASES.items():
        at, word, last, places = line.find(f" {phrase} "), 0, 0, []
        while at >= 0:
            word += line.count(" ", last, at)
            last = at
            places.append(word)
            at = line.find(f" {phrase} ", at + 1)
        if places:
            out.setdefault(label, []).extend(places)
    return out


def scan(text: str | None) -> tuple[int, int, int | None, int | None, str, str, float]:
    """``n_words, n_base, first_word, last_word, base_labels, labels, score`` of one text."""
    n, line = normal(text)
    admitted: set[int] = set()
    seen: set[int] = set()
    for _, own in automaton().iter(line):
        if id(own) not in seen:
            seen.add(id(own))
            admitted.update(own)
    base = phrase_places(line)
    places = [p for own in base.values() for p in own]
    found = uncontained(detections(line, admitted))
    labels = {rules()[k].label for *_, k in found}
    score = max([PHRASE_SCORE if base else 0.0, *(rules()[k].score for *_, k in found)])
    return n, len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels | set(base))), score


_ROW = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id``, number of words, places of the base phrases, the first and last of them, base labels, all labels and the score (of the
    surest detection that counts) of every row of ``docs`` (doc_id, text).

    A null text is an empty one: no words, no labels, score 0. Repeated rows and ids give a row each; other columns don't matter; an empty
    table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(t.as_py()) for t in batch.column("text")]  # one text at a time
            a = list(zip(*found, strict=True)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, k) for x, k in zip(a, kinds, strict=True))], [c.split()[0] for c in _ROW.split(", ")])

    return docs.select(col(docs, "doc_id", "long").alias("doc_id"), col(docs, "text", "string").alias("text")).mapInArrow(run, _ROW)
