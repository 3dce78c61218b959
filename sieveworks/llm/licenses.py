"""License scans: licence templates with markup, matched by automata over words.

A template is plain wording with two kinds of markup:

    <<beginOptional>> ... <<endOptional>>     wording that may be missing
    <<var;words=LOW..HIGH>>                   LOW to HIGH replaceable words

It is compiled to a nondeterministic automaton whose edges carry a word or stand
for any word; optional and replaceable regions are skipped over empty edges.  A
text is accepted where all mandatory words stand consecutively.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from sieveworks.llm.common import pick

WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]"

# The base phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# The wording of public licences and of the usual notices.
TEMPLATES = (
    ("mit", "<<beginOptional>>this <<var;words=1..4>> is<<endOptional>> released under the <<beginOptional>>terms of the<<endOptional>> mit license"),
    ("mit", "mit license <<beginOptional>>copyright <<beginOptional>>c<<endOptional>> <<var;words=1..12>><<endOptional>> permission is hereby granted"),
    ("mit", "mit license copyright <<beginOptional>>c<<endOptional>> <<var;words=1..8>>"),
    ("mit", "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"software\"), to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software"),
    ("mit-text", """
        <<beginOptional>>the<<endOptional>> <<beginOptional>>mit license<<endOptional>> <<beginOptional>>copyright <<beginOptional>>c<<endOptional>> <<var;words=1..12>><<endOptional>>
        permission is hereby granted, free of charge, to any person obtaining a copy of <<var;words=1..5>> and associated documentation files (the "software"),
        to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or
        sell copies of the software, and to permit persons to whom the software is furnished to do so, subject to the following conditions:
        the above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the software.
        the software is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability,
        fitness for a particular purpose and noninfringement. in no event shall <<var;words=1..8>> be liable for any claim, damages or other liability,
        whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software"""),
    ("apache-2.0", "licensed under the apache license<<beginOptional>>, version<<endOptional>> 2.0"),
    ("apache-2.0", """
        licensed under the apache license, version 2.0 (the "license"); you may not use this <<var;words=1..4>> except in compliance with the license.
        you may obtain a copy of the license at <<beginOptional>>http<<endOptional>> <<beginOptional>>https<<endOptional>> www.apache.org/licenses/license-2.0 unless required by applicable law or agreed to in writing, software
        distributed under the license is distributed on an "as is" basis, without warranties or conditions of any kind, either express or implied"""),
    ("apache-2.0", "apache license version 2.0, january 2004 <<beginOptional>>http<<endOptional>> <<beginOptional>>https<<endOptional>> <<beginOptional>>www.apache.org/licenses<<endOptional>> terms and conditions for use, reproduction, and distribution"),
    ("gpl-3.0", "<<beginOptional>>this <<var;words=1..4>> is<<endOptional>> licensed under the gnu general public license<<beginOptional>>, version<<endOptional>> 3"),
    ("gpl-3.0", "under the terms of the gnu general public license as published by the free software foundation, either version 3 of the license<<beginOptional>>, or (at your option) any later version<<endOptional>>"),
    ("gpl-3.0", "gnu general public license version 3, 29 june 2007"),
    ("gpl-2.0", "under the terms of the gnu general public license <<beginOptional>>version 2<<endOptional>> as published by the free software foundation; either version 2 of the license<<beginOptional>>, or (at your option) any later version<<endOptional>>"),
    ("gpl-2.0", "gnu general public license version 2, june 1991"),
    ("lgpl-2.1", "under the terms of the gnu lesser general public license as published by the free software foundation; either version 2.1 of the license"),
    ("lgpl-3.0", "under the terms of the gnu lesser general public license as published by the free software foundation, either version 3 of the license"),
    ("agpl-3.0", "under the terms of the gnu affero general public license as published by the free software foundation, either version 3 of the license"),
    ("mpl-2.0", "mozilla public license<<beginOptional>>, <<beginOptional>>v<<endOptional>> <<beginOptional>>version<<endOptional>><<endOptional>> 2.0"),
    ("epl-2.0", "eclipse public license <<beginOptional>>v<<endOptional>> <<beginOptional>>version<<endOptional>> 2.0"),
    ("cc-by-nc", "licensed under <<beginOptional>>a creative commons<<endOptional>> cc by-nc <<beginOptional>><<var;words=1..2>><<endOptional>>"),
    ("cc-by-sa", "licensed under <<beginOptional>>a creative commons<<endOptional>> cc by-sa <<beginOptional>><<var;words=1..2>><<endOptional>>"),
    ("cc-by-sa", "creative commons attribution-sharealike <<var;words=1..2>> <<beginOptional>>international<<endOptional>> license"),
    ("cc-by-4.0", "creative commons attribution 4.0 international <<beginOptional>>public<<endOptional>> license"),
    ("cc0-1.0", "cc0 1.0 universal"),
    ("isc", "permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without fee is hereby granted"),
    ("isc-text", """
        <<beginOptional>>isc license<<endOptional>> <<beginOptional>>copyright <<beginOptional>>c<<endOptional>> <<var;words=1..12>><<endOptional>>
        permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies.
        the software is provided "as is" and <<var;words=1..6>> disclaims all warranties with regard to this software including all implied warranties of
        merchantability and fitness. in no event shall <<var;words=1..6>> be liable for any special, direct, indirect, or consequential damages or any damages
        whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in
        connection with the use or performance of this software"""),
    ("bsd", "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-2-clause", """
        redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        <<beginOptional>>1<<endOptional>> redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer<<beginOptional>>.<<endOptional>>
        <<beginOptional>>2<<endOptional>> redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
        in the documentation and/or other materials provided with the distribution. this software is provided by <<var;words=1..10>> "as is" and any express or
        implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed"""),
    ("bsd-3-clause", """
        redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        <<beginOptional>>1<<endOptional>> redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
        <<beginOptional>>2<<endOptional>> redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
        in the documentation and/or other materials provided with the distribution. <<beginOptional>>3<<endOptional>> neither the name of <<var;words=1..8>> nor the names of
        <<beginOptional>>its<<endOptional>> <<beginOptional>>any<<endOptional>> contributors may be used to endorse or promote products derived from this software without specific prior written permission"""),
    ("zlib", "this software is provided 'as-is', without any express or implied warranty. in no event will the authors be held liable for any damages arising from the use of this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "do what the fuck you want to public license"),
    ("copyright", "copyright <<beginOptional>>(c)<<endOptional>> <<var;words=1..8>> all rights reserved"),
    ("mit", "spdx-license-identifier: mit"),
    ("apache-2.0", "spdx-license-identifier: apache-2.0"),
    ("gpl-2.0", "spdx-license-identifier: gpl-2.0"),
    ("gpl-3.0", "spdx-license-identifier: gpl-3.0"),
    ("mpl-2.0", "spdx-license-identifier: mpl-2.0"),
    ("bsd-2-clause", "spdx-license-identifier: bsd-2-clause"),
    ("bsd-3-clause", "spdx-license-identifier: bsd-3-clause"),
    ("isc", "spdx-license-identifier: isc"),
)


def parse(template: str) -> list[tuple]:
    """Parts of a template: ("word", w), ("any", low, high) and ("optional", parts)."""
    stack: list[list] = [[]]
    for part in re.split(r"(<<[^>]*>>)", template):
        if part == "<<beginOptional>>":
            stack.append([])
        elif part == "<<endOptional>>":
            inner = stack.pop()
            if not stack:
                raise ValueError(f"endOptional without beginOptional: {template}")
            stack[-1].append(("optional", inner))
        elif m := re.fullmatch(r"<<var;words=(\d+)\.\.(\d+)>>", part):
            stack[-1].append(("any", int(m[1]), int(m[2])))
        elif part.startswith("<<"):
            raise ValueError(f"unknown markup {part}")
        else:
            stack[-1] += [("word", w) for w in re.findall(WORD, part.lower().encode())]
    if len(stack) > 1:
        raise ValueError(f"beginOptional without endOptional: {template}")
    return stack[0]


class Automaton:
    """Word edges by state, any-word edges by state, empty edges by state; it accepts in its last state."""

    def __init__(self, parts: list[tuple]):
        self.words: list[dict] = [{}]
        self.any: list[set] = [set()]
        self.empty: list[set] = [set()]
        self.last = self._add(parts, 0)

    def _state(self) -> int:
        for x, new in ((self.words, {}), (self.any, set()), (self.empty, set())):
            x.append(new)
        return len(self.words) - 1

    def _add(self, parts: list[tuple], at: int) -> int:
        for part in parts:
            if part[0] == "word":
                self.words[at][part[1]] = at = self._state()
            elif part[0] == "any":
                skips = []
                for n in range(part[2]):
                    if n >= part[1]:
                        skips.append(at)
                    before, at = at, self._state()
                    self.any[before].add(at)
                for s in skips:
                    self.empty[s].add(at)
            else:
                before, at = at, self._add(part[1], at)
                if before != at:
                    self.empty[before].add(at)
        return at

    def closure(self, states: set) -> set:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return seen

    def first_words(self) -> set:
        return {w for s in self.closure({0}) for w in self.words[s]}

    def match(self, words: list[bytes], at: int) -> int | None:
        """The end of the longest match that starts at word `at`, or None."""
        states, end = self.closure({0}), None
        while states:
            if self.last in states:
                end = at
            if at >= len(words):
                break
            w = words[at]
            states = self.closure({self.words[s][w] for s in states if w in self.words[s]} | {x for s in states for x in self.any[s]})
            at += 1
        return end


def mandatory(parts: list[tuple]) -> list[bytes]:
    return [p[1] for p in parts if p[0] == "word"]


class Scanner:
    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        self.phrases = [(tuple(re.findall(WORD, p.encode())), label) for p, label in phrases]
        self.near = [re.compile((GAP + b"+").join(map(re.escape, words))).search for words, _ in self.phrases]
        self.templates = []
        for label, text in templates:
            parts = parse(text)
            words = mandatory(parts)
            if not words:
                raise ValueError(f"a template without mandatory words: {text}")
            # A text that lacks the template's longest mandatory word can't match.
            self.templates.append((label, Automaton(parts), max(words, key=len)))
        self.anchors = sorted({anchor for _, _, anchor in self.templates})
        self.anchored = re.compile(b"|".join(map(re.escape, sorted(self.anchors, key=len, reverse=True)))).search
        self.starts = [a.first_words() for _, a, _ in self.templates]
        self.find = re.compile(WORD).findall
        self.count = re.compile(GAP + b"+")
        self.table = bytes(32 if re.fullmatch(GAP, bytes([b])) else b for b in range(256))

    def __call__(self, text: bytes) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score."""
        low = text.lower()
        words = low.translate(self.table).split(b" ")
        if b"" in words:
            words = [w for w in words if w]
        places, base, found = [], set(), set()
        if any(near(low) for near in self.near):
            for phrase, label in self.phrases:
                n = len(phrase)
                here = [i for i, w in enumerate(words) if w == phrase[0] and tuple(words[i : i + n]) == phrase]
                places += here
                base |= {label} if here else set()
        held = {a for a in self.anchors if a in low} if self.anchored(low) else ()
        if held:
            for (label, automaton, anchor), starts in zip(self.templates, self.starts):
                if anchor in held and label not in found and any(w in starts and automaton.match(words, i) is not None for i, w in enumerate(words)):
                    found.add(label)
        score = 1.0 if found else 0.5 if base else 0.0
        return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | found)), score


COLUMNS = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(documents: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """Base phrases and licence templates in every row of (doc_id, text).

    score: 1 if a template is accepted, 0.5 if only base phrases are found, else 0.
    A null or empty text has no words, no labels (empty strings) and null places.
    Phrases count at every place, overlaps included.  Repeated rows come back
    each, null doc_ids stay null, texts are read whole, extra columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        for batch in batches:
            found = [scanner(t.as_py() or b"") for t in batch.column(1).cast(pa.binary())]
            columns = zip(*found) if found else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    return pick(documents, doc_id="long", text="string").mapInArrow(run, COLUMNS)


def pattern(template: str) -> str:
    """A regular expression for the template over words that are each preceded by a space."""

    def of(parts: list[tuple]) -> str:
        out = ""
        for p in parts:
            if p[0] == "word":
                out += " " + p[1].decode()
            elif p[0] == "any":
                out += "( [^ ]+){%d,%d}" % p[1:]
            else:
                out += f"({of(p[1])})?"
        return out

    return of(parse(template)) + " "
