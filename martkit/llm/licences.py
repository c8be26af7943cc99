"""Licence scan: matching statistics of a generalised suffix automaton.

One automaton holds the token sequences of every template. A file's words are
streamed through it; at each word the automaton knows the longest suffix of
the words read so far that occurs in some template (the matching statistic).
The longest matches of each template, found by suffix links and whether or not
another template goes on, become anchors (file place, template place), chained
in order with bounded gaps; a chain that covers enough of its template is a
template span. The base phrases are templates too: a phrase stands wherever
the current match ends with all of its words.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, table

#: Phrases that carry a base label wherever their words stand consecutively.
PHRASES: dict[str, str] = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Terms and notices of well-known public licences.
TEMPLATES: dict[str, str] = {
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy
        of this software and associated documentation files (the "Software"), to deal in the
        Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in
        all copies or substantial portions of the Software.""",
    "apache-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may
        not use this file except in compliance with the License. You may obtain a copy of the
        License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
        or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
        See the License for the specific language governing permissions and limitations under
        the License.""",
    "gpl-notice": """This program is free software: you can redistribute it and/or modify it under
        the terms of the GNU General Public License as published by the Free Software
        Foundation, either version 3 of the License, or (at your option) any later version.
        This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
        PARTICULAR PURPOSE.""",
    "bsd-text": """Redistribution and use in source and binary forms, with or without modification,
        are permitted provided that the following conditions are met: Redistributions of source
        code must retain the above copyright notice, this list of conditions and the following
        disclaimer.""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any purpose
        with or without fee is hereby granted, provided that the above copyright notice and
        this permission notice appear in all copies.""",
    "mit-warranty": """The software is provided "as is", without warranty of any kind, express or
        implied, including but not limited to the warranties of merchantability, fitness for a
        particular purpose and noninfringement. In no event shall the authors or copyright
        holders be liable for any claim, damages or other liability, whether in an action of
        contract, tort or otherwise, arising from, out of or in connection with the software or
        the use or other dealings in the software.""",
    "bsd-2-clause": """Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution.""",
    "bsd-3-clause": """Neither the name of the copyright holder nor the names of its contributors may
        be used to endorse or promote products derived from this software without specific prior
        written permission.""",
    "bsd-warranty": """This software is provided by the copyright holders and contributors "as is" and
        any express or implied warranties, including, but not limited to, the implied warranties
        of merchantability and fitness for a particular purpose are disclaimed. In no event shall
        the copyright holder or contributors be liable for any direct, indirect, incidental,
        special, exemplary, or consequential damages (including, but not limited to, procurement
        of substitute goods or services; loss of use, data, or profits; or business interruption)
        however caused and on any theory of liability, whether in contract, strict liability, or
        tort (including negligence or otherwise) arising in any way out of the use of this
        software, even if advised of the possibility of such damage.""",
    "lgpl-notice": """This library is free software; you can redistribute it and/or modify it under the
        terms of the GNU Lesser General Public License as published by the Free Software
        Foundation; either version 2.1 of the License, or (at your option) any later version.""",
    "agpl-notice": """you can redistribute it and/or modify it under the terms of the GNU Affero
        General Public License as published by the Free Software Foundation, either version 3 of
        the License, or (at your option) any later version.""",
    "mpl-notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v.
        2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
        http://mozilla.org/MPL/2.0/.""",
    "epl-notice": """This program and the accompanying materials are made available under the terms of
        the Eclipse Public License 2.0 which is available at
        https://www.eclipse.org/legal/epl-2.0/""",
    "unlicense-text": """This is free and unencumbered software released into the public domain. Anyone
        is free to copy, modify, publish, use, compile, sell, or distribute this software, either
        in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means.""",
    "zlib-text": """This software is provided 'as-is', without any express or implied warranty. In no
        event will the authors be held liable for any damages arising from the use of this
        software. Permission is granted to anyone to use this software for any purpose, including
        commercial applications, and to alter it and redistribute it freely, subject to the
        following restrictions""",
    "cc0-text": """To the extent possible under law, the author has waived all copyright and related or
        neighboring rights to this work""",
    "cc-by-work": "This work is licensed under the Creative Commons Attribution 4.0 International License",
    "cc-by-sa-work": """This work is licensed under the Creative Commons Attribution-ShareAlike 4.0
        International License""",
    "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "cc-by-nd": "Licensed under CC BY-ND 4.0",
    "mit-line": "Released under the MIT License",
    "apache-line": "Licensed under the Apache License, Version 2.0",
    "gpl-line": "This work is licensed under the GNU General Public License, version 3",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by": "Licensed under CC BY 4.0",
    "all-rights-reserved": "All rights reserved",
}

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: str) -> list[bytes]:
    """Words of the text with A-Z lower-cased: runs of [0-9a-z] and non-ASCII characters."""
    return _WORD.findall(text.encode().lower())  # bytes.lower() changes A-Z only


@dataclass
class Automaton:
    """Generalised suffix automaton over the words of labelled templates."""

    vocab: dict[bytes, int] = field(default_factory=dict)
    go: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    places: list[set[tuple[int, int]]] = field(default_factory=lambda: [set()])
    phrases: list[tuple[tuple[int, str], ...]] = field(default_factory=list)
    templates: list[tuple[str, int]] = field(default_factory=list)  # (label, words)
    bodies: list[list[int]] = field(default_factory=list)  # each template's words
    ended: dict = field(default_factory=dict)  # results of ``ends``

    @classmethod
    def build(cls, templates: Mapping[str, str], phrases: Mapping[str, str]) -> "Automaton":
        self = cls()
        for label, text in templates.items():
            self._add(label, words(text))
        n_templates = len(self.templates)
        ends = {}
        for phrase, label in phrases.items():
            ends[self._add(label, words(phrase))] = (len(words(phrase)), label)
        self._spread_places(n_templates)
        self.templates = self.templates[:n_templates]
        order = sorted(range(len(self.go)), key=self.length.__getitem__)
        found: dict[int, tuple] = {0: ()}
        for v in order[1:]:
            own = ((ends[v],) if v in ends else ())
            found[v] = found[self.link[v]] + own
        self.phrases = [found[v] for v in range(len(self.go))]
        return self

    def _state(self, length: int) -> int:
        self.go.append({})
        self.link.append(-1)
        self.length.append(length)
        self.places.append(set())
        return len(self.go) - 1

    def _clone(self, p: int, q: int, c: int) -> int:
        twin = self._state(self.length[p] + 1)
        self.go[twin] = dict(self.go[q])
        self.link[twin] = self.link[q]
        self.link[q] = twin
        while p >= 0 and self.go[p].get(c) == q:
            self.go[p][c] = twin
            p = self.link[p]
        return twin

    def _add(self, label: str, seq: Sequence[bytes]) -> int:
        """Insert one word sequence; returns the state of the whole sequence."""
        which, last = len(self.templates), 0
        self.templates.append((label, len(seq)))
        self.bodies.append([])
        for end, word in enumerate(seq, 1):
            c = self.vocab.setdefault(word, len(self.vocab))
            self.bodies[-1].append(c)
            if c in self.go[last]:
                q = self.go[last][c]
                cur = q if self.length[q] == self.length[last] + 1 else self._clone(last, q, c)
            else:
                cur, p = self._state(self.length[last] + 1), last
                while p >= 0 and c not in self.go[p]:
                    self.go[p][c] = cur
                    p = self.link[p]
                if p < 0:
                    self.link[cur] = 0
                else:
                    q = self.go[p][c]
                    self.link[cur] = (q if self.length[q] == self.length[p] + 1
                                      else self._clone(p, q, c))
            self.places[cur].add((which, end))
            last = cur
        return last

    def _spread_places(self, n_templates: int) -> None:
        """Every state gets the (template, end) places of its strings; phrases have none."""
        for v in sorted(range(1, len(self.go)), key=self.length.__getitem__, reverse=True):
            self.places[v] = {p for p in self.places[v] if p[0] < n_templates}
            if self.link[v] > 0:
                self.places[self.link[v]] |= self.places[v]

    def scan(self, seq: Sequence[bytes], min_match: int):
        """(phrase hits, maximal matches) of a word sequence.

        Phrase hits are (start, label); matches are (end, length, state, next
        word) for every statistic of ``min_match`` or more that the next word does
        not extend in some template that holds it or a suffix of it.
        """
        vocab, go, link, length, phrases = (self.vocab.get, self.go, self.link, self.length,
                                            self.phrases)
        hits, matches = [], []
        state = size = 0
        for i, c in enumerate(map(vocab, seq)):
            if size >= min_match and self.ends(state, c, min_match):
                matches.append((i, size, state, c))
            if c is None:
                state = size = 0
                continue
            nxt = go[state].get(c)
            if nxt is None:
                while nxt is None and state:
                    state = link[state]
                    size = length[state]
                    nxt = go[state].get(c)
                if nxt is None:
                    size = 0
                    continue
            state, size = nxt, size + 1
            for n, label in phrases[state]:
                if n <= size:
                    hits.append((i + 1 - n, label))
        if size >= min_match:
            matches.append((len(seq), size, state, None))
        return hits, matches

    def ends(self, state: int, c: int | None, min_match: int):
        """(length, template, end) of the matches that end in ``state`` before the word ``c``.

        Each place of a template is matched by the longest suffix that stands
        there, by suffix links; places that ``c`` extends are left out. The
        length is 0 for the whole of the statistic.
        """
        known = self.ended.get((state, c, min_match))
        if known is None:
            known, seen, v = [], set(), state
            while v > 0 and (v == state or self.length[v] >= min_match):
                for which, at in sorted(self.places[v] - seen):
                    body = self.bodies[which]
                    if at == len(body) or body[at] != c:
                        known.append((0 if v == state else self.length[v], which, at))
                seen |= self.places[v]
                v = self.link[v]
            self.ended[state, c, min_match] = known
        return known

    def spans(self, matches, max_gap: int, min_cover: float, min_match: int = 1):
        """Chain matches into (label, first word, last word, coverage) template spans.

        Anchors of a template are chained left to right in file and template
        alike, with at most ``max_gap`` words between neighbours in the file;
        chains are taken best first, without overlap in the file.
        """
        anchors = defaultdict(list)
        for end, size, state, c in matches:
            for n, which, at in self.ends(state, c, min_match):
                n = n or size
                anchors[which].append((end - n, end, at - n, at))
        out = []
        for which, found in anchors.items():
            label, total = self.templates[which]
            found.sort()
            best, back = [], []
            for i, (s, e, ts, te) in enumerate(found):
                top, via, j = e - s, -1, i - 1
                while j >= 0 and found[j][0] + total + max_gap >= s:
                    ps, pe, pts, pte = found[j]
                    lap = max(0, pe - s, pte - ts)  # words counted by the earlier anchor
                    if ps < s and pts < ts and e > pe and te > pte and s - pe <= max_gap:
                        if best[j] + (e - s) - lap > top:
                            top, via = best[j] + (e - s) - lap, j
                    j -= 1
                best.append(top)
                back.append(via)
            used = set()
            for i in sorted(range(len(found)), key=lambda i: (-best[i], found[i][1])):
                if best[i] < min_cover * total:
                    break
                chain, j = [], i
                while j >= 0 and j not in used:
                    chain.append(j)
                    j = back[j]
                if j >= 0 or not chain:  # it runs into a chain that is taken
                    used.update(chain)
                    continue
                used.update(chain)
                out.append((label, found[chain[-1]][0], found[i][1] - 1,
                            min(1.0, best[i] / total)))
        return sorted(out, key=lambda x: (x[1], x[2], x[0]))


SCHEMA = ("n_words long, phrase_starts array<long>, phrase_labels array<string>, "
          "spans array<struct<label:string,first_word:long,last_word:long,coverage:double>>")


def scan_licences(df: DataFrame, text: str = "text", *,
                  templates: Mapping[str, str] = TEMPLATES,
                  phrases: Mapping[str, str] = PHRASES, min_match: int = 3,
                  max_gap: int = 8, min_cover: float = 0.8,
                  keep: Sequence[str] | None = None) -> DataFrame:
    """Append word count, phrase places and covered template spans of each text.

    Null and empty texts have no words and no spans. Equal rows get equal
    results. The automaton's size depends on the templates only, so it is
    built in every task; the text is streamed through it in one pass.
    """
    array = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()),
                                ("last_word", pa.int64()), ("coverage", pa.float64())]))
    names = ("label", "first_word", "last_word", "coverage")

    def make():
        auto = Automaton.build(templates, phrases)

        def work(texts: pa.Array):
            n, starts, labels, spans = [], [], [], []
            for t in texts:
                seq = words(t.as_py())
                hits, matches = auto.scan(seq, min_match)
                n.append(len(seq))
                starts.append([h[0] for h in hits])
                labels.append([h[1] for h in hits])
                spans.append([dict(zip(names, s))
                              for s in auto.spans(matches, max_gap, min_cover, min_match)]
                             if matches else [])
            return [pa.array(n, pa.int64()), pa.array(starts, pa.list_(pa.int64())),
                    pa.array(labels, pa.list_(pa.string())), pa.array(spans, array)]

        return work

    return add_columns(df, text, SCHEMA, make, keep)


def op3_licence_scan(spark, sf_dir: str) -> DataFrame:
    """Base phrases, template labels and the best coverage of every document."""
    found = scan_licences(table(spark, sf_dir, "documents"), keep=["doc_id"])
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    span_labels = F.transform("spans", lambda s: s["label"])
    return found.select(
        "doc_id", "n_words", F.size("phrase_starts").cast("long").alias("n_base"),
        F.array_min("phrase_starts").alias("first_word"),
        F.array_max("phrase_starts").alias("last_word"),
        joined(F.col("phrase_labels")).alias("base_labels"),
        joined(F.concat("phrase_labels", span_labels)).alias("labels"),
        F.when(F.size("phrase_starts") > 0, 1.0).otherwise(
            F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0))
        ).alias("score"))
