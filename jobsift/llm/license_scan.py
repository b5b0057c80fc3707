"""License scans: patience alignment of texts with license templates.

Words are runs of ASCII letters and digits, lower-cased. A template's key
words vote for where in the text it would start. A copy that can count has a
certain number of different key words voting for starts within a certain
distance (``Scanner.reach``), so every start with so many about it is tried,
those with most votes first, as voted and with some room; then the text left beside the
matches is searched again, until nothing more is found. A range is
aligned with the template by patience: words that
occur once in both are anchors, their longest increasing subsequence is
matched, and the gaps between matches are aligned in the same way (equal words
at either end of a gap are matched first). Coverage is the matched share of
the template, density the matched share of the text between the first and last
match; a range counts with both at ``LEAST`` or more. Of overlapping matches
the better one stays (coverage times density, then the longer template, then the name).

Each document is scanned whole, in the task that reads it, without a shuffle;
its matches are rows of their own. Defined results: null, empty and wordless texts
have no match; repeated rows repeat their matches; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from jobsift.llm.common import arrow_rows, arrow_schema, quoted

LEAST = 0.8
WORD = re.compile(rb"[a-z0-9]+")
# fixed values: notices as their publishers word them
TEMPLATES = {
    "Apache-2.0 (line)": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 (notice)": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations under
        the License.""",
    "BSD (redistribution)": """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met""",
    "CC-BY-4.0 (line)": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0 (line)": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 (line)": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0 (line)": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0 (line)": "This work is licensed under the GNU General Public License, version 3.",
    "GPL (notice)": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "MIT (line)": "Released under the MIT License.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software.""",
}
COMMON = frozenset(b"a above all and any are as at be but by can do either for from in is it may met not of on or see "
                   b"shall so the this to use whom will with without work you your".split())


def words_of(text: str | bytes | None) -> list[bytes]:
    raw = text.encode("utf-8", "replace") if isinstance(text, str) else text or b""
    return WORD.findall(raw.lower())


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs, sorted by the first number, whose second numbers rise (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []  # index of each pile's top pair
    back = []
    for k, (_, b) in enumerate(pairs):
        at = bisect_left(tops, b)
        back.append(piles[at - 1] if at else -1)
        if at == len(tops):
            tops.append(b)
            piles.append(k)
        else:
            tops[at], piles[at] = b, k
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def patience(text: list[bytes], template: list[bytes]) -> list[tuple[int, int]]:
    """Matched (text position, template position) pairs, both rising."""
    out = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {w: k for k, w in enumerate(template[c:d], c) if there[w] == 1 and here.get(w) == 1}
        anchors = increasing([(k, place[w]) for k, w in enumerate(text[a:b], a) if w in place])
        if not anchors:
            continue
        out += anchors
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        todo += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(edges, edges[1:])]
    return sorted(out)


class Scanner:
    def __init__(self, templates: dict[str, str], least: float = LEAST):
        self.least = least
        self.words = {name: words_of(t) for name, t in templates.items()}
        self.at: dict[bytes, list[tuple[str, int]]] = {}
        self.reach = {}  # template -> (different key words that a match has at least, how far their starts lie apart at most)
        for name, words in self.words.items():
            keys = [(w, k) for k, w in enumerate(words) if w not in COMMON]
            # coverage leaves out so many words of the template, density lets in so many others
            out, more = int((1 - least) * len(words) + 1e-9), int((1 - least) / least * len(words)) + 1
            self.reach[name] = max(1, len(keys) - out), out + more
            for w, k in keys:
                self.at.setdefault(w, []).append((name, k))

    def align(self, name: str, words: list[bytes], a: int, b: int) -> tuple | None:
        """(rank, coverage, density, first, last) of the template's match in a range of the text, if it counts."""
        template = self.words[name]
        pairs = patience(words[a:b], template)
        if pairs:
            first, last = pairs[0][0] + a, pairs[-1][0] + a
            coverage, density = len(pairs) / len(template), len(pairs) / (last - first + 1)
            if coverage >= self.least and density >= self.least:
                return coverage * density, coverage, density, first, last
        return None

    def starts(self, name: str, votes: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
        """(-votes, start, first and last start about it) of the starts with enough different key words about them."""
        need, apart = self.reach[name]
        found = sorted((k - offset, offset) for k, offset in votes)
        out, about, low, high, at = [], Counter(), 0, 0, 0
        while at < len(found):
            start, here = found[at][0], at
            while at < len(found) and found[at][0] == start:
                at += 1
            while high < len(found) and found[high][0] <= start + apart:
                about[found[high][1]] += 1
                high += 1
            while found[low][0] < start - apart:
                about[found[low][1]] -= 1
                if not about[found[low][1]]:
                    del about[found[low][1]]
                low += 1
            if len(about) >= need:
                out.append((here - at, start, found[low][0], found[high - 1][0]))
        return sorted(out)

    def search(self, name: str, words: list[bytes], votes: list[tuple[int, int]]) -> list[tuple]:
        """All matches of a template, none over another; votes are (text position, template position) of key words."""
        size, (need, apart) = len(self.words[name]), self.reach[name]
        out, todo = [], [(0, len(words), votes)]
        while todo:
            a, b, part = todo.pop()
            spans: list[tuple[int, int]] = []
            for _, start, low, high in self.starts(name, part):
                middle = start + size // 2
                at = bisect_left(spans, (middle + 1,))
                if at and spans[at - 1][1] >= middle:
                    continue
                left = spans[at - 1][1] + 1 if at else a
                right = spans[at][0] if at < len(spans) else b
                best, tried = None, set()
                # as voted, then with room on both sides or one: a neighbouring copy in the room can leave no word unique
                for x, y in ((start, start + size), (low, high + size), (start, start + size + apart), (start - apart, start + size)):
                    x, y = max(left, x), min(right, y)
                    if y - x < need or (x, y) in tried or best and best[0] == 1:
                        continue
                    tried.add((x, y))
                    best = max(filter(None, (best, self.align(name, words, x, y))), default=None)
                if best:
                    out.append(best)
                    insort(spans, best[3:])
            if spans:
                for x, y in zip([a, *(last + 1 for _, last in spans)], [*(first for first, _ in spans), b]):
                    rest = part[bisect_left(part, (x,)):bisect_left(part, (y,))]
                    if len(rest) >= need:
                        todo.append((x, y, rest))
        return out

    def scan(self, text: str | bytes | None) -> list[tuple[str, float, float, int, int]]:
        """(license, coverage, density, first word, last word) of each match, in text order."""
        words = words_of(text)
        votes: dict[str, list[tuple[int, int]]] = {}
        for k, w in enumerate(words):
            for name, offset in self.at.get(w, ()):
                votes.setdefault(name, []).append((k, offset))
        found = []
        for name, part in votes.items():
            if len(part) >= self.reach[name][0]:
                found += [(-rank, -len(self.words[name]), name, first, last, coverage, density)
                          for rank, coverage, density, first, last in self.search(name, words, part)]
        kept: list[tuple] = []  # in text order, none over another
        for _, _, name, first, last, coverage, density in sorted(found):
            at = bisect_left(kept, (last + 1,))
            if not at or kept[at - 1][1] < first:
                kept.insert(at, (first, last, name, coverage, density))
        return [(name, coverage, density, first, last) for first, last, name, coverage, density in kept]


MATCHES = "doc_id long, license string, coverage double, density double, first_word long, last_word long"


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per match: doc_id, license, coverage, density, first_word, last_word (0-based word positions)."""
    templates = TEMPLATES if templates is None else templates
    schema: pa.Schema = arrow_schema(MATCHES)

    def run(batches):
        scanner = Scanner(templates, least)
        rows = ((doc_id, *m) for batch in batches
                for doc_id, raw in zip(*(c.to_pylist() for c in batch.columns)) for m in scanner.scan(raw))
        return arrow_rows(rows, schema)

    return docs.select(quoted(id_col).cast("long").alias("doc_id"),
                       quoted(text_col).cast("string").cast("binary").alias("body")).mapInArrow(run, MATCHES)


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
