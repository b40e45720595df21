"""License scans: matching statistics against a generalised suffix automaton.

All license templates go into one suffix automaton over words. A text streams through it
once; after each word the automaton holds the longest run of words that ends there and
stands in some template (the matching statistics). Long runs that cannot be grown are then
chained, template by template, into spans: a run may stand at several places of a template, and
the chain of most matched words, in order on both sides, is found by dynamic programming. A span
whose matched words make up enough of the template gives its label; where those of
several templates lie on each other, the one that is covered best. Phrases that must be found wherever they stand are templates
too, and are read off the same states.
"""

from __future__ import annotations

import bisect
import functools
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame

from .text import bytes_of, id_and_text, in_batches, words

# The phrases looked for at every place, with their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Notices of public licenses, as their authors word them.
TEMPLATES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software."
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version. This program is distributed in the hope that it will be useful, "
        "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version. This library is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU Affero General Public License for more details."
    ),
    "epl": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
        "be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
        "use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
}

#: Words that a match must have to be chained, and words that two links of a chain may lie apart.
LEAST_MATCH, MOST_GAP = 4, 16
#: Share of a template's words that a chain must match for the label.
LEAST_COVER = 0.5


class Automaton:
    """A generalised suffix automaton of word sequences.

    ``ends[state]`` says for each sequence that holds the state's words at which words they end in
    it, all of them in order; ``phrases[state]`` which phrases end the state's words.
    """

    def __init__(self, templates: Mapping[str, str], phrases: Mapping[str, str]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        self.ends: list[dict[int, tuple[int, ...]]] = [{}]
        self.ids: dict[bytes, int] = {}
        self.names, self.lengths = list(templates), []
        for k, text in enumerate(templates.values()):
            tokens = [self.ids.setdefault(w, len(self.ids)) for w in words(text.encode())]
            self.lengths.append(len(tokens))
            self._add(tokens, k)
        own = []
        for text, label in phrases.items():
            tokens = [self.ids.setdefault(w, len(self.ids)) for w in words(text.encode())]
            own.append((tokens, label))
            self._add(tokens, None)
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            above = self.ends[self.link[state]]
            for k, ends in self.ends[state].items():
                above[k] = tuple(sorted({*ends, *above.get(k, ())}))
        holds: list[list[tuple[int, str]]] = [[] for _ in self.size]
        for tokens, label in own:
            state = 0
            for t in tokens:
                state = self.next[state][t]
            holds[state].append((len(tokens), label))
        self.phrases: list[tuple[tuple[int, str], ...]] = [()] * len(self.size)
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__):
            self.phrases[state] = (*self.phrases[self.link[state]], *holds[state])

    def _state(self, size: int, link: int, moves: dict[int, int]) -> int:
        self.size.append(size)
        self.link.append(link)
        self.next.append(moves)
        self.ends.append({})
        return len(self.size) - 1

    def _split(self, state: int, to: int, token: int) -> int:
        """The state of (longest words of ``state``) + token, cut off ``to`` if that holds longer words."""
        if self.size[to] == self.size[state] + 1:
            return to
        copy = self._state(self.size[state] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = copy
        while state >= 0 and self.next[state].get(token) == to:
            self.next[state][token] = copy
            state = self.link[state]
        return copy

    def _add(self, tokens: list[int], sequence: int | None) -> None:
        last = 0
        for end, token in enumerate(tokens):
            if token in self.next[last]:
                last = self._split(last, self.next[last][token], token)
            else:
                new, state = self._state(self.size[last] + 1, 0, {}), last
                while state >= 0 and token not in self.next[state]:
                    self.next[state][token] = new
                    state = self.link[state]
                if state >= 0:
                    self.link[new] = self._split(state, self.next[state][token], token)
                last = new
            if sequence is not None:
                self.ends[last][sequence] = (*self.ends[last].get(sequence, ()), end)

    def stream(self, text: list[bytes]) -> tuple[list[tuple[int, int, int]], list[tuple[int, str]]]:
        """Matches that cannot be grown, as (start, end, state), and phrases, as (start, label)."""
        move, link, size, phrases, ids = self.next, self.link, self.size, self.phrases, self.ids
        matches, found = [], []
        state = length = 0
        for i, token in enumerate(map(ids.get, text)):
            if token is None:
                if length:
                    if length >= LEAST_MATCH:
                        matches.append((i - length, i, state))
                    state = length = 0
                continue
            to = move[state].get(token)
            if to is None:
                if length >= LEAST_MATCH:
                    matches.append((i - length, i, state))
                while to is None and state:
                    state = link[state]
                    length = size[state]
                    to = move[state].get(token)
                if to is None:
                    continue
            state = to
            length += 1
            for words_in, label in phrases[state]:
                if length >= words_in:
                    found.append((i + 1 - words_in, label))
        if length >= LEAST_MATCH:
            matches.append((len(text) - length, len(text), state))
        return matches, found

    def spans(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, int]]:
        """Chains of one template's matches, in order on both sides, that cover enough of it:
        (label, first word, word after the last, matched words). Chains of one template never
        overlap, and of chains of several templates that share over half of the shorter one the
        better covered stays."""
        of_template: dict[int, list[tuple[int, int, tuple[int, ...]]]] = {}
        for start, end, state in matches:
            for k, places in self.ends[state].items():
                of_template.setdefault(k, []).append((start, end, places))
        found = []
        for k, own in of_template.items():
            # the best chain that ends with each match at each of its places in the template
            chains: list[tuple[int, int, int, int]] = []  # first word, word after the last, place, matched
            for start, end, places in own:
                near = []
                for chain in reversed(chains):
                    if chain[1] < start - MOST_GAP:
                        break  # matches come in the order of their ends
                    near.append(chain)
                for place in places:
                    best = (start, end, place, end - start)
                    for first, stop, before, matched in near:
                        new = end - max(start, stop)
                        if stop < end and place - before >= new and matched + new > best[3]:
                            best = (first, end, place, matched + new)
                    chains.append(best)
            taken: list[tuple[int, int]] = []
            for first, stop, _, matched in sorted(chains, key=lambda c: (-c[3], c[0])):
                if matched < LEAST_COVER * self.lengths[k]:
                    break
                at = bisect.bisect(taken, (first, stop))
                if (at == 0 or taken[at - 1][1] <= first) and (at == len(taken) or taken[at][0] >= stop):
                    taken.insert(at, (first, stop))
                    found.append((matched / self.lengths[k], matched, k, first, stop))
        kept: list[tuple[int, int]] = []
        done = []
        for _, matched, k, first, stop in sorted(found, key=lambda f: (-f[0], -f[1], f[2], f[3])):
            at = bisect.bisect(kept, (first, stop))
            if all(2 * (min(stop, b) - max(first, a)) <= min(stop - first, b - a) for a, b in kept[max(0, at - 2):at + 2]):
                kept.insert(at, (first, stop))
                done.append((self.names[k], first, stop, matched))
        return sorted(done, key=lambda s: s[1:])


@functools.cache
def automaton(templates: tuple[tuple[str, str], ...] | None = None) -> Automaton:
    """The automaton of templates ``(label, text)``, by default of all above, once for a worker."""
    return Automaton(TEMPLATES if templates is None else dict(templates), PHRASES)


def scan(text: bytes, templates: tuple[tuple[str, str], ...] | None = None) -> dict:
    """What ``license_spans`` gives of one text."""
    found = words(text)
    own = automaton(templates)
    matches, phrases = own.stream(found)
    spans = own.spans(matches) if matches else []
    sizes = {label: len(phrase.split()) for phrase, label in PHRASES.items()}
    covered = 0
    upto = 0
    for start, end in sorted([(s[1], s[2]) for s in spans] + [(s, s + sizes[label]) for s, label in phrases]):
        covered += max(0, end - max(start, upto))
        upto = max(upto, end)
    base = {label for _, label in phrases}
    starts = [s for s, _ in phrases]
    return {
        "n_words": len(found), "n_base": len(phrases),
        "first_word": min(starts, default=None), "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | {s[0] for s in spans})),
        "score": covered / len(found) if found else 0.0,
        "spans": [dict(zip(("label", "start", "stop", "matched"), s)) for s in spans],
    }


_SPAN = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("matched", pa.int64())]))
_TYPES = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
    "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": _SPAN,
}
_SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, spans array<struct<label: string, start: long, stop: long, matched: long>>"
)


def license_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Mapping[str, str] | None = None,
) -> DataFrame:
    """License phrases and covered template spans of every whole text.

    ``templates`` are notices by label (a small table; ``TEMPLATES`` if none are given). ``n_base`` counts all places of ``PHRASES``, ``first_word`` and ``last_word`` are their
    first and last starting words; ``spans`` are the covered stretches of ``TEMPLATES`` in
    words, ``labels`` those of both, ``score`` the share of the text's words they cover.
    Null, empty and wordless texts have no words, no labels and the score 0. One row a row;
    rows with equal or null ids stay separate; other columns are not read.
    """
    table = None if templates is None else tuple(templates.items())

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [scan(t, table) for t in bytes_of(batch.column(1))]
            made = [pa.array([r[n] for r in rows], kind) for n, kind in _TYPES.items()]
            return pa.RecordBatch.from_arrays([batch.column(0), *made], ["doc_id", *_TYPES])

        return step

    return in_batches(id_and_text(docs, id_col, text_col), _SCHEMA, start)
