"""License scan by patience alignment of documents with license notices.

A document is compared with a template only where it has enough of the template's rarer words: each place of such a word
with as many others behind it as the coverage demands is aligned in a few windows of about the template's length, so a long
text costs one pass and a few short alignments, and copies of a notice in a row are found one by one. In a window, patience
alignment anchors on the words that occur once in both the window and the template, keeps the longest increasing subsequence
of these anchors, and aligns the gaps between neighbouring anchors the same way; a gap without anchors is closed by equal
words at either end. Coverage is the share of the template's words that are aligned.

Templates are a parameter: a bounded list of (id, text), shipped with the task; if none are given, the short notices below
and the whole licenses of ``license_texts``. Defined results: null or empty text and
templates without a word match nothing; several windows may report the same license; the spans of one template do not
overlap; of templates covering the same words, the one with more aligned words, less its missing and the foreign ones, is
reported, then the first id. Rows are
independent of each other, repeated rows get equal results; long texts are read whole; an empty table gives no rows; other
columns pass through.
"""
from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from math import ceil
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import read, ship_by_value

ship_by_value(__name__)

COVERAGE = 0.8
# The usual notices and opening clauses of common licenses, as published with them. ``whole_texts`` has the
# licenses themselves.
TEMPLATES = (
    ("AGPL-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
     "License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at"),
    ("BSD-opening", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0-header", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation; either version 2 of the License, or "
     "(at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of the "
     "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
     "your option) any later version."),
    ("LGPL-2.1-header", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
     "License, or (at your option) any later version."),
    ("LGPL-3.0-header", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
     "License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
)
LONG = 100                   # words from which a template is long
# Words too common in running text to start a window.
COMMON = frozenset("a an and any are as at be by can for from if in is it may not of on or that the this to under use with "
                   "you your".split())
_WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")


def whole_texts() -> tuple[tuple[str, str], ...]:
    """(license, text) of the whole licenses that lie beside this module, read by the driver."""
    return tuple((p.stem, p.read_text("utf-8")) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt")))


def tokens(text: str) -> list[tuple[str, int, int]]:
    """(word, start, stop): lower-case words with inner dots and hyphens."""
    low = "".join(c.lower() if c < "\x80" else c for c in text) if not text.isascii() else text.lower()
    return [(m.group(), m.start(), m.end()) for m in _WORD.finditer(low)]


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned positions (of a, of b), increasing in both."""
    out, stack = [], [(0, len(a), 0, len(b))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:           # equal words at either end
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a, once_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at_b = {b[j]: j for j in range(b0, b1) if once_b[b[j]] == 1}
        pairs = [(i, at_b[a[i]]) for i in range(a0, a1) if once_a[a[i]] == 1 and a[i] in at_b]
        if not pairs:
            continue
        tops, piles, back = [], [], []                          # longest increasing subsequence by piles
        for k, (_, j) in enumerate(pairs):
            p = bisect_left(tops, j)
            back.append(piles[p - 1] if p else -1)
            if p == len(tops):
                tops.append(j), piles.append(k)
            else:
                tops[p], piles[p] = j, k
        chain, k = [], piles[-1]
        while k >= 0:
            chain.append(pairs[k])
            k = back[k]
        chain.reverse()
        out += chain
        edges = [(a0 - 1, b0 - 1), *chain, (a1, b1)]
        stack += [(i + 1, i2, j + 1, j2) for (i, j), (i2, j2) in zip(edges, edges[1:])]
    return sorted(out)


class Scanner:
    def __init__(self, templates=None, coverage: float = COVERAGE):
        templates = TEMPLATES + whole_texts() if templates is None else templates
        self.coverage = coverage
        self.templates = [(n, [w for w, _, _ in tokens(t)]) for n, t in templates]
        self.templates = [(n, w) for n, w in self.templates if w]
        # Words that may be missing, and the words to look for: a notice always has some of them.
        self.spare = [len(w) - max(1, ceil(coverage * len(w))) for _, w in self.templates]
        self.keys = [k if sum(x in k for x in w) > n else frozenset(w) for (_, w), n, k in
                     zip(self.templates, self.spare, (frozenset(w) - COMMON for _, w in self.templates))]
        self.need = [sum(x in k for x in w) - n for (_, w), n, k in zip(self.templates, self.spare, self.keys)]
        self.all_keys = frozenset().union(*self.keys) if self.keys else frozenset()

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(license, coverage, start, stop) of the notices found, in order of their start."""
        toks = tokens(text or "")
        hits = [i for i, (w, _, _) in enumerate(toks) if w in self.all_keys]
        found = []
        for (name, words), keys, need in zip(self.templates, self.keys, self.need):
            if len(hits) < need:                                # fewer can't reach the coverage
                continue
            own = [i for i in hits if toks[i][0] in keys]
            if len(own) >= need:
                found += [(name, n / len(words), toks[b][1], toks[e][2], 3 * n - len(words) - (e - b + 1))
                          for b, e, n in self._align(toks, own, words, need)]
        # where two overlap, the one with more aligned words after deduction of missing and foreign ones wins
        return [x[:4] for x in _disjoint(found, lambda x: (-x[4], x[0], x[2]), 2, 3)]

    def _align(self, toks, own, words, need):
        """(first token, last token, aligned words) of the notices of one template; ``own`` are the places of its rarer words.

        Each place is tried as the notice's first one, in windows that start where the template would and are one template
        long, then longer ones: a second copy behind the first would leave patience no word that occurs once. Of matches
        that overlap, the one with the most aligned words after deduction of the foreign words between them stays. Windows
        of a long template start at multiples of a sixteenth of its length, so that their number has a bound; they are longer
        by as much, so each contains the window that starts exactly there (tests compare with all windows at all starts).
        """
        size, reach = len(words), 2 * len(words)
        step = 1 if size < LONG else size // 16
        where = defaultdict(list)
        for j, w in enumerate(words):
            where[w].append(j)
        found, tried, bag, shared, last, done = [], {}, Counter(), 0, 0, -1
        for p in own:
            word = toks[p][0]
            while last < len(own) and own[last] - p < reach:    # the places from p within the reach
                w = toks[own[last]][0]
                bag[w] += 1
                shared += bag[w] <= len(where[w])
                last += 1
            if p > done and shared >= need:
                starts = sorted({max(0, p - j) // step * step for j in where[word]}, reverse=True)
                windows = [(b, b + n + step - 1) for n in (size, int(size / self.coverage)) for b in starts]
                wide = p // step * step
                for lo, hi in [*windows, (max(0, wide - size), wide + reach)]:
                    if (lo, hi) not in tried:
                        tried[lo, hi] = self._match(toks, lo, hi, words, reach)
                        found += [tried[lo, hi]] if tried[lo, hi] else []
                    b, e, n = tried[lo, hi] or (0, 0, 0)
                    if b <= p <= e and n == size == e - b + 1:  # word for word: nothing in it can be better
                        done = e
                        break
            shared -= bag[word] <= len(where[word])
            bag[word] -= 1
        return _disjoint(found, lambda x: (x[1] - x[0] + 1 - 2 * x[2], x[0]), 0, 1, inclusive=1)

    def _match(self, toks, lo, hi, words, reach):
        hit = patience(words, [w for w, _, _ in toks[lo:hi]])
        if len(hit) < self.coverage * len(words) or not hit:
            return None
        b, e = lo + hit[0][1], lo + hit[-1][1]
        if len(hit) >= self.coverage * (e - b + 1) or len(hit) == len(words) and e - b < reach:
            return b, e, len(hit)
        return None


def _disjoint(found: list[tuple], order, start: int, stop: int, inclusive: int = 0) -> list[tuple]:
    """Those that overlap none that comes before them in the order, by their start."""
    kept, starts = [], []
    for f in sorted(found, key=order):
        k = bisect_left(starts, f[start])
        if (k == 0 or kept[k - 1][stop] + inclusive <= f[start]) and (k == len(kept) or f[stop] + inclusive <= starts[k]):
            kept.insert(k, f)
            starts.insert(k, f[start])
    return kept


def licenses(text: Column, templates=None, coverage: float = COVERAGE) -> Column:
    """Array of (license, coverage, start, stop) of a text column."""
    scanner = Scanner(templates, coverage)

    @F.pandas_udf("array<struct<license:string,coverage:double,start:int,stop:int>>")
    def run(texts: pd.Series) -> pd.Series:
        names = ("license", "coverage", "start", "stop")
        return pd.Series([[dict(zip(names, x)) for x in scanner.scan(t)] for t in texts.tolist()])
    return run(text)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of every document."""
    d = read(spark, sf_dir, "documents").select("doc_id", licenses(F.col("text")).alias("found"))
    return d.select("doc_id", F.size("found").cast("long").alias("n_notices"),
                    F.concat_ws(",", F.array_sort(F.array_distinct("found.license"))).alias("licenses"),
                    F.coalesce(F.array_max("found.coverage"), F.lit(0.0)).alias("coverage"),
                    F.expr("array_join(transform(found, x -> concat_ws(':', x.license, x.start, x.stop)), ',')").alias("spans"))
