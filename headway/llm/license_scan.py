"""License scan: an exact set-similarity join of text blocks with license templates.

A block is one line of a text, or a run of words over line breaks: as long as the
template and as many more words as the threshold lets be missing, so that a notice is
found however it is wrapped and a long text does not match by chance.  A block matches
a template when it holds at least ``threshold`` of the template's distinct words
(containment).  The join orders the template words by their places in the whole
corpus (each place of a word is in as many runs), rarest first, and uses three
filters that lose nothing:

* prefix: a block that meets the threshold holds one of the template's rarest
  ``size - needed + 1`` words; blocks without one are never looked at;
* length: the block must have at least ``needed`` of the template words at all;
* positional: from the first common word on, what is left on either side must still
  make up ``needed``.

The templates are a parameter and few, so they and their word counts are broadcast;
the documents are scanned where they are and never shuffle.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.text import with_columns

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
THRESHOLD = 0.8
#: Fixed phrases and their labels: places where their words stand consecutively.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Label -> statements that name the license in one line.
TEMPLATES = {
    "apache-2.0": [
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    ],
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    ],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "gpl-3.0": ["this work is licensed under the gnu general public license version 3"],
    "gpl-2.0": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2"],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "cc-by-nc": ["licensed under cc by nc 4 0"],
    "cc-by-sa": ["this work is licensed under a creative commons attribution sharealike 4 0 international license"],
}


class Matcher:
    """Templates in the global word order, ready to be held against blocks."""

    def __init__(self, templates: dict[str, list[str]], frequency: dict[bytes, int], threshold: float):
        vocabulary = {w for texts in templates.values() for t in texts for w in WORD.findall(t.encode().lower())}
        order = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(order)}
        self.by_prefix: dict[bytes, list[int]] = {}
        self.templates: list[tuple[str, list[int], int]] = []
        self.widths: list[int] = []  # words of a run
        for label, texts in templates.items():
            for t in texts:
                every = [self.rank[w] for w in WORD.findall(t.encode().lower())]
                words = sorted(set(every))
                if not words:
                    continue
                needed = -int(-threshold * len(words) // 1)
                for r in words[: len(words) - needed + 1]:
                    self.by_prefix.setdefault(order[r], []).append(len(self.templates))
                self.templates.append((label, words, needed))
                self.widths.append(2 * len(every) - needed)
        self.prefix_words = frozenset(self.by_prefix)

    def match(self, words: set[bytes]) -> dict[str, float]:
        """Label -> containment of its best template in a block's distinct words."""
        seeds = self.prefix_words & words
        if not seeds:
            return {}
        own = sorted(self.rank[w] for w in words if w in self.rank)
        found: dict[str, float] = {}
        for t in {t for w in seeds for t in self.by_prefix[w]}:
            label, theirs, needed = self.templates[t]
            if len(own) < needed:
                continue
            i = j = common = 0
            while i < len(own) and j < len(theirs):
                if common + min(len(own) - i, len(theirs) - j) < needed:
                    break
                if own[i] == theirs[j]:
                    common, i, j = common + 1, i + 1, j + 1
                elif own[i] < theirs[j]:
                    i += 1
                else:
                    j += 1
            if common >= needed:
                found[label] = max(found.get(label, 0.0), common / len(theirs))
        return found

    def match_runs(self, words: list[bytes], lines: list[int]) -> list[tuple[int, int, str, float]]:
        """(first line, last line, label, containment) of runs over line breaks, the best of those that overlap.

        ``lines`` holds the line of each of a text's words.
        """
        places = [(p, self.rank[w]) for p, w in enumerate(words) if w in self.rank]
        held = {r for _, r in places}
        found = []
        for t in {t for w in self.prefix_words.intersection(words) for t in self.by_prefix[w]}:
            label, theirs, needed = self.templates[t]
            width, own = self.widths[t], held.intersection(theirs)
            if len(own) < needed:
                continue
            prefix = own.intersection(theirs[: len(theirs) - needed + 1])
            seeds = [p for p, r in places if r in prefix]
            near = []  # places that share a run with a prefix word
            for p, r in places:
                if r in own:
                    i = bisect_left(seeds, p - width + 1)
                    if i < len(seeds) and seeds[i] < p + width:
                        near.append((p, r))
            count: Counter[int] = Counter()
            lo = common = 0
            best = None  # (distinct words, first place, last place)
            for hi, (p, r) in enumerate(near):
                common += not count[r]
                count[r] += 1
                while p - near[lo][0] >= width or count[near[lo][1]] > 1:
                    count[near[lo][1]] -= 1
                    common -= not count[near[lo][1]]
                    lo += 1
                if common >= needed and lines[near[lo][0]] < lines[p]:
                    if best and near[lo][0] > best[2]:
                        found.append((t, *best))
                        best = None
                    if not best or common > best[0]:
                        best = common, near[lo][0], p
                if common + len(near) - hi - 1 < needed:
                    break
            if best:
                found.append((t, *best))
        return [(lines[a], lines[b], self.templates[t][0], n / len(self.templates[t][1])) for t, n, a, b in found]


def phrase_places(words: list[bytes], phrases: dict[str, str] = PHRASES) -> list[tuple[int, str]]:
    """(start, label) of every place where a phrase's words stand consecutively."""
    places = []
    for phrase, label in phrases.items():
        own = phrase.encode().split()
        k = max(range(len(own)), key=lambda i: len(own[i]))  # looks for the longest word
        at = k
        while True:
            try:
                at = words.index(own[k], at)
            except ValueError:
                break
            if words[at - k : at - k + len(own)] == own:
                places.append((at - k, label))
            at += 1
    return places


def block_frequency(docs: DataFrame, templates: dict[str, list[str]], text: str = "text") -> dict[bytes, int]:
    """How many places all documents have of each template word; as many entries as the templates have words."""
    vocabulary = frozenset(w for texts in templates.values() for t in texts for w in WORD.findall(t.encode().lower()))

    def count(batches):
        total = dict.fromkeys(vocabulary, 0)
        for batch in batches:
            for t in batch["text"]:
                seen = Counter(WORD.findall((t or "").encode("utf-8", "replace").lower()))
                for w in vocabulary.intersection(seen):
                    total[w] += seen[w]
        yield pd.DataFrame({"word": [w.decode() for w in total], "n": list(total.values())})

    rows = docs.select(F.col(text).alias("text")).mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"].encode(): r["n"] for r in rows.collect()}  # one row for each template word


def scan_licenses(docs: DataFrame, text: str = "text", templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` plus n_words, n_base, first_word, last_word, base_labels, labels, blocks, score.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  n_base: places of the
    fixed phrases; first_word and last_word: their smallest and largest start (null
    without any); labels: base labels and those of the matching templates; blocks:
    (line, label, containment) of every match, a run of words over line breaks by its first
    line and where no line of it holds as much; score: 1 with a base place, else the best
    containment, else 0.  Null and empty texts have no words and no labels; equal rows
    give equal results; columns of these names are replaced.
    """
    templates = TEMPLATES if templates is None else templates
    shared = docs.sparkSession.sparkContext.broadcast(Matcher(templates, block_frequency(docs, templates, text), threshold))
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "blocks", "score"]

    @F.pandas_udf(
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "blocks array<struct<line:int,label:string,containment:double>>, score double"
    )
    def scan(texts: pd.Series) -> pd.DataFrame:
        matcher, rows = shared.value, []
        for t in texts:
            raw = (t or "").encode("utf-8", "replace").lower()
            words = WORD.findall(raw)
            places = phrase_places(words)
            blocks = []
            if not matcher.prefix_words.isdisjoint(words):
                lines, found = [], {}
                for i, line in enumerate(raw.split(b"\n")):
                    own = WORD.findall(line)
                    lines += [i] * len(own)
                    found.update({(i, label): c for label, c in matcher.match(set(own)).items()})
                runs: dict[tuple[int, str], float] = {}
                for i, j, label, c in matcher.match_runs(words, lines):
                    if all(found.get((k, label), 0.0) < c for k in range(i, j + 1)):
                        runs[i, label] = max(runs.get((i, label), 0.0), c)
                for (i, label), c in sorted((found | runs).items()):
                    blocks.append({"line": i, "label": label, "containment": c})
            base = sorted({x for _, x in places})
            every = sorted({*base, *(b["label"] for b in blocks)})
            starts = [x for x, _ in places]
            score = 1.0 if places else max((b["containment"] for b in blocks), default=0.0)
            rows.append((len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(every), blocks, score))
        out = pd.DataFrame(rows, columns=names)
        return out.astype({"first_word": "Int64", "last_word": "Int64"})

    out = docs.select(F.struct("*").alias("row"), scan(F.col(text)).alias("d"))
    flat = out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], F.col("d").alias("found in text"))
    return with_columns(flat, {k: F.col("`found in text`").getField(k) for k in names}).drop("found in text")
