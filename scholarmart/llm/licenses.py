"""Fuzzy search for short license notices: exact seeds by the pigeonhole principle, then bounded-error matching.

A notice that may differ by ``k`` edits is cut into ``k + 1`` pieces: within ``k`` edits at least one piece stands unchanged. All
pieces of all notices are looked for at once; where one is found, the ``regex`` library matches the whole notice with at
most ``k`` insertions, deletions or substitutions of letters in the surrounding stretch, which verifies the candidate
and gives its span. So every match within ``k`` edits is found, and most texts are passed over by the seeds alone.

Texts are compared as words: A-Z in lower case, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` joined by one space; ends of a
match fall on word ends. Base phrases are found exactly, every place of them, besides. Nulls and empty texts have no
words and score 0. The score is the share of the best notice that stands unedited: 1 for an exact match or base
phrase, 0 without any. Whole texts are searched, one text at a time within a task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmart.llm.decontamination import SEPARATORS

BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: notices by label, in words; public texts of the licenses
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution 4 0 international license": "cc-by",
    "licensed under the gnu general public license version 3": "gpl-3",
    "under the terms of the gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2 0": "mpl-2",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "proprietary",
}
#: one edit for so many letters of a notice, three at most
LETTERS_PER_EDIT, MOST_EDITS = 10, 3


def plain(text: str | None) -> str:
    """The words of a text joined by single spaces, with a space at either end."""
    words = text.encode("utf-8", "surrogatepass").lower().translate(SEPARATORS).split() if text else []
    return f" {b' '.join(words).decode('utf-8', 'surrogatepass')} " if words else ""


def edits(notice: str) -> int:
    return min(MOST_EDITS, len(notice) // LETTERS_PER_EDIT)


def pieces(notice: str, k: int) -> list[tuple[int, str]]:
    """``k + 1`` pieces of about equal length and where they begin."""
    cuts = [round(i * len(notice) / (k + 1)) for i in range(k + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Searcher:
    def __init__(self, notices: dict[str, str] = NOTICES, base: dict[str, str] = BASE):
        self.notices, self.base = notices, base

    @cached_property
    def seeds(self) -> ahocorasick.Automaton:
        """Pieces with, for each, the notices they belong to and their place there."""
        found: dict[str, list[tuple[str, int]]] = {}
        for notice in self.notices:
            for at, piece in pieces(notice, edits(notice)):
                found.setdefault(piece, []).append((notice, at))
        automaton = ahocorasick.Automaton()
        for piece, owners in found.items():
            automaton.add_word(piece, (len(piece), owners))
        automaton.make_automaton()
        return automaton

    @cached_property
    def patterns(self) -> dict[str, regex.Pattern]:
        return {n: regex.compile(f"(?b)(?<= )(?:{regex.escape(n, literal_spaces=True)}){{e<={edits(n)}}}(?= )") for n in self.notices}

    @cached_property
    def phrases(self) -> list[tuple[re.Pattern, str]]:
        return [(re.compile(f"(?= {re.escape(p)} )"), label) for p, label in self.base.items()]

    def base_places(self, text: str) -> list[tuple[int, str]]:
        """Start in words and label of every place of a base phrase in a plain text."""
        out = []
        for pattern, label in self.phrases:
            at = words = 0
            for m in pattern.finditer(text):
                words += text.count(" ", at, m.start())
                at = m.start()
                out.append((words, label))
        return sorted(out)

    def spans(self, text: str) -> list[tuple[int, int, str, int]]:
        """Begin and end in letters, label and edits of notices in a plain text; overlapping ones of a notice once."""
        stretches: dict[str, list[list[int]]] = {}
        for end, (size, owners) in self.seeds.iter(text):
            for notice, at in owners:
                k, begin = edits(notice), end + 1 - size - at
                low, high = max(0, begin - k - 1), min(len(text), begin + len(notice) + k + 1)
                own = stretches.setdefault(notice, [])
                if own and own[-1][1] >= low:
                    own[-1][0], own[-1][1] = min(own[-1][0], low), max(own[-1][1], high)
                else:
                    own.append([low, high])
        out = []
        for notice, own in stretches.items():
            pattern = self.patterns[notice]
            shortest = len(notice) - edits(notice)
            while own:  # the best place of a stretch, then what lies before and behind it
                low, high = own.pop()
                m = pattern.search(text, low, high) if high - low >= shortest else None
                if m:
                    out.append((m.start(), m.end(), self.notices[notice], sum(m.fuzzy_counts)))
                    own += [[low, m.start()], [m.end(), high]]
        return sorted(out)

    def verdict(self, text: str | None) -> tuple:
        """``n_words, n_base, first_word, last_word, base_labels, labels, score, spans`` of a raw text."""
        whole = plain(text)
        if not whole:
            return 0, 0, None, None, "", "", 0.0, []
        places, spans = self.base_places(whole), self.spans(whole)
        base = sorted({label for _, label in places})
        labels = sorted({*base, *(label for _, _, label, _ in spans)})
        score = 1.0 if places else max((1 - e / (b - a) for a, b, _, e in spans), default=0.0)
        words = [(whole.count(" ", 0, a) - 1, whole.count(" ", 0, b) - 1, label, e) for a, b, label, e in spans]
        return whole.count(" ") - 1, len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(base), ",".join(labels), score, words


SPAN = "array<struct<first_word:long, last_word:long, label:string, edits:int>>"
SCHEMA = f"doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans {SPAN}"


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    searcher = Searcher()
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    for batch in batches:
        out = pd.DataFrame([searcher.verdict(text) for text in batch["text"]], columns=names)
        for c in ("first_word", "last_word"):
            out[c] = out[c].astype("Int64")
        out["spans"] = [[{"first_word": a, "last_word": b, "label": c, "edits": e} for a, b, c, e in spans] for spans in out["spans"]]
        out.insert(0, "doc_id", batch["doc_id"].to_numpy())
        yield out


def scan(docs: DataFrame) -> DataFrame:
    """The verdict on every row of ``docs`` with the spans of its notices, in words."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInPandas(_scan, SCHEMA)
