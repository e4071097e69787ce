"""Licence notices in texts, through a positional index of rare words.

Each notice is known by its rarest words, by document frequency over all texts,
and their positions. Each place of such a word in a text votes; where several
agree on one offset between text and notice, the notice is compared there and
its mandatory phrase checked. Phrases alone are found by their rarest
word and the words around it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.words import LETTERS_DIGITS, Words, slices

# Phrases whose every place is reported, and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Common notices (label, notice, mandatory phrase).
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2.0", "apache license"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", "apache org licenses"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl-2-or-later", "either version 2 of the license or at your option any later version", "any later version"),
    ("cc-by-nc", "licensed under cc by nc 4.0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4.0", "cc by sa"),
    ("cc-by", "this work is licensed under a creative commons attribution 4.0 international license", "creative commons attribution"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0", "mozilla public license"),
]

RARE = 6


def _split(text: str) -> list[str]:
    return text.replace(".", " ").split()


class Index:
    """Words, phrases and the rare words' places in the notices."""

    def __init__(self, phrases: dict[str, str], notices: list[tuple[str, str, str]]):
        self.texts = [_split(t) for _, t, _ in notices]
        self.labels = [label for label, _, _ in notices]
        asked = list(dict.fromkeys([*phrases, *(p for _, _, p in notices)]))
        self.base = [(p, phrases[p]) for p in phrases]
        self.mandatory = [asked.index(p) for _, _, p in notices]
        self.phrases = [_split(p) for p in asked]
        self.words = sorted({w for t in [*self.texts, *self.phrases] for w in t})
        hashes = Words(pa.array([" ".join(self.words)]), LETTERS_DIGITS).hash
        order = np.argsort(hashes)
        self.sorted, self.order = hashes[order], order
        number = {w: i for i, w in enumerate(self.words)}
        self.texts = [np.array([number[w] for w in t]) for t in self.texts]
        self.phrases = [np.array([number[w] for w in p]) for p in self.phrases]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word, -1 for others."""
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.order[at], -1)

    def weigh(self, idf: np.ndarray) -> None:
        """Choose the rarest words by ``idf``."""
        self.idf = idf
        self.rarest = [int(np.argmax(idf[p])) for p in self.phrases]
        places = []
        for t, text in enumerate(self.texts):
            for w in sorted(set(text.tolist()), key=lambda w: (-idf[w], w))[:RARE]:
                places += [(w, t, p) for p in np.flatnonzero(text == w)]
        places = np.array(sorted(places))
        self.post_notice, self.post_at = places[:, 1], places[:, 2]
        self.post_first = np.searchsorted(places[:, 0], np.arange(len(self.words) + 1))
        self.is_rare = np.diff(self.post_first) > 0

    def phrase_places(self, ids: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
        """Starts of phrase ``k``: postings of its rarest word, then its neighbours."""
        phrase, off = self.phrases[k], self.rarest[k]
        at = np.flatnonzero(ids == phrase[off]) - off
        at = at[(at >= 0) & (at + len(phrase) <= len(ids))]
        for j, w in enumerate(phrase):
            at = at[ids[at + j] == w]
        return at[doc[at] == doc[at + len(phrase) - 1]]

    def notices_of(self, ids: np.ndarray, doc: np.ndarray, places: list[np.ndarray], n: int) -> list[tuple[int, str, float]]:
        """(row, label, coverage) of each aligned and verified notice."""
        at = np.flatnonzero(ids >= 0)
        at = at[self.is_rare[ids[at]]]
        if not len(at):
            return []
        # Each posting votes for the place where its notice would begin.
        size = self.post_first[ids[at] + 1] - self.post_first[ids[at]]
        src = np.repeat(at, size)
        post = np.arange(len(src)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.post_first[ids[at]], size)
        begin, notice = src - self.post_at[post], self.post_notice[post]
        votes, count = np.unique(np.stack([doc[src], notice, begin]), axis=1, return_counts=True)
        out = []
        for (d, t, b), c in zip(votes.T[count >= 2], count[count >= 2], strict=True):
            text = self.texts[t]
            if c < max(2, math.ceil(0.5 * min(RARE, len(set(text.tolist()))))):
                continue
            span = np.arange(b, b + len(text))
            inside = (span >= 0) & (span < len(ids))
            span = span[inside]
            ok = (ids[span] == text[inside]) & (doc[span] == d)
            cover = float(ok.sum()) / len(text)
            spots = places[self.mandatory[t]]
            near = spots[(spots >= b - 3) & (spots < b + len(text) + 3)]
            if cover >= 0.7 and len(near) and (doc[near] == d).any():
                out.append((int(d), self.labels[t], cover))
        return out


def licence_scan(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 phrases: dict[str, str] = PHRASES, notices: list[tuple[str, str, str]] = NOTICES) -> DataFrame:
    """One row per row of ``docs``: key, ``n_words``, ``n_base``, ``first_word``,
    ``last_word``, ``base_labels``, ``labels``, ``score``.

    NULL is the empty text. ``score`` is the coverage of the best verified
    notice, 0.5 at least where a phrase stands, else 0. Other columns are
    ignored.
    """
    index = Index(phrases, notices)
    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("text"))
    count = len(index.words)

    def frequencies(batches):
        df, n = np.zeros(count, np.int64), 0
        for b in batches:
            for t in slices(b):
                w = Words(t.column("text"), LETTERS_DIGITS)
                ids = index.ids(w.hash)
                pairs = np.unique((w.doc * count + ids)[ids >= 0])
                df += np.bincount(pairs % count, minlength=count)
                n += t.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([*range(count), -1]), pa.array([*df.tolist(), n])], ["w", "n"])

    told = dict(rows.select("text").mapInArrow(frequencies, "w long, n long").groupBy("w").agg(F.sum("n")).collect())
    total = told.get(-1, 0)
    index.weigh(np.array([math.log((total + 1) / (told.get(i, 0) + 1)) for i in range(count)]))
    asked = [" ".join(index.words[i] for i in p) for p in index.phrases]

    def scan(batches):
        for b in batches:
            parts = [scan_slice(t) for t in slices(b)]
            if parts:
                cols = [pa.concat_arrays(list(c)) for c in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), *cols], names)

    def scan_slice(t):
        w, n = Words(t.column("text"), LETTERS_DIGITS), t.num_rows
        ids = index.ids(w.hash)
        places = [index.phrase_places(ids, w.doc, k) for k in range(len(index.phrases))]
        base: list[set] = [set() for _ in range(n)]
        starts = []
        for phrase, label in index.base:
            at = places[asked.index(phrase)]
            starts.append(at)
            for d in np.unique(w.doc[at]):
                base[d].add(label)
        at = np.sort(np.concatenate(starts)) if starts else np.empty(0, np.int64)
        per = np.bincount(w.doc[at], minlength=n)
        ends = np.cumsum(per)
        local = at - w.first[w.doc[at]]
        some = per > 0
        first, last = np.zeros(n, np.int64), np.zeros(n, np.int64)
        first[some], last[some] = local[(ends - per)[some]], local[ends[some] - 1]
        best, every = np.where(some, 0.5, 0.0), [set(x) for x in base]
        for d, label, cover in index.notices_of(ids, w.doc, places, n):
            every[d].add(label)
            best[d] = max(best[d], cover)
        joined = lambda sets: pa.array([",".join(sorted(x)) for x in sets], pa.string())
        return (pa.array(np.diff(w.first)), pa.array(per.astype(np.int64)), pa.array(first, mask=~some),
                pa.array(last, mask=~some), joined(base), joined(every), pa.array(best))

    names = [key, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kind = rows.schema["_key"].dataType.simpleString()
    return rows.mapInArrow(scan, f"`{key}` {kind}, n_words long, n_base long, first_word long, last_word long, "
                                 "base_labels string, labels string, score double")
