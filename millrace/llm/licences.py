"""Licence scan by a positional index of rare words.

Known texts (``TEMPLATES``) and phrases (``PHRASES``) are indexed by their rarest words: idf is counted over
all documents, and each template is represented by its ``RARE`` rarest words with their places. A file's words are
looked up in that index; every posting votes for a relative position of the template in the file. Positions with
enough votes are verified: the template's mandatory key phrase must stand there word by word. The score of a
match is the idf-weighted share of the template's words that agree at that position.

Words: runs of ASCII letters (A-Z counted as a-z), digits and non-ASCII characters.
Defined results: null and empty texts have no words, no labels and score 0; rows without doc_id and repeated rows are rows like
others; a place counts once per phrase, places of different phrases count each.
"""
from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words

RARE = 4  # words of a template that are indexed; all of them for a shorter one
VOTES = 2  # indexed words that must agree on a position

# Phrases that are reported with all their places, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Label, notice as published, phrase of it that must be there.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "permission is hereby granted free of charge"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "licensed under the apache license version 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    ("gpl", "licensed under the gnu general public license version", "gnu general public license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    ("epl-2", "made available under the terms of the eclipse public license 2 0", "eclipse public license"),
]


class Template(NamedTuple):
    label: str
    base: bool
    words: tuple[str, ...]
    key: tuple[str, ...]


def templates() -> list[Template]:
    own = [Template(label, True, tuple(p.split()), tuple(p.split())) for p, label in PHRASES.items()]
    return own + [Template(label, False, tuple(t.split()), tuple(k.split())) for label, t, k in TEMPLATES]


def _vocabulary(known: list[Template]) -> list[str]:
    return sorted({w for t in known for w in t.words})


def _hashes(vocabulary: list[str]) -> np.ndarray:
    return words.hashed_words(pa.array(vocabulary)).hashes


def _count_batches(hashes: np.ndarray):
    order = np.argsort(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(len(hashes), np.int64), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                found = words.hashed_words(part["text"])
                at, number = _known(found.hashes, hashes, order)
                owner = np.searchsorted(found.first, at, "right")
                pair = np.unique(owner.astype(np.int64) * len(hashes) + number)
                total += np.bincount(pair % len(hashes), minlength=len(hashes))
                rows += part.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, len(hashes))), pa.array(np.concatenate([[rows], total]))], names=["number", "n"])
    return run


def _known(found: np.ndarray, hashes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of known words, and which word of ``hashes`` stands there."""
    ranked = hashes[order]
    spot = np.minimum(np.searchsorted(ranked, found), len(ranked) - 1)
    at = np.flatnonzero(ranked[spot] == found)
    return at, order[spot[at]]


def inverse_frequencies(docs: DataFrame, vocabulary: list[str]) -> np.ndarray:
    """idf of each word over all documents. Tasks send one count per vocabulary word."""
    counts = docs.select("text").mapInArrow(_count_batches(_hashes(vocabulary)), "number long, n long")
    got = {r["number"]: r["n"] for r in counts.groupBy("number").agg(F.sum("n").alias("n")).collect()}
    seen = np.array([got.get(i, 0) for i in range(len(vocabulary))], float)
    return np.log((got.get(-1, 0) + 1) / (seen + 1)) + 1e-9


class Index(NamedTuple):
    templates: list[Template]
    hashes: np.ndarray  # of the vocabulary
    idf: np.ndarray
    numbers: list[np.ndarray]  # of each template: its words as vocabulary numbers
    postings: list[list[int]]  # of each template: places of its rare words
    key_at: list[int]


def build_index(vocabulary: list[str], idf: np.ndarray, known: list[Template]) -> Index:
    number = {w: i for i, w in enumerate(vocabulary)}
    numbers = [np.array([number[w] for w in t.words]) for t in known]
    postings, key_at = [], []
    for t, n in zip(known, numbers, strict=True):
        # Rare words are taken from the key phrase first, since that phrase has to be there.
        start = next(i for i in range(len(t.words)) if t.words[i : i + len(t.key)] == t.key)
        inside = range(start, start + len(t.key))
        rare = sorted(inside, key=lambda i: (-idf[n[i]], i))[:RARE]
        postings.append(sorted(rare))
        key_at.append(start)
    return Index(known, _hashes(vocabulary), idf, numbers, postings, key_at)


def _matches(found: words.Words, index: Index, order: np.ndarray):
    """(template, text, start, score) of every verified position."""
    at, number = _known(found.hashes, index.hashes, order)
    by_word = {n: at[number == n] for n in np.unique(number).tolist()}
    none = np.zeros(0, np.int64)
    for i, t in enumerate(index.templates):
        votes = [by_word.get(int(index.numbers[i][p]), none) - p for p in index.postings[i]]
        place, times = np.unique(np.concatenate(votes), return_counts=True)
        # The key phrase has every indexed word, so whole matches have all votes.
        place = place[times >= min(VOTES, len(votes))]
        key = place + index.key_at[i]
        fit = (key >= 0) & (key + len(t.key) <= len(found.hashes))
        place, key = place[fit], key[fit]
        for k in range(len(t.key)):
            same = found.hashes[key + k] == index.hashes[index.numbers[i][index.key_at[i] + k]]
            place, key = place[same], key[same]
        text = np.searchsorted(found.first, key, "right") - 1
        inside = key + len(t.key) <= found.first[text + 1]
        place, key, text = place[inside], key[inside], text[inside]
        agreed = np.zeros(len(place))
        for j, n in enumerate(index.numbers[i]):
            spot = place + j
            ok = (spot >= found.first[text]) & (spot < found.first[text + 1])
            agreed[ok] += index.idf[n] * (found.hashes[spot[ok]] == index.hashes[n])
        yield i, text, place + index.key_at[i] - found.first[text], agreed / index.idf[index.numbers[i]].sum()


def _scan_batches(index: Index):
    order = np.argsort(index.hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                batch = whole.slice(lo, 1000)
                found = words.hashed_words(batch["text"])
                rows = batch.num_rows
                n_base, score = np.zeros(rows, np.int64), np.zeros(rows)
                first, last = np.full(rows, np.iinfo(np.int64).max), np.full(rows, -1)
                base, labels = [set() for _ in range(rows)], [set() for _ in range(rows)]
                for i, text, start, share in _matches(found, index, order):
                    t = index.templates[i]
                    np.maximum.at(score, text, np.minimum(share, 1.0))
                    for x in np.unique(text).tolist():
                        labels[x].add(t.label)
                        if t.base:
                            base[x].add(t.label)
                    if t.base:
                        np.add.at(n_base, text, 1)
                        np.minimum.at(first, text, start)
                        np.maximum.at(last, text, start)
                none = n_base == 0
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.array(np.diff(found.first).astype(np.int64)), pa.array(n_base),
                     pa.array(first, mask=none), pa.array(last, mask=none),
                     pa.array([",".join(sorted(x)) for x in base]), pa.array([",".join(sorted(x)) for x in labels]),
                     pa.array(score)],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    return run


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): doc_id, n_words, n_base (places of
    ``PHRASES``), first_word and last_word (their smallest and largest start), base_labels, labels, score."""
    known = templates()
    vocabulary = _vocabulary(known)
    index = build_index(vocabulary, inverse_frequencies(docs, vocabulary), known)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scan_batches(index),
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
