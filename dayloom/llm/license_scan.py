"""License scans by a positional index of the rare words of licence notices.

Two passes over whole texts. The first counts, over all documents, in how many each word of the templates stands; that
gives the words' IDF. The second finds licences. Of every template the rarest words are posted (word -> template, place
in it), so many that the others carry at most ``UNPOSTED`` of its IDF. Of the posted words that a text holds, the postings are
intersected by relative position: each occurrence votes, with its IDF, for the place where the template would start, and a place is
nominated if the votes within ``SHIFT`` words of it reach what a match needs, ``LEAST_SHARE`` less what the others may add; so no
match is missed. There all words of the template are compared with the text; those within ``SHIFT`` words of where they
belong count, and where they carry at least ``LEAST_SHARE`` of the template's IDF and the template's key phrase stands
within its reach, the label is given. So no template takes from another, whatever else a document holds.

Some labels are of a family (``gpl``, ``bsd``), others of a version, told by a notice of its own (``gpl-2``, ``bsd-3``). ``UNLESS`` names
those that a longer licence rules out: ``bsd-2`` is the text of ``bsd-3`` without one clause.

Apart from that, the base: every place where the words of a base phrase stand in a row.

Words are runs of characters other than ASCII ones that are neither digit nor letter, A-Z lower-cased. Templates, key
phrases and so the index are of fixed size; a task holds the words of one document.

Defined results: a null or empty text has no words, no labels and score 0; equal texts get equal results; an empty table
gives no rows; other columns are not read. ``score`` is 1 where a base phrase stands, else the share of the best label.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SHIFT = 2
LEAST_SHARE = 0.5
UNPOSTED = 0.25
_ROUNDING = 1e-9

BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: (label, notice, key phrase that must stand)
TEMPLATES = [
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
            " documentation files", "permission is hereby granted free of charge"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
            " public license", "gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license version 3", "lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"
            " the following conditions are met", "redistribution and use in source and binary forms"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license",
     "creative commons attribution noncommercial"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license",
     "creative commons attribution 4 0"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
            " granted", "permission to use copy modify and or distribute this software"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the"
            " software", "substantial portions of the software"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www"
               " apache org licenses license 2 0", "apache org licenses license 2 0"),
    ("gpl-2", "the gnu general public license version 2", "general public license version 2"),
    ("gpl-2", "the gnu general public license as published by the free software foundation either version 2 of the license or at"
              " your option any later version", "version 2 of the license"),
    ("gpl-3", "the gnu general public license version 3", "general public license version 3"),
    ("gpl-3", "the gnu general public license as published by the free software foundation either version 3 of the license or at"
              " your option any later version", "version 3 of the license"),
    ("bsd-2", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following"
              " disclaimer in the documentation and or other materials provided with the distribution",
     "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
              " derived from this software without specific prior written permission",
     "may be used to endorse or promote products derived from this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "unencumbered software released into the public domain"),
]

#: label -> the label in whose presence it is not given
UNLESS = {"bsd-2": "bsd-3"}

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_FOLD))


def _split(phrase: str) -> list[bytes]:
    return [w.encode() for w in phrase.split()]


VOCABULARY = frozenset(w for _, notice, _ in TEMPLATES for w in _split(notice))
_BASE_WORDS = [(_split(p), label) for p, label in BASE.items()]


class Index:
    """Postings of the templates' rarest words, and all their words weighed by IDF."""

    def __init__(self, idf: dict[bytes, float]) -> None:
        self.postings: dict[bytes, list[tuple[int, int, float]]] = defaultdict(list)
        self.templates = []
        self.needed: list[float] = []  # votes that a match has at least
        for number, (label, notice, key) in enumerate(TEMPLATES):
            words = _split(notice)
            rarest = sorted(((idf[w], place, w) for place, w in enumerate(words)), key=lambda x: (-x[0], x[1]))
            weight = rest = math.fsum(idf[w] for w in words)
            for worth, place, word in rarest:
                if rest <= weight * UNPOSTED:
                    break
                self.postings[word].append((number, place, worth))
                rest -= worth
            self.templates.append((label, rarest, weight, _split(key)))
            self.needed.append(weight * (LEAST_SHARE - _ROUNDING) - rest)

    def share(self, number: int, words: list[bytes], start: int) -> float:
        """The share of a template's weight that stands about ``start``; 0 once it cannot reach ``LEAST_SHARE``."""
        _, rarest, weight, _ = self.templates[number]
        found, rest, exact = [], weight, False
        for worth, place, word in rarest:
            at = start + place
            if 0 <= at < len(words) and words[at] == word:
                found.append(worth)
                exact = True
            elif word in words[max(0, at - SHIFT) : max(0, at + SHIFT + 1)]:
                found.append(worth)
            else:
                rest -= worth
                if rest < weight * (LEAST_SHARE - _ROUNDING):
                    return 0.0
        return math.fsum(found) / weight if exact else 0.0

    def labels(self, words: list[bytes], found: dict[bytes, list[int]]) -> dict[str, float]:
        """Labels whose template is matched, with the largest share of its weight that was found."""
        votes: dict[int, dict[int, float]] = defaultdict(lambda: defaultdict(float))
        for word in self.postings.keys() & found.keys():
            for number, place, worth in self.postings[word]:
                of_template = votes[number]
                for at in found[word]:
                    of_template[at - place] += worth
        out: dict[str, float] = {}
        for number, places in votes.items():
            label, rarest, _, key = self.templates[number]
            # a word may stand up to SHIFT words from where it belongs
            near: dict[int, float] = defaultdict(float)
            for start, worth in places.items():
                for shift in range(-SHIFT, SHIFT + 1):
                    near[start + shift] += worth
            for start in [at for at, worth in near.items() if worth >= self.needed[number]]:
                share = self.share(number, words, start)
                if share < LEAST_SHARE or share <= out.get(label, 0):
                    continue
                low, high = max(0, start - SHIFT), start + len(rarest) + SHIFT
                if any(words[i : i + len(key)] == key for i in range(low, min(high, len(words)) - len(key) + 1)):
                    out[label] = min(1.0, share)
        return {label: share for label, share in out.items() if UNLESS.get(label) not in out}


def _places(words: list[bytes]) -> dict[bytes, list[int]]:
    found: dict[bytes, list[int]] = defaultdict(list)
    for i, word in enumerate(words):
        if word in VOCABULARY:
            found[word].append(i)
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df: Counter[bytes] = Counter()
    n = 0
    for batch in batches:
        n += batch.num_rows
        for text in batch.column(0).to_pylist():
            df.update(VOCABULARY.intersection(words_of(text)))
    names = [None, *(w.decode() for w in df)]
    yield pa.record_batch({"word": pa.array(names, pa.string()), "n": pa.array([n, *df.values()], pa.int64())})


def rarity(docs: DataFrame) -> dict[bytes, float]:
    """The IDF of every template word, from all documents; the vocabulary is fixed."""
    counts = docs.select("text").mapInArrow(_count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"]: r["n"] for r in counts.collect()}
    n = found.pop(None, 0)
    return {w: math.log((n + 2) / (found.get(w.decode(), 0) + 1)) for w in VOCABULARY}


_RESULT = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double"
)


def scan_words(words: list[bytes], index: Index) -> tuple:
    found = _places(words)
    starts, base = [], set()
    for phrase, label in _BASE_WORDS:
        for at in found.get(phrase[0], ()):
            if words[at : at + len(phrase)] == phrase:
                starts.append(at)
                base.add(label)
    labels = index.labels(words, found) if len(found) > 1 else {}
    score = 1.0 if starts else max(labels.values(), default=0.0)
    bounds = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(starts), *bounds, ",".join(sorted(base)), ",".join(sorted(base | labels.keys())), score


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row."""
    idf = rarity(docs)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(idf)
        kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64()]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        for batch in batches:
            out = list(zip(*(scan_words(words_of(t), index) for t in batch.column(1).to_pylist()))) or [()] * 7
            yield pa.record_batch([batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))], names=names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(rows, _RESULT)
