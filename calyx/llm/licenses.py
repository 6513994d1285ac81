"""Licence scan with a positional rare-token index.

A first pass counts, over all documents, in how many each licence word occurs.
All words of all templates are posted: word -> (template, position). A file
looks up the highest-IDF ones among the licence words that it holds: so many
that whatever share of a template stands there, one of them belongs to it (the
others can't make up for them). Postings of a template that agree on the
relative position are intersected around these, and kept where the template's
mandatory phrase stands. Base phrases are found by position in the same pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, chunks, map_arrow, text_buffers, word_hash, words

#: fixed values: base phrase, label
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: fixed values: label, mandatory phrase, text as the licences and their notices publish it
TEXTS = (
    ("mit", "mit license", "mit license"),
    ("mit", "to any person obtaining a copy",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
     "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
     "notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "to any person obtaining a copy",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction"),
    ("apache-2.0", "apache license version 2 0", "apache license version 2 0"),
    ("apache-2.0", "apache software license version 2 0", "apache software license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license",
     "you may not use this file except in compliance with the license you may obtain a copy of the license at http www "
     "apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed "
     "under the license is distributed on an as is basis without warranties or conditions of any kind either express "
     "or implied"),
    ("bsd", "bsd license", "bsd license"),
    ("bsd", "redistribution and use in source and binary forms",
     "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met redistributions of source code must retain the above copyright notice this list of "
     "conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice "
     "this list of conditions and the following disclaimer in the documentation and or other materials provided with "
     "the distribution"),
    ("bsd", "redistribution and use in source and binary forms",
     "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met"),
    ("bsd-3-clause", "endorse or promote products derived from this software",
     "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
     "products derived from this software without specific prior written permission"),
    ("gpl-3.0", "general public license version 3", "gnu general public license version 3"),
    ("gpl-2.0", "general public license version 2", "gnu general public license version 2"),
    ("gpl", "general public license",
     "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
     "free software foundation either version of the license or at your option any later version"),
    ("gpl", "general public license",
     "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
     "free software foundation"),
    ("lgpl", "lesser general public license", "gnu lesser general public license"),
    ("agpl", "affero general public license", "gnu affero general public license"),
    ("mpl-2.0", "mozilla public license", "mozilla public license v 2 0"),
    ("mpl-2.0", "mozilla public license", "mozilla public license version 2 0"),
    ("mpl-2.0", "subject to the terms of the mozilla public license",
     "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
     "distributed with this file you can obtain one at"),
    ("epl", "eclipse public license",
     "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("epl", "eclipse public license", "eclipse public license"),
    ("cddl", "common development and distribution license", "common development and distribution license"),
    ("isc", "isc license", "isc license"),
    ("isc", "permission to use copy modify and or distribute this software",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc", "permission to use copy modify and or distribute this software",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib", "in no event will the authors be held liable",
     "this software is provided as is without any express or implied warranty in no event will the authors be held "
     "liable for any damages arising from the use of this software permission is granted to anyone to use this software "
     "for any purpose including commercial applications and to alter it and redistribute it freely"),
    ("bsl-1.0", "boost software license", "boost software license version 1 0"),
    ("artistic", "artistic license", "the artistic license"),
    ("psf", "python software foundation license", "python software foundation license"),
    ("ofl", "sil open font license", "sil open font license version 1 1"),
    ("eupl", "european union public licence", "european union public licence"),
    ("ms-pl", "microsoft public license", "microsoft public license"),
    ("cc0", "cc0 1 0", "cc0 1 0 universal"),
    ("cc0", "public domain dedication", "creative commons public domain dedication"),
    ("cc-by-4.0", "cc by 4 0", "cc by 4 0"),
    ("cc-by-4.0", "creative commons attribution 4 0", "creative commons attribution 4 0 international"),
    ("cc-by-sa-4.0", "cc by sa 4 0", "cc by sa 4 0"),
    ("cc-by-sa-4.0", "attribution sharealike 4 0", "creative commons attribution sharealike 4 0 international"),
    ("cc-by-nc-4.0", "cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-nc-4.0", "attribution noncommercial 4 0", "creative commons attribution noncommercial 4 0 international"),
    ("cc-by-nd-4.0", "cc by nd 4 0", "cc by nd 4 0"),
    ("unlicense", "released into the public domain",
     "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
     "compile sell or distribute this software either in source code form or as a compiled binary for any purpose"),
    ("unlicense", "released into the public domain",
     "this is free and unencumbered software released into the public domain"),
)
#: fixed values: identifier on a SPDX line, label
IDENTIFIERS = (
    ("mit", "mit"), ("apache 2 0", "apache-2.0"), ("bsd 2 clause", "bsd"), ("bsd 3 clause", "bsd-3-clause"),
    ("gpl 2 0", "gpl-2.0"), ("gpl 3 0", "gpl-3.0"), ("lgpl 2 1", "lgpl"), ("lgpl 3 0", "lgpl"), ("agpl 3 0", "agpl"),
    ("mpl 2 0", "mpl-2.0"), ("epl 2 0", "epl"), ("isc", "isc"), ("zlib", "zlib"), ("bsl 1 0", "bsl-1.0"),
    ("unlicense", "unlicense"), ("cc0 1 0", "cc0"), ("cc by 4 0", "cc-by-4.0"), ("cc by sa 4 0", "cc-by-sa-4.0"),
)
TEMPLATES = TEXTS + tuple((label, f"spdx license identifier {name}", f"spdx license identifier {name}")
                          for name, label in IDENTIFIERS)
SHARE = 0.6                    # of a template's different words that must stand in place; of up to SHORT words all
SHORT = 6
SLACK = 8                      # words that places may shift by


def _hashes(text: str) -> np.ndarray:
    return np.array([word_hash(w) for w in text.split()], np.uint64)


def _vocabulary(templates) -> np.ndarray:
    return np.unique(np.concatenate([_hashes(t[2]) for t in templates]))


def _lookup(h: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``h`` whose hash is in the sorted ``table``, and where in the table."""
    at = np.searchsorted(table, h)
    at[at == len(table)] = 0
    places = np.flatnonzero(table[at] == h)
    return places, at[places]


def _document_counts(batches, table: np.ndarray) -> Iterator[pa.RecordBatch]:
    total, docs = np.zeros(len(table), np.int64), 0
    for batch in batches:
        data, offsets = text_buffers(batch.column(0))
        for i, j, raw, off in chunks(data, offsets):
            h, _, _, first = words(raw, off, ALNUM)
            places, which = _lookup(h, table)
            doc = np.searchsorted(first, places, "right") - 1
            total += np.bincount(np.unique(doc * len(table) + which) % len(table), minlength=len(table))
            docs += j - i
    yield pa.record_batch([pa.array(np.append(np.arange(len(table)), -1)), pa.array(np.append(total, docs))],
                          names=["word", "n"])


def document_counts(docs: DataFrame, text_col: str, templates=TEMPLATES) -> dict[int, int]:
    """Documents that hold each template word (by its place in the vocabulary); -1: all documents.

    As many rows as the templates have words come to the driver.
    """
    table = _vocabulary(templates)
    got = map_arrow(docs.select(F.col(text_col).alias("text")), lambda it: _document_counts(it, table),
                    "word long, n long").groupBy("word").agg(F.sum("n"))
    return {r[0]: r[1] for r in got.collect()}


class Index:
    """Postings of all template words: word -> (template, position); and how rare each word is in the corpus."""

    def __init__(self, counts: dict[int, int], templates=TEMPLATES):
        self.words = _vocabulary(templates)
        self.labels = [t[0] for t in templates]
        self.phrases = [_hashes(t[1]) for t in templates]
        self.texts = [np.searchsorted(self.words, _hashes(t[2])) for t in templates]
        self.own = [np.unique(t) for t in self.texts]                         # a template's different words
        size = np.array([len(o) for o in self.own])
        self.need = np.where(size <= SHORT, size, np.ceil(SHARE * size)).astype(int)
        #: place in the order of falling IDF: words in few documents first
        seen = np.array([counts.get(w, 0) for w in range(len(self.words))])
        self.rarity = np.empty(len(self.words), np.int64)
        self.rarity[np.lexsort((np.arange(len(self.words)), seen))] = np.arange(len(self.words))
        self.holders = [np.array([t for t, o in enumerate(self.own) if w in o], np.int64) for w in range(len(self.words))]

    def likely(self, doc: np.ndarray, word: np.ndarray, docs: int) -> np.ndarray:
        """Pairs (document, template) of which the document holds as many different words as must agree."""
        pair = np.unique(doc * len(self.words) + word)
        doc, word = pair // len(self.words), pair % len(self.words)
        n = np.array([len(self.holders[w]) for w in word], np.int64)
        template = np.concatenate([self.holders[w] for w in word]) if len(word) else np.zeros(0, np.int64)
        key, held = np.unique(np.repeat(doc, n) * len(self.texts) + template, return_counts=True)
        key = key[held >= self.need[key % len(self.texts)]]
        return np.stack([key // len(self.texts), key % len(self.texts)], 1)

    def places(self, t: int, place: np.ndarray, word: np.ndarray) -> list[tuple[int, int]]:
        """(start, words that agree) of the stretches where the words at ``place`` agree on where template ``t`` begins.

        Of the words that the file holds, so many of the highest IDF are looked
        up that one of them must be among any ``need`` that agree; the others
        are counted only near the starts that these propose. Starts agree that
        fall in one bin of SLACK words or the next.
        """
        mine = np.isin(word, self.own[t])
        place, word, need = place[mine], word[mine], self.need[t]
        held = np.unique(word)
        rare = held[np.argsort(self.rarity[held])][:len(held) - need + 1]

        def starts(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Start proposed by each pair of a place and a position of the same word."""
            position = np.flatnonzero(np.isin(self.texts[t], words))
            position = position[np.argsort(self.texts[t][position], kind="stable")]
            owner = self.texts[t][position]
            here = np.isin(word, words)
            p, w = place[here], word[here]
            lo, hi = np.searchsorted(owner, w, "left"), np.searchsorted(owner, w, "right")
            n = hi - lo
            at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            return np.repeat(p, n) - position[at], np.repeat(w, n)

        first, _ = starts(rare)
        bins = np.unique(np.floor_divide(first, SLACK))
        near = np.unique(np.concatenate([bins - 1, bins]))                   # a bin and the next
        start, who = starts(held)
        bin_of = np.floor_divide(start, SLACK)
        out = []
        for b in near:
            here = (bin_of == b) | (bin_of == b + 1)
            n = len(np.unique(who[here]))
            if n >= need:
                out.append((int(start[here].min()), int(n)))
        return out


def _phrase_at(h: np.ndarray, doc: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Places where the phrase's words stand consecutively inside one document."""
    at = np.flatnonzero(h == phrase[0])
    for i in range(1, len(phrase)):
        at = at[at + i < len(h)]
        at = at[(h[at + i] == phrase[i]) & (doc[at + i] == doc[at])]
    return at


def _scan(batches, index: Index, base) -> Iterator[pa.RecordBatch]:
    base_words = [_hashes(p) for p, _ in base]
    for batch in batches:
        ids = batch.column(0)
        data, offsets = text_buffers(batch.column(1))
        for i, j, raw, off in chunks(data, offsets):
            h, _, _, first = words(raw, off, ALNUM)
            doc = np.repeat(np.arange(j - i), np.diff(first))
            n_words = np.diff(first)
            hits, labels, score = {}, {}, np.zeros(j - i)
            for (_, label), phrase in zip(base, base_words):
                for p in _phrase_at(h, doc, phrase):
                    hits.setdefault(int(doc[p]), []).append(int(p - first[doc[p]]))
                    labels.setdefault(int(doc[p]), set()).add(label)
            base_labels = {d: ",".join(sorted(x)) for d, x in labels.items()}
            score[list(labels)] = 1.0
            places, which = _lookup(h, index.words)
            for d, t in index.likely(doc[places], which, j - i):
                lo, hi = np.searchsorted(places, [first[d], first[d + 1]])
                length, agree = len(index.texts[t]), 0
                for start, n in index.places(t, places[lo:hi], which[lo:hi]):
                    a, b = max(first[d], start - SLACK), min(first[d + 1], start + length + 3 * SLACK)
                    if n > agree and len(_phrase_at(h[a:b], doc[a:b], index.phrases[t])):
                        agree = n
                if agree:
                    labels.setdefault(int(d), set()).add(index.labels[t])
                    score[d] = max(score[d], agree / len(index.own[t]))
            rows = range(j - i)
            yield pa.record_batch([
                ids.slice(i, j - i), pa.array(n_words, pa.int64()),
                pa.array([len(hits.get(d, ())) for d in rows], pa.int64()),
                pa.array([min(hits[d]) if d in hits else None for d in rows], pa.int64()),
                pa.array([max(hits[d]) if d in hits else None for d in rows], pa.int64()),
                pa.array([base_labels.get(d, "") for d in rows]),
                pa.array([",".join(sorted(labels.get(d, ()))) for d in rows]), pa.array(score)],
                names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES,
                  base=BASE) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row.

    Words are runs of ASCII letters and digits and of all other non-ASCII
    characters, lower-cased A-Z. A template is labelled where SHARE of its
    different words (of a short one all) propose starts of the template that
    lie in neighbouring bins of SLACK words, and its mandatory phrase stands
    there word by word. score is the largest share of a template's words that
    agree, 1 with a base phrase, 0 without any label. Null and empty texts have
    no words and empty labels; repeated rows and null ids are answered row by
    row; an empty table gives no rows. Only the two named columns are read.
    """
    index = Index(document_counts(docs, text_col, templates), templates)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(
        texts, lambda it: _scan(it, index, base),
        "id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double")
