"""Licence scans by a positional rare-token index.

Templates are short licence texts. Each is indexed by its rarest words, by counts over all documents:
word -> (template, place). A document looks up its highest-IDF licence words; a place in the document less
the place in the template says where the template would begin, and the places that several rare words
agree on are aligned word by word. A template counts if enough of its words stand there and its mandatory
key phrases do, word for word; these hold what tells licences apart. Where templates overlap the one with
the most words wins. Base phrases are templates that must stand whole; all their places are found.

Defined cases: null and empty texts have no words and no licence; repeated rows get equal results; ties of
words go to the smaller name; very long texts are read whole, in time in proportion to their length; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ensure, in_arrow, in_pieces, map_batches, table

#: The base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Licence texts and notices, and short references, as their publishers word them; with each the phrases that must stand in it.
_MIT = """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software
to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell
copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice
and this permission notice shall be included in all copies or substantial portions of the software"""
_AS_IS = """the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability
whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"""
_BSD = """redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form
must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"""
_GNU = "this program is free software you can redistribute it and or modify it under the terms of the gnu {} as published by the free software foundation either version {} of the license or at your option any later version"
TEMPLATES = {
    "apache-2.0": ("licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    "apache-2.0-header": ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at", ("apache license", "in compliance with the license")),
    "apache-2.0-text": ("apache license version 2 0 january 2004 http www apache org licenses terms and conditions for use reproduction and distribution 1 definitions license shall mean the terms and conditions for use reproduction and distribution as defined by sections 1 through 9 of this document", ("apache license", "version 2 0")),
    "mit-line": ("released under the mit license", ("mit license",)),
    "mit-notice": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted", "without restriction")),
    "mit-text": (f"{_MIT} {_AS_IS}", ("permission is hereby granted", "without restriction", "provided as is")),
    "gpl-3.0": ("gnu general public license version 3", ("gnu general public license", "version 3")),
    "gpl-2.0": ("gnu general public license version 2", ("gnu general public license", "version 2")),
    "lgpl-3.0": ("gnu lesser general public license version 3", ("gnu lesser general public license", "version 3")),
    "lgpl-2.1": ("gnu lesser general public license version 2 1", ("gnu lesser general public license", "version 2 1")),
    "lgpl-2.0": ("gnu library general public license version 2", ("gnu library general public license", "version 2")),
    "agpl-3.0": ("gnu affero general public license version 3", ("gnu affero general public license", "version 3")),
    "gpl-notice": (_GNU.format("general public license", "3").split(" either")[0], ("free software", "gnu general public license")),
    "gpl-3.0-or-later": (_GNU.format("general public license", "3"), ("gnu general public license", "either version 3", "any later version")),
    "gpl-2.0-or-later": (_GNU.format("general public license", "2"), ("gnu general public license", "either version 2", "any later version")),
    "lgpl-3.0-or-later": (_GNU.format("lesser general public license", "3"), ("gnu lesser general public license", "either version 3", "any later version")),
    "lgpl-2.1-or-later": (_GNU.format("lesser general public license", "2 1"), ("gnu lesser general public license", "either version 2 1", "any later version")),
    "agpl-3.0-or-later": (_GNU.format("affero general public license", "3"), ("gnu affero general public license", "either version 3", "any later version")),
    "bsd-notice": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("source and binary forms", "following conditions are met")),
    "bsd-2-clause": (_BSD, ("source and binary forms", "following conditions are met", "must reproduce the above copyright notice")),
    "bsd-3-clause": (f"{_BSD} neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ("source and binary forms", "must reproduce the above copyright notice", "endorse or promote products")),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee",)),
    "zlib": ("this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely", ("permission is granted to anyone", "redistribute it freely")),
    "unlicense": ("this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software", ("free and unencumbered software", "public domain")),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license", "v 2 0")),
    "epl-2.0": ("this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", ("eclipse public license", "2 0")),
    "epl-1.0": ("this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", ("eclipse public license", "v1 0")),
    "cc0-1.0": ("to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", ("waived all copyright and related or neighboring rights",)),
    "cc-by-4.0": ("licensed under cc by 4 0", ("cc by 4 0",)),
    "cc-by-sa-4.0": ("licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    "cc-by-nd-4.0": ("licensed under cc by nd 4 0", ("cc by nd 4 0",)),
    "cc-by-nc-sa-4.0": ("licensed under cc by nc sa 4 0", ("cc by nc sa 4 0",)),
    "cc-by-nc-nd-4.0": ("licensed under cc by nc nd 4 0", ("cc by nc nd 4 0",)),
    "cc-by-text": ("this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    "cc-by-sa-text": ("this work is licensed under a creative commons attribution sharealike 4 0 international license", ("attribution sharealike 4 0",)),
    "cc-by-nc-text": ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", ("attribution noncommercial 4 0",)),
    "proprietary": ("copyright all rights reserved", ("all rights reserved",)),
}
RARE_WORDS = 6  # of a template that are indexed
AGREE = 0.5  # of a template's indexed places that must name the same beginning
COVER = 0.75  # of a template's words that must stand at their places
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The contract's words: ASCII other than letters and digits parts them, A-Z are lower-cased."""
    return (text or "").encode().translate(TABLE).split()


class Index:
    """Templates by their rarest words."""

    def __init__(self, counts: dict[bytes, int], n_docs: int, templates=TEMPLATES, base=BASE):
        self.idf = lambda w: math.log((1 + n_docs) / (1 + counts.get(w, 0)))
        self.templates = {name: [w.encode() for w in text.split()] for name, (text, _) in templates.items()}
        self.keys = {name: [[w.encode() for w in k.split()] for k in keys] for name, (_, keys) in templates.items()}
        self.base = [([w.encode() for w in phrase.split()], label) for phrase, label in base]
        self.postings: dict[bytes, list[tuple[str, int]]] = {}
        self.needed: dict[str, int] = {}
        for name, words in self.templates.items():
            rare = sorted(set(words), key=lambda w: (-self.idf(w), w))[:RARE_WORDS]
            for w in rare:
                self.postings.setdefault(w, []).extend((name, i) for i, x in enumerate(words) if x == w)
            self.needed[name] = max(min(2, len(rare)), math.ceil(AGREE * sum(x in rare for x in words)))
        self.base_at: dict[bytes, list[tuple[int, int]]] = {}
        for k, (words, _) in enumerate(self.base):
            at = max(range(len(words)), key=lambda i: (self.idf(words[i]), -i))
            self.base_at.setdefault(words[at], []).append((k, at))
        self.rare = frozenset(self.postings) | frozenset(self.base_at)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[int, str, float]]]:
        """Places (start, base phrase), and (start, template, coverage) of the templates found, in order."""
        places: dict[bytes, list[int]] = {}
        rare = self.rare
        for i in [i for i, w in enumerate(words) if w in rare]:
            places.setdefault(words[i], []).append(i)
        if not places:
            return [], []
        base = []
        for w, where in places.items():
            for k, at in self.base_at.get(w, ()):
                phrase = self.base[k][0]
                base += [(i - at, k) for i in where if i >= at and words[i - at : i - at + len(phrase)] == phrase]
        votes: Counter = Counter()
        for w in sorted(places, key=lambda w: (-self.idf(w), w)):
            for name, at in self.postings.get(w, ()):
                for i in places[w]:
                    votes[name, i - at] += 1
        found = [(name, start, cover) for (name, start), n in votes.items() if n >= self.needed[name] and (cover := self.coverage(name, start, words))]
        return sorted(base), longest(found, self.templates)

    def coverage(self, name: str, start: int, words: list[bytes]) -> float:
        """The share of a template's words that stand where it would begin at `start`; 0 if they are too few or a key phrase lacks."""
        template = self.templates[name]
        here = words[max(0, start) : start + len(template)]
        cover = sum(a == b for a, b in zip(template[max(0, -start) :], here, strict=False)) / len(template)
        if cover < COVER or not all(any(here[j : j + len(k)] == k for j in range(len(here) - len(k) + 1)) for k in self.keys[name]):
            return 0.0
        return cover


def longest(found: list[tuple[str, int, float]], templates: dict[str, list[bytes]]) -> list[tuple[int, str, float]]:
    """(start, template, coverage) without those that overlap one with more words at their places."""
    taken: list[tuple[int, int]] = []  # apart from each other and in order
    out = []
    for name, start, cover in sorted(found, key=lambda x: (-x[2] * len(templates[x[0]]), x[0], x[1])):
        end = start + len(templates[name])
        at = bisect_left(taken, (start, end))
        if (at and taken[at - 1][1] > start) or (at < len(taken) and taken[at][0] < end):
            continue
        taken.insert(at, (start, end))
        out.append((start, name, cover))
    return sorted(out)


def licence_words(templates=TEMPLATES, base=BASE) -> frozenset[bytes]:
    return frozenset(w.encode() for text in [*(t for t, _ in templates.values()), *(p for p, _ in base)] for w in text.split())


def document_counts(docs: DataFrame, vocabulary: frozenset[bytes]) -> tuple[dict[bytes, int], int]:
    """In how many of all documents each word of the (short, fixed) vocabulary stands, and how many documents there are."""

    def run(batches):
        counts: Counter = Counter()
        n = 0
        for batch in in_pieces(batches):
            n += batch.num_rows
            for text in batch.column("text"):
                counts.update(vocabulary.intersection(words_of(text.as_py())))
        rows = [(w.decode(), c) for w, c in counts.items()] + [("", n)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.string(), pa.int64()), strict=True)], names=["word", "n"])

    rows = in_arrow(docs.select("text"), run, "word string, n long").groupBy("word").agg(F.sum("n")).collect()  # as many rows as the vocabulary has words
    counts = {r[0].encode(): r[1] for r in rows}
    return counts, counts.pop(b"", 0)


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan_licences(docs: DataFrame, templates=TEMPLATES, base=BASE) -> DataFrame:
    """Of (doc_id, text): base places and labels, the labels of all templates found, and the best coverage."""
    docs = ensure(docs, doc_id="long", text="string")
    counts, n_docs = document_counts(docs, licence_words(templates, base))

    def make():
        index = Index(counts, n_docs, templates, base)

        def one(text: str | None) -> tuple:
            words = words_of(text)
            places, found = index.scan(words)
            own = {base[k][1] for _, k in places}
            score = max([0.0, *(c for _, _, c in found), *([0.5] if places else [])])
            return len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted(own)), ",".join(sorted(own | {name for _, name, _ in found})), score

        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            cols = zip(*(one(x.as_py()) for x in batch.column("text")), strict=True)
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=[x.split()[0] for x in SCHEMA.split(", ")])

        return step

    return map_batches(docs, SCHEMA, make)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences in every whole text of documents."""
    return scan_licences(table(spark, sf_dir, "documents"))
