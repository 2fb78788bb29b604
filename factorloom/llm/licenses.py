"""License scan: an exact set-similarity join of text blocks with license templates.

A template of w words belongs to the size class s, the least power of two of at least w (and of LEAST). A text is cut into blocks
of 2s words for each class, a block starting every s words, so that any s consecutive words lie within one block. A block and a
template match if the block holds at least ``containment`` of the template's distinct words.

Words are ordered by their number in all texts of the table, rarest first. A template of n distinct words that needs k of
them in a block shares one of its first n - k + 1 (its prefix) with every block that it matches, and the block has that
word among all but its last k - 1. Blocks without k template words are too short; a shared word at places i and j leaves at
most 1 + min(n - i, m - j) - 1 common words, which drops pairs early. What remains is verified. Words of no template change no
overlap, so blocks hold template words alone; templates are a parameter, which each task holds whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, whole_text

# Fixed values of the contract: label and phrase
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

# The usual notices of public licenses
TEMPLATES = [
    ("agpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General"
               " Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
                 " http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
            " following conditions are met"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl-2", "GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("gpl-3", "GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            " documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mpl-2", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
CONTAINMENT = Fraction(8, 10)
LEAST = 4  # words of the smallest size class
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.translate(LOWER))


def needed(n: int, containment=CONTAINMENT) -> int:
    """Distinct words of n that a block has to hold."""
    return max(1, math.ceil(n * containment))


def size_class(n_words: int) -> int:
    return max(LEAST, 1 << (n_words - 1).bit_length())


class Index:
    """Templates by the words of their prefixes; words as ranks in the global order (``counts`` of words, then the word)."""

    def __init__(self, templates, counts, containment=CONTAINMENT):
        worded = [(label, words_of(text)) for label, text in templates]
        vocabulary = sorted({w for _, words in worded for w in words}, key=lambda w: (counts.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(vocabulary)}
        self.templates, self.prefixes, self.sizes = [], {}, {}
        for label, words in worded:
            if not words:
                continue
            ranks = sorted({self.rank[w] for w in words})
            k, number, size = needed(len(ranks), containment), len(self.templates), size_class(len(words))
            self.templates.append((label, frozenset(ranks), k))
            least, by_rank = self.sizes.get(size, (len(ranks), {}))
            for i, r in enumerate(ranks[:len(ranks) - k + 1]):
                by_rank.setdefault(r, []).append((number, i))
            self.sizes[size] = min(least, k), by_rank
        self.rare = {vocabulary[r] for _, by_rank in self.sizes.values() for r in by_rank}

    def matches(self, words: list[str]) -> Iterator[tuple[int, int, int, int]]:
        """(template, first word, end word, common words) of every block that meets the threshold, each once."""
        if self.rare.isdisjoint(words):
            return
        found = [(i, self.rank[w]) for i, w in enumerate(words) if w in self.rank]
        for size, (least, by_rank) in self.sizes.items():
            blocks: dict[int, set[int]] = {}
            for i, r in found:
                at = i // size
                blocks.setdefault(at, set()).add(r)
                if at:
                    blocks.setdefault(at - 1, set()).add(r)
            for at, held in blocks.items():
                m = len(held)
                if m < least or by_rank.keys().isdisjoint(held):
                    continue
                tried = set()
                for j, r in enumerate(sorted(held)[:m - least + 1]):
                    for number, i in by_rank.get(r, ()):
                        if number in tried:
                            continue
                        _, ranks, k = self.templates[number]
                        if m < k or j > m - k:  # too short, or past the block's prefix for this template
                            continue
                        # of the first word shared nothing lies before it in both, so what follows bounds the overlap
                        tried.add(number)
                        if min(len(ranks) - i, m - j) < k:
                            continue
                        common = len(ranks & held)
                        if common >= k:
                            yield number, at * size, min(len(words), (at + 2) * size), common


def word_counts(docs: DataFrame, templates) -> dict[str, int]:
    """How often each word of the templates occurs in all texts."""
    vocabulary = frozenset(w for _, text in templates for w in words_of(text))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for frame in frames:
            for text in frame["text"]:
                total.update(w for w in words_of(text) if w in vocabulary)
        if total:
            yield pd.DataFrame({"word": list(total), "n": list(total.values())})

    rows = docs.select(whole_text().alias("text")).mapInPandas(count, "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n")).collect()  # a row per template word at most
    return {r.word: r.n for r in rows}


FOUND = ("n_words long, n_base long, first_word long, last_word long, base_labels array<string>,"
         " blocks array<struct<label: string, template: int, first_word: int, end_word: int, containment: double>>")


def places(words: list[str], phrases) -> Iterator[tuple[int, str]]:
    """Starts of the phrases, with their labels."""
    for label, phrase in phrases:
        k, at, rarest = len(phrase), -1, phrase[-1]
        while True:
            try:
                at = words.index(rarest, at + 1)
            except ValueError:
                break
            if at >= k - 1 and words[at - k + 1:at + 1] == phrase:
                yield at - k + 1, label


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, containment=CONTAINMENT) -> DataFrame:
    """``docs`` with one struct column ``licenses`` (named otherwise if that is taken): number of words, places of the phrases,
    and every block that meets the threshold with its template, label, span in words and containment.

    A null text is empty; an empty text has no words and no blocks; texts of any length are read whole. Rows that repeat
    are scanned each. An empty table stays empty; other columns stay as they are.
    """
    index = Index(templates, word_counts(docs, templates), containment)
    phrases = [(label, words_of(phrase)) for label, phrase in phrases]

    @F.pandas_udf(FOUND)
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            words = words_of(text)
            base = sorted(places(words, phrases))
            blocks = [(index.templates[t][0], t, start, end, common / len(index.templates[t][1]))
                      for t, start, end, common in index.matches(words)]
            rows.append((len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None,
                         sorted({label for _, label in base}), sorted(blocks, key=lambda b: (b[2], b[3], b[1]))))
        frame = pd.DataFrame(rows, columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "blocks"])
        return frame.astype({"first_word": "Int64", "last_word": "Int64"})

    return docs.withColumn(free_name(docs, "licenses"), find(whole_text()))


def digest(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs``: the counts, ``base_labels``, ``labels`` and ``score``, which is 1 with a phrase and else the
    highest containment of a matching block (0 without one). ``n_blocks`` counts the matches of blocks and templates."""
    found = scan(docs.select("doc_id", "text"))
    at = F.col("licenses")
    labels = F.array_sort(F.array_distinct(F.concat(at["base_labels"], F.transform(at["blocks"], lambda b: b["label"]))))
    best = F.coalesce(F.array_max(F.transform(at["blocks"], lambda b: b["containment"])), F.lit(0.0))
    return found.select("doc_id", at["n_words"].alias("n_words"), at["n_base"].alias("n_base"), at["first_word"].alias("first_word"),
                        at["last_word"].alias("last_word"), F.array_join(at["base_labels"], ",").alias("base_labels"),
                        F.array_join(labels, ",").alias("labels"), F.when(at["n_base"] > 0, 1.0).otherwise(best).alias("score"),
                        F.size(at["blocks"]).cast("long").alias("n_blocks"))


def _sql() -> str:
    values, sizes = [], []
    for number, (label, text) in enumerate(TEMPLATES):
        words = words_of(text)
        sizes.append(f"({number}, '{label}', {size_class(len(words))}, {len(set(words))})")
        values += [f"({number}, '{w}')" for w in sorted(set(words))]
    phrases = [f"('{label}', [{', '.join(repr(w) for w in words_of(p))}])" for label, p in PHRASES]
    return fr"""with texts as materialized (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents),
words as materialized (select r, unnest(words) as word, unnest(range(len(words))) as i from texts),
phrases(label, phrase) as (values {', '.join(phrases)}),
places as (select r, i, label from words join texts using (r) join phrases on phrase[1] = word
  where words[i + 1:i + len(phrase)] = phrase),
base as (select r, count(*) as n_base, min(i) as first_word, max(i) as last_word, list(distinct label) as labels from places group by r),
templates(template, label, size, n) as (values {', '.join(sizes)}),
vocabulary(template, word) as (values {', '.join(values)}),
held as (select r, template, size, n, label, word, i // size as block from words join vocabulary using (word) join templates using (template)),
blocks as (select r, template, label, n, count(distinct word) as common
  from (select * from held union all select * replace (block - 1 as block) from held where block > 0) group by r, template, label, n, block
  having 10 * count(distinct word) >= 8 * n),
best as (select r, count(*) as n_blocks, max(common / n) as score, list(distinct label) as labels from blocks group by r)
select doc_id, len(words)::bigint as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(best.labels, [])))), ','), '') as labels,
  case when n_base > 0 then 1.0 else coalesce(score, 0) end::double as score, coalesce(n_blocks, 0) as n_blocks
from texts left join base using (r) left join best using (r)"""


SQL = _sql()
