"""License scan by an exact set-similarity join of text blocks with license templates (operator 4).

A template is a set of words, put in order of their frequency in the whole corpus, rarest first. A block contains a template
when it has at least ``threshold`` of its words. Such a block must hold one of the first ``size - needed + 1`` words of the
ordered template (prefix filter), must have enough distinct words (length filter), and from a common word on, neither
side may have too few words left in the order to reach the number needed (positional filter). What passes is counted.

A window of twice the template's words is slid word by word around the words of the prefix, where the filters leave a run of places:
passages are the runs, with the best containment of each, and no passage of up to twice the template's words is lost by where it starts.
Blocks, for those who want a fixed grid, are windows of the same length that each start half a window after the last. Templates are a stated set of bounded size and are
sent to every worker.

Beside this the scan reports base places: where a phrase's words stand one after the other.

Defined results: a null text counts as empty: no words, no places, no blocks; repeated rows are scanned as often as they
occur; templates without words are refused; equal frequencies are ordered by the word. Columns beside key and text are not
looked at.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill.llm.arrays import small_batches

# Phrases that are base places, and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Notices by which licenses announce themselves, and their labels.
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            " documentation files"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("reserved", "Copyright all rights reserved no part may be reproduced without permission"),
]
THRESHOLD = 0.8
# More words than this in all templates are refused.
TEMPLATE_WORDS = 100_000

# Letters A-Z become small; the other ASCII bytes that belong to no word become blanks.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return (text or "").encode().translate(_FOLD).split()


class Index:
    """Templates ordered by the frequency of their words, found by the words of their prefixes."""

    def __init__(self, templates: list[tuple[str, str]], frequency: dict[bytes, int], threshold: float, phrases: dict[str, str]):
        self.phrases = [(tuple(words_of(p)), label) for p, label in phrases.items()]
        self.templates, self.orders = [], []
        self.prefix: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        every = {w for _, text in templates for w in words_of(text)}
        self.place = {w: k for k, w in enumerate(sorted(every, key=lambda w: (frequency.get(w, 0), w)))}
        for number, (label, text) in enumerate(templates):
            words = words_of(text)
            if not words:
                raise ValueError(f"template of {label} has no words")
            ordered = sorted(set(words), key=self.place.__getitem__)
            needed = math.ceil(threshold * len(ordered) - 1e-9)
            self.templates.append((label, frozenset(ordered), len(words), needed))
            self.orders.append({w: k for k, w in enumerate(ordered)})
            for at, word in enumerate(ordered[: len(ordered) - needed + 1]):
                self.prefix[word].append((number, at))
        self.rare = frozenset(self.prefix)

    def base(self, folded: bytes, words: list[bytes]) -> list[tuple[str, int]]:
        """Label and first word of every place of a phrase."""
        out = []
        for phrase, label in self.phrases:
            if all(w in folded for w in phrase):
                at = -1
                while True:
                    try:
                        at = words.index(phrase[0], at + 1)
                    except ValueError:
                        break
                    if tuple(words[at : at + len(phrase)]) == phrase:
                        out.append((label, at))
        return sorted(out, key=lambda x: (x[1], x[0]))

    def blocks(self, words: list[bytes]) -> list[tuple[str, int, int, float]]:
        """Label, first word, end and containment of every block that holds a template."""
        if self.rare.isdisjoint(words):
            return []
        candidates: dict[tuple[int, int], int] = {}
        for at, word in enumerate(words):
            for number, place in self.prefix.get(word, ()):
                size = self.templates[number][2]
                for block in (at // size - 1, at // size):
                    if block >= 0:
                        key = (number, block)
                        candidates[key] = min(candidates.get(key, place), place)
        out = []
        for (number, block), place in sorted(candidates.items()):
            label, template, size, needed = self.templates[number]
            start = block * size
            held = set(words[start : start + 2 * size])
            if len(held) < needed:
                continue
            ranked = sorted(self.place[w] for w in held if w in self.place)
            first = min(self.place[w] for w in held if w in template)
            # words from the first common one on, on either side
            if min(len(template) - place, sum(r >= first for r in ranked)) < needed:
                continue
            common = len(held & template)
            if common >= needed:
                out.append((label, start, min(start + 2 * size, len(words)), common / len(template)))
        return out

    def passages(self, words: list[bytes]) -> list[tuple[str, int, int, float]]:
        """Label, first word, end and containment of the best window in every run of windows that hold a template."""
        if self.rare.isdisjoint(words):
            return []
        hits: dict[int, list[int]] = defaultdict(list)
        for at, word in enumerate(words):
            for number, _ in self.prefix.get(word, ()):
                hits[number].append(at)
        out = []
        for number, places in sorted(hits.items()):
            label, template, size, needed = self.templates[number]
            width, k = 2 * size, 0
            while k < len(places):
                # hits whose windows meet are looked at together, from the first window that has one to the last
                low, last = max(0, places[k] - width + 1), places[k]
                while k < len(places) and places[k] - last < width:
                    last, k = places[k], k + 1
                high = min(len(words), last + width)
                # what rules out the whole run rules out its windows: too few words, or too few from the first common one on
                held_words, order = set(words[low:high]), self.orders[number]
                if len(held_words) < needed:
                    continue
                rarest = min(held_words & template, key=order.__getitem__)
                behind = sum(self.place.get(w, -1) >= self.place[rarest] for w in held_words)
                if min(len(template) - order[rarest], behind) < needed:
                    continue
                # the places of the template's words; a window that is best begins at one of them
                found = [at for at in range(low, high) if words[at] in template]
                if len(found) < needed:
                    continue
                held: Counter = Counter()
                end, best, until = 0, None, -1
                for at in found:
                    while end < len(found) and found[end] < at + width:
                        held[words[found[end]]] += 1
                        end += 1
                    if len(held) >= needed:
                        if best is not None and at >= until:
                            out.append(best)
                            best = None
                        if best is None or len(held) / len(template) > best[3]:
                            best = (label, at, min(at + width, len(words)), len(held) / len(template))
                        until = at + width
                    held[words[at]] -= 1
                    if not held[words[at]]:
                        del held[words[at]]
                if best is not None:
                    out.append(best)
        return out


def word_frequencies(df: DataFrame, text: str, wanted: set[bytes]) -> dict[bytes, int]:
    """How often each of the wanted words occurs in all texts."""
    if len(wanted) > TEMPLATE_WORDS:
        raise ValueError(f"more than {TEMPLATE_WORDS} words in the templates")

    def task(batches):
        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column("text").to_pylist():
                words = words_of(value)
                if not wanted.isdisjoint(words):
                    seen.update(w for w in words if w in wanted)
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.binary()), "times": pa.array(list(seen.values()), pa.int64())})

    counted = small_batches(df).select(F.col(text).alias("text")).mapInArrow(task, "word binary, times long")
    return {bytes(r["word"]): r["times"] for r in counted.groupBy("word").agg(F.sum("times").alias("times")).collect()}


_SCHEMA = [
    T.StructField("n_words", T.LongType()),
    T.StructField("places", T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("word", T.LongType())]))),
    T.StructField("blocks", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("first", T.LongType()),
        T.StructField("end", T.LongType()), T.StructField("containment", T.DoubleType()),
    ]))),
]
_SCHEMA.append(T.StructField("passages", _SCHEMA[-1].dataType))
_PLACES = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
_BLOCKS = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())]))


def scan(
    df: DataFrame, key: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] = TEMPLATES,
    phrases: dict[str, str] = PHRASES, threshold: float = THRESHOLD, grid: bool = True,
) -> DataFrame:
    """key, n_words, base places (label, first word), blocks and passages (label, first word, end, containment) of every row.

    Without ``grid`` blocks are not looked for and empty.
    """
    wanted = {w for _, t in templates for w in words_of(t)}
    index = Index(templates, word_frequencies(df, text, wanted), threshold, phrases)
    sent = df.sparkSession.sparkContext.broadcast(index)
    narrow = small_batches(df).select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([narrow.schema["key"], *_SCHEMA])

    def task(batches):
        own = sent.value
        for batch in batches:
            counts, places, blocks, passages = [], [], [], []
            for value in batch.column("text"):
                folded = (value.as_py() or "").encode().translate(_FOLD)
                words = folded.split()
                counts.append(len(words))
                places.append([{"label": a, "word": b} for a, b in own.base(folded, words)])
                blocks.append([dict(zip(("label", "first", "end", "containment"), b, strict=True)) for b in (own.blocks(words) if grid else ())])
                passages.append([dict(zip(("label", "first", "end", "containment"), b, strict=True)) for b in own.passages(words)])
            arrays = [
                batch.column("key"), pa.array(counts, pa.int64()), pa.array(places, _PLACES), pa.array(blocks, _BLOCKS), pa.array(passages, _BLOCKS)
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return narrow.mapInArrow(task, schema).withColumnRenamed("key", key)


def report(docs: DataFrame) -> DataFrame:
    """doc_id with the number of words, base places, their labels, all labels and the best containment."""
    joined = lambda names: F.array_join(F.array_sort(F.array_distinct(names)), ",")
    base, method = F.col("places.label"), F.col("passages.label")
    return scan(docs, grid=False).select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.word").alias("first_word"),
        F.array_max("places.word").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, method)).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("passages.containment"), F.lit(0.0))).alias("score"),
    )
