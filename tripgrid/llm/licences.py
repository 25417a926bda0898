"""Licence scan by a trained paragraph classifier (operator 9).

A piece of text is a sparse vector of hashed word 1-, 2- and 3-grams. A
multinomial logistic regression tells licence families and an unknown class
apart. Pieces are overlapping windows of words over every run of lines without
a blank one between, as notices are often wrapped or stand within long lines,
and the paragraphs (lines of the text) that are no longer than a window. It is trained on variants of the templates (words
dropped, other versions, other text around them) and on a bounded sample of
the corpus's own paragraphs: their windows unlike every template are examples
of the unknown class. The scores are calibrated on a part of these rows held out from
the fit (a temperature and an offset of the unknown class). A piece that the
classifier gives to a family is confirmed by comparison with the family's
templates: enough of a template's word bigrams must occur in it. A paragraph
is also confirmed if it is little but the heading of a licence. Of pieces whose
matched words overlap, the one with most matched bigrams is the notice.

Only n-grams of the templates have weights, so scanning looks up every n-gram
of every whole text, and the model is small and of fixed size.

Defined results: a null or empty text has no paragraphs; blank lines are no
paragraphs; repeated notices count each, a wrapped one once; a piece has the
family of the highest probability, ties going to the first in ``FAMILIES``; an
empty table
gives an empty result; null ids and repeated rows are scanned like others;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import mix

# Licence notices as they stand in documents, by family.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ),
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "MPL": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "CC BY": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC BY-NC": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC BY-SA": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
}
# Headings of licence texts, which stand in a line of their own.
HEADINGS = {
    "MIT": ("MIT License", "The MIT License (MIT)"),
    "Apache": ("Apache License", "Apache License, Version 2.0"),
    "GPL": ("GNU General Public License", "GNU General Public License, version 3"),
    "LGPL": ("GNU Lesser General Public License", "GNU Lesser General Public License, version 2.1"),
    "BSD": ("BSD 3-Clause License", "The BSD License"),
    "MPL": ("Mozilla Public License", "Mozilla Public License, version 2.0"),
    "CC BY": ("Creative Commons Attribution 4.0 International",),
    "CC BY-NC": ("Creative Commons Attribution-NonCommercial 4.0 International",),
    "CC BY-SA": ("Creative Commons Attribution-ShareAlike 4.0 International",),
}
FAMILIES = tuple(TEMPLATES)
UNKNOWN = len(FAMILIES)

# Words, none at all, that stand around notices or look like them; examples of the unknown class.
DISTRACTORS = (
    "He renewed his driving license last week.",
    "The general public was free to use the library.",
    "A copy of the work is free of charge for any person.",
    "Version 2.0 of the program was released in March.",
    "The terms of use apply to this source of income.",
)

BITS = 20
NGRAMS = 3
VARIANTS = 60
# The corpus part of the training rows: at most this many paragraphs of at most this many characters.
SAMPLE_ROWS = 2000
SAMPLE_CHARS = 1200
PENALTY = 1e-3
CONFIRM = 0.6
# Words of the windows and the step between them; any 25 words in a row lie in a window.
WINDOWS = ((12, 4), (32, 8))
SEED = 9

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_TABLE = np.random.Generator(np.random.PCG64(SEED)).integers(0, 1 << 64, size=64 * 256, dtype=np.uint64)
_FACTOR = np.random.Generator(np.random.PCG64(SEED + 1)).integers(0, 1 << 64, size=8, dtype=np.uint64) | np.uint64(1)


def text_words(data: bytes | pa.Buffer) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Hashes of the words of a text, the paragraph and the block each is in, and the number of paragraphs.

    Paragraphs are lines with at least one character that is not blank; blocks
    are runs of them without a blank line between. Numbers count from 0.
    """
    codes = np.frombuffer(data, dtype=np.uint8)
    newline = codes == 10
    line = np.cumsum(newline)
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    lines = np.unique(line[~blank])
    inside = _WORD[codes]
    starts = np.flatnonzero(inside & np.append(True, ~inside[:-1])) if len(codes) else np.empty(0, dtype=np.int64)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), len(lines)
    at = np.flatnonzero(inside)
    heads = np.searchsorted(at, starts)
    lengths = np.diff(np.append(heads, len(at)))
    place = np.arange(len(at)) - np.repeat(heads, lengths)
    words = mix(np.add.reduceat(_TABLE[(place % 64) * 256 + _LOWER[codes[at]]], heads) + lengths.astype(np.uint64))
    paragraph = np.searchsorted(lines, line[starts])
    block = np.cumsum(np.append(False, np.diff(lines) > 1))
    return words, paragraph, block[paragraph], len(lines)


def word_grams(words: np.ndarray, block: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Hashes of the n-grams of words and the word each starts at, for n = 1, 2, 3; none runs across blocks."""
    grams, places = [], []
    for n in range(1, NGRAMS + 1):
        m = max(0, len(words) - n + 1)
        value = np.full(m, np.uint64(n))
        for k in range(n):
            value += words[k : k + m] * _FACTOR[k + n]
        same = np.flatnonzero(block[:m] == block[n - 1 : n - 1 + m])
        grams.append(mix(value)[same])
        places.append(same)
    return grams, places


def text_grams(text: str) -> list[np.ndarray]:
    """Hashes of the n-grams of a text taken as one line."""
    words, _, _, _ = text_words(text.encode())
    return word_grams(words, np.zeros(len(words), dtype=np.int64))[0]


def pieces(paragraph: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """First word and end of the paragraphs that fit in a window, then of the windows, and the number of the former."""
    n = len(paragraph)
    starts = np.flatnonzero(np.append(True, paragraph[1:] != paragraph[:-1]))
    ends = np.append(starts[1:], n)
    fits = ends - starts <= WINDOWS[-1][0]
    starts, ends = starts[fits], ends[fits]
    heads = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    sizes = np.diff(np.append(heads, n))
    place, left = np.arange(n) - np.repeat(heads, sizes), np.repeat(heads + sizes, sizes) - np.arange(n)
    firsts, lasts = [starts], [ends]
    for size, step in WINDOWS:
        first = np.flatnonzero((place % step == 0) & ((place == 0) | (left > size - step)))
        firsts.append(first)
        lasts.append(first + np.minimum(size, left[first]))
    return np.concatenate(firsts), np.concatenate(lasts), len(starts)


@dataclass
class Model:
    slots: np.ndarray  # gram bucket -> row of weights, or -1
    weights: np.ndarray  # rows x (families + unknown)
    bias: np.ndarray
    scale: float
    templates: list[tuple[int, np.ndarray]]  # family, sorted bigram hashes
    headings: list[tuple[int, np.ndarray]]

    def slot(self, grams: np.ndarray) -> np.ndarray:
        return self.slots[(grams >> np.uint64(64 - BITS)).astype(np.int64)]

    def probabilities(self, grams, places, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class probabilities of pieces of a text, and which of them have any known n-gram."""
        scores = np.zeros((len(first), UNKNOWN + 1))
        touched = np.zeros(len(first), dtype=bool)
        for n, (gram, place) in enumerate(zip(grams, places, strict=True), start=1):
            slot = self.slot(gram)
            at, slot = place[slot >= 0], slot[slot >= 0]
            sums = np.concatenate([np.zeros((1, UNKNOWN + 1)), np.cumsum(self.weights[slot], axis=0)])
            low = np.searchsorted(at, first)
            high = np.maximum(low, np.searchsorted(at, end - n + 1))
            scores += sums[high] - sums[low]
            touched |= high > low
        scores = self.scale * scores / np.sqrt(np.maximum(end - first, 1))[:, None] + self.bias
        return _softmax(scores), touched

    def scan(self, data) -> tuple[int, list[tuple[int, bool]]]:
        """Number of paragraphs, and (family, confirmed) of each notice in the text."""
        words, paragraph, block, n_paragraphs = text_words(data)
        if not len(words):
            return n_paragraphs, []
        grams, places = word_grams(words, block)
        first, end, n_lines = pieces(paragraph, block)
        p, touched = self.probabilities(grams, places, first, end)
        best = p.argmax(axis=1)
        found = []
        for k in np.flatnonzero(touched & (best != UNKNOWN)).tolist():
            a, b = int(first[k]), int(end[k])
            low, high = np.searchsorted(places[1], [a, b - 1])
            sure, matched, span = self._match(int(best[k]), grams[1][low:high], places[1][low:high], k < n_lines)
            found.append((not sure, -matched, b - a, -p[k, best[k]], span or (a, b), int(best[k]), sure))
        notices: list[tuple[int, bool]] = []
        taken: list[tuple[int, int]] = []
        for *_, (a, b), family, sure in sorted(found):
            if all(b <= c or d <= a for c, d in taken):
                taken.append((a, b))
                notices.append((family, sure))
        return n_paragraphs, notices

    def _match(self, family: int, bigrams: np.ndarray, at: np.ndarray, line: bool) -> tuple[bool, int, tuple[int, int] | None]:
        """Whether a piece is confirmed, how many bigrams it shares with the best template, and where from and to."""
        sure, best, span = False, 0, None
        for known in (self.templates, self.headings) if line else (self.templates,):
            for f, t in known:
                if f != family:
                    continue
                shared = np.isin(t, bigrams)
                enough = shared.mean() >= CONFIRM
                if known is self.headings:
                    enough &= np.isin(bigrams, t).sum() >= CONFIRM * len(bigrams)
                if (enough, shared.sum()) > (sure, best):
                    where = at[np.isin(bigrams, t)]
                    sure, best, span = bool(enough), int(shared.sum()), (int(where[0]), int(where[-1]) + 2)
        return sure, best, span


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _bigrams(texts: dict[str, tuple[str, ...]]) -> list[tuple[int, np.ndarray]]:
    return [(f, np.unique(text_grams(t)[1])) for f, name in enumerate(FAMILIES) for t in texts[name]]


def _variants(rng: np.random.Generator, fillers: list[str]) -> list[tuple[str, int]]:
    """Training texts made of the templates, and of pieces too small to name a family."""
    out = []
    for f, name in enumerate(FAMILIES):
        for template in (*TEMPLATES[name], *HEADINGS[name]):
            words = template.split()
            for _ in range(VARIANTS):
                kept = [w for w in words if rng.random() > 0.08]
                kept = [w.translate(str.maketrans("0123456789", "".join(map(str, rng.permutation(10))))) if any(c.isdigit() for c in w) else w for w in kept]
                around = [rng.choice(fillers).split() if fillers and rng.random() < 0.3 else [] for _ in range(2)]
                text = " ".join([*around[0][: rng.integers(1, 8)], *kept, *around[1][: rng.integers(1, 8)]])
                out.append((text.upper() if rng.random() < 0.1 else text, f))
            for _ in range(VARIANTS // 3):  # a few words of a notice are no notice
                some = rng.choice(words, size=min(len(words), 2), replace=False)
                filler = rng.choice(fillers).split() if fillers else ["text"]
                out.append((" ".join([*filler, *some]), UNKNOWN))
    return out + [(d, UNKNOWN) for d in DISTRACTORS for _ in range(VARIANTS // 3)]


def _cut(text: str) -> list[str]:
    """A text in pieces of a window's words, one after the other."""
    words, size = text.split(), WINDOWS[-1][0]
    return [" ".join(words[i : i + size]) for i in range(0, len(words), size)]


def sample_paragraphs(df: DataFrame, text_col: str = "text") -> list[str]:
    """The first SAMPLE_CHARS characters of the SAMPLE_ROWS different paragraphs whose hashes are least.

    All paragraphs of all documents take part, whatever their order and
    partitions. Those under a hash that about eight times as many reach are put
    in order; the hashes of equal paragraphs are equal, so copies do not crowd
    out others.
    """
    lines = df.select(F.explode(F.split(F.col(text_col), "\n")).alias("line")).where(F.trim("line") != "")
    lines = lines.select(F.substring("line", 1, SAMPLE_CHARS).alias("line"), F.xxhash64("line").alias("hash"))
    different = lines.agg(F.approx_count_distinct("hash")).first()[0]
    if different > 8 * SAMPLE_ROWS:
        lines = lines.where(F.col("hash") < F.lit(-(1 << 63) + (8 * SAMPLE_ROWS << 64) // different))
    return [r.line for r in lines.distinct().orderBy("hash", "line").limit(SAMPLE_ROWS).collect()]


def train(paragraphs: list[str]) -> Model:
    """Fit and calibrate the classifier on templates and a bounded list of paragraphs."""
    from .quality import _minimize

    rng = np.random.Generator(np.random.PCG64(SEED))
    templates = _bigrams(TEMPLATES)
    known = np.unique(np.concatenate([t for _, t in templates]))

    def unlike(text: str) -> bool:
        bigrams = text_grams(text)[1]
        return all(np.isin(t, bigrams).mean() < 0.2 for _, t in templates) if np.isin(bigrams, known).any() else True

    plain = [w for p in paragraphs for w in _cut(p) if unlike(w)]
    rows = _variants(rng, plain) + [(p, UNKNOWN) for p in plain]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    grams = np.concatenate([g for name in FAMILIES for t in (*TEMPLATES[name], *HEADINGS[name]) for g in text_grams(t)])
    slots = np.full(1 << BITS, -1, dtype=np.int32)
    buckets = np.unique(grams >> np.uint64(64 - BITS)).astype(np.int64)
    slots[buckets] = np.arange(len(buckets))
    n_classes = UNKNOWN + 1
    model = Model(slots, np.zeros((len(buckets), n_classes)), np.zeros(n_classes), 1.0, templates, _bigrams(HEADINGS))

    x = np.zeros((len(rows), len(buckets)))
    for i, (text, _) in enumerate(rows):
        grams = text_grams(text)
        slot = model.slot(np.concatenate(grams))
        np.add.at(x[i], slot[slot >= 0], 1 / np.sqrt(max(1, len(grams[0]))))
    y = np.array([label for _, label in rows])
    fitted = np.arange(len(rows)) % 4 != 0

    def objective(flat: np.ndarray) -> tuple[float, np.ndarray]:
        w, b = flat[:-n_classes].reshape(-1, n_classes), flat[-n_classes:]
        p = _softmax(x[fitted] @ w + b)
        n = len(p)
        loss = -np.log(np.maximum(p[np.arange(n), y[fitted]], 1e-12)).mean() + PENALTY / 2 * (w * w).sum()
        p[np.arange(n), y[fitted]] -= 1
        return loss, np.concatenate([(x[fitted].T @ p / n + PENALTY * w).ravel(), p.mean(axis=0)])

    flat = _minimize(objective, np.zeros(model.weights.size + n_classes))
    model.weights, model.bias = flat[:-n_classes].reshape(-1, n_classes), flat[-n_classes:]
    _calibrate(model, x[~fitted], y[~fitted])
    return model


def _calibrate(model: Model, x: np.ndarray, y: np.ndarray) -> None:
    """Temperature and offset of the unknown class with the least loss on held-out rows."""
    raw = x @ model.weights
    best = (np.inf, 1.0, 0.0)
    for scale in np.geomspace(0.5, 4, 13):
        for offset in np.linspace(-3, 3, 13):
            bias = model.bias * scale
            bias[UNKNOWN] += offset
            p = _softmax(scale * raw + bias)
            loss = -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean() if len(y) else 0.0
            best = min(best, (loss, float(scale), float(offset)))
    _, model.scale, offset = best
    model.bias = model.bias * model.scale
    model.bias[UNKNOWN] += offset


def scan_licences(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_paragraphs, n_notices, n_confirmed, families)``; families of the confirmed notices, sorted."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    data = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    source = df.select(F.col(id_col).alias("id"), data.alias("data"))
    names = ["id", "n_paragraphs", "n_notices", "n_confirmed", "families"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [model.scan(text.as_buffer()) for text in batch.column(1)]
            families = [sorted({FAMILIES[f] for f, sure in hits if sure}) for _, hits in found]
            columns = [
                batch.column(0),
                pa.array([n for n, _ in found], pa.int64()),
                pa.array([len(hits) for _, hits in found], pa.int64()),
                pa.array([sum(sure for _, sure in hits) for _, hits in found], pa.int64()),
                pa.array(families, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    id_sql = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(run, f"id {id_sql}, n_paragraphs bigint, n_notices bigint, n_confirmed bigint, families array<string>")
    return out.withColumnRenamed("id", id_col)
