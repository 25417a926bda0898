"""Phrase collocations by Rabin-Karp fingerprints of word n-grams (operator 13).

A text's words are laid out with one blank between them; prefix polynomials over
the bytes (``sum c_j B^j`` modulo two primes) give every n-gram's fingerprint
with a subtraction and a shift, whatever its length. Fingerprints are counted in
the task and then by one shuffle, for words, for pairs, and for phrases of three
and four words. A phrase occurs at most as often as any part of it, so n-grams
with a part that is too rare are not shuffled: a bit filter of fixed size holds
the fingerprints that occur often enough (it may let others pass, never the
reverse). A collision of fingerprints can only make a count too large, so no
frequent phrase is lost.

A last pass verifies the counts against the text: every task keeps, for each
frequent fingerprint, the place of an occurrence, compares all others with the
bytes there, and those that differ with each other; text is cut out at these
places alone. The shuffle of that pass sums by text, so counts are exact and
only phrases that may be frequent are materialised. (The places stay in the
task that has the text: sent along with fingerprints they would make the first
shuffles half as large again, and the texts would have to follow.)

Scores are integers: ``floor(2000000 * a / (l + r))`` in decimals of 38 digits.

Defined results: a null or empty text has no words; a null language is ``und``;
documents are counted as rows, so repeated rows and null ids count again; ties
are ordered as ``collocations`` says; an empty table gives an empty result;
other columns are not read. A piece without any separator must fit in a worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialize

MOST_WORDS = 4
LEAST = 30
SLAB_BYTES = 1 << 20
# Entries that a task holds before it hands them on.
TALLY = 1 << 21
TEXTS = 1_000_000
TEXT_BYTES = 64 << 20
VERIFY_TASKS_PER_CORE = 2
FILTER_BITS = 1 << 27

# Two primes below 2^31 and bases below them.
PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
BASES = (1_103_515_245, 1_664_525_017)

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_IS_BREAK = np.zeros(256, dtype=bool)
_IS_BREAK[list(_BREAKS)] = True
_IS_APART = _IS_BREAK.copy()
_IS_APART[[0x20, 0x09]] = True
_BREAK = re.compile(b"[" + re.escape(_BREAKS) + b"]")

_POWERS: dict[tuple[int, int], np.ndarray] = {}


def _powers(n: int, base: int, prime: int) -> np.ndarray:
    """``base ** j`` modulo ``prime`` for j = 0 .. n - 1, by doubling; kept for the next slab."""
    out = _POWERS.get((base, prime), np.ones(1, dtype=np.uint64))
    while len(out) < n:
        step = np.uint64(pow(base, len(out), prime))
        out = np.concatenate([out, out * step % np.uint64(prime)])
    if len(out) <= 4 * SLAB_BYTES:
        _POWERS[base, prime] = out
    return out[:n]


class Words:
    """The words of some texts of one language: their bytes with one blank between, and their pieces."""

    def __init__(self, data: bytes) -> None:
        codes = np.frombuffer(data.translate(_LOWER), dtype=np.uint8)
        inside = ~_IS_APART[codes]
        starts = np.flatnonzero(inside & np.append(True, ~inside[:-1])) if len(codes) else np.empty(0, dtype=np.int64)
        at = np.flatnonzero(inside)
        heads = np.searchsorted(at, starts)
        lengths = np.diff(np.append(heads, len(at)))
        self.n = len(starts)
        self.starts = heads + np.arange(self.n)
        self.ends = self.starts + lengths
        laid = np.full(len(at) + self.n, 0x20, dtype=np.uint8)
        laid[np.arange(len(at)) + np.repeat(np.arange(self.n), lengths)] = codes[at]
        self.codes = laid
        self.piece = np.cumsum(_IS_BREAK[codes])[starts] if self.n else np.empty(0, dtype=np.int64)
        self._prefixes = [self._prefix(base, prime) for base, prime in zip(BASES, PRIMES, strict=True)]

    def _prefix(self, base: int, prime: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Prefix sums at the words' starts and ends, and the shift that makes a start's place not matter."""
        powers = _powers(len(self.codes), base, prime)
        sums = np.cumsum((self.codes.astype(np.uint64) + np.uint64(1)) * powers % np.uint64(prime))
        sums = np.append(np.uint64(0), sums)
        return sums[self.starts], sums[self.ends], _powers(len(self.codes), pow(base, -1, prime), prime)[self.starts]

    def firsts(self, words: int) -> np.ndarray:
        """Words at which an n-gram of so many words begins; none runs over a piece's end."""
        m = max(0, self.n - words + 1)
        return np.flatnonzero(self.piece[:m] == self.piece[words - 1 : words - 1 + m])

    def keys(self, firsts: np.ndarray, words: int) -> np.ndarray:
        """Fingerprints of the n-grams that begin at ``firsts``: 62 bits, and 2 for the number of words."""
        both = []
        for (before, after, shift), prime in zip(self._prefixes, PRIMES, strict=True):
            value = (after[firsts + words - 1] - before[firsts]) % np.uint64(prime)
            both.append(value * shift[firsts] % np.uint64(prime))
        return (both[0] << np.uint64(33)) | (both[1] << np.uint64(2)) | np.uint64(words - 1)

    def text(self, first: int, words: int) -> bytes:
        return self.codes[self.starts[first] : self.ends[first + words - 1]].tobytes()


def _blocks(sizes: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Runs of texts of about ``SLAB_BYTES`` together, and the place of each of their bytes in its text."""
    done = np.cumsum(sizes)
    cuts = np.searchsorted(done, np.arange(SLAB_BYTES, int(done[-1]) + 1 if len(done) else 0, SLAB_BYTES))
    for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)], strict=True):
        if first < last:
            size = sizes[first:last]
            yield slice(first, last), np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)


def _equal(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, other_codes: np.ndarray, others: np.ndarray, other_sizes: np.ndarray) -> np.ndarray:
    """Mask of the texts whose bytes are those of their counterparts."""
    same = sizes == other_sizes
    todo = np.flatnonzero(same & (starts != others) if codes is other_codes else same)
    for block, place in _blocks(sizes[todo]):
        at = todo[block]
        size = sizes[at]
        differ = codes[np.repeat(starts[at], size) + place] != other_codes[np.repeat(others[at], size) + place]
        same[at] = ~np.logical_or.reduceat(differ, np.cumsum(size) - size)
    return same


def _cut_out(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The texts' bytes one after another."""
    out = [codes[np.repeat(starts[block], sizes[block]) + place] for block, place in _blocks(sizes)]
    return np.concatenate(out) if out else codes[:0]


def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    """Words of the rows ``(lang, data)``, texts of a language together, about ``SLAB_BYTES`` at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        order = pc.sort_indices(batch.column(0))
        langs, texts = batch.column(0).take(order), batch.column(1)
        lang, parts, size = None, [], 0
        for here, i in zip(langs.to_pylist(), order.to_pylist(), strict=True):
            data = texts[i].as_py()
            if parts and (here != lang or size + len(data) > SLAB_BYTES):
                yield lang, Words(b"\n".join(parts))
                parts, size = [], 0
            lang = here
            while len(data) > SLAB_BYTES:
                found = _BREAK.search(data, SLAB_BYTES)
                if not found:
                    break
                yield lang, Words(data[: found.start()])
                data = data[found.end() :]
            parts.append(data)
            size += len(data)
        if parts:
            yield lang, Words(b"\n".join(parts))


# A key's two bits in the filter: from the one prime's digits, and from the other's.
_SHIFTS = (0, 33)


def _passing(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    passing = np.ones(len(keys), dtype=bool)
    for shift in _SHIFTS:
        spot = (keys >> np.uint64(shift)) & np.uint64(FILTER_BITS - 1)
        passing &= (bits[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
    return passing


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, dtype=np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


class Tally:
    """Counts of fingerprints by language, bounded by ``TALLY`` entries."""

    def __init__(self) -> None:
        self.parts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.size = 0

    def add(self, lang: str, keys: np.ndarray) -> None:
        keys, counts = np.unique(keys, return_counts=True)
        self.parts.setdefault(lang, []).append((keys, counts))
        self.size += len(keys)
        if self.size > TALLY:
            for name, parts in self.parts.items():
                self.parts[name] = [_summed(*(np.concatenate(c) for c in zip(*parts, strict=True)))]
            self.size = sum(len(k) for parts in self.parts.values() for k, _ in parts)

    def full(self) -> bool:
        return self.size > TALLY // 2

    def flush(self) -> Iterator[pa.RecordBatch]:
        for lang, parts in self.parts.items():
            keys, counts = _summed(*(np.concatenate(c) for c in zip(*parts, strict=True)))
            for i in range(0, len(keys), 1 << 16):
                k, n = keys[i : i + (1 << 16)], counts[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([lang]).take(pa.array(np.zeros(len(k), dtype=np.int32))), pa.array(k.view(np.int64)), pa.array(n)], names=["lang", "key", "n"])
        self.parts, self.size = {}, 0


def _common(texts: DataFrame, orders: tuple[int, ...], bits: np.ndarray | None, least: int, name: str) -> DataFrame:
    """Stored keys of the n-grams of ``orders`` words that occur ``least`` times in a language.

    Only those count whose parts pass ``bits``: words of pairs, pairs of longer
    ones. With the longer ones come the words of frequent pairs: no other word
    is a part of a phrase.
    """
    shared = texts.sparkSession.sparkContext.broadcast(bits)
    part = 1 if orders[0] == 2 else 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, tally = shared.value, Tally()
        for lang, words in _slabs(batches):
            fit = None
            if bits is not None:
                fit = np.zeros(words.n, dtype=bool)
                firsts = words.firsts(part)
                fit[firsts] = _passing(words.keys(firsts, part), bits)
            if part == 2:
                pairs = np.flatnonzero(fit)
                tally.add(lang, words.keys(np.union1d(pairs, pairs + 1), 1))
            for order in orders:
                firsts = words.firsts(order)
                for k in range(order - part + 1 if fit is not None else 0):
                    firsts = firsts[fit[firsts + k]]
                tally.add(lang, words.keys(firsts, order))
            if tally.full():
                yield from tally.flush()
        yield from tally.flush()

    found = texts.mapInArrow(run, "lang string, key bigint, n bigint")
    stored = materialize(found.groupBy("lang", "key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("key"), name)
    shared.destroy()
    return stored


def _filter(keys: DataFrame) -> np.ndarray:
    """Two bits for each key; of fixed size whatever the input."""
    spots = [F.shiftrightunsigned("key", shift).bitwiseAND(F.lit(FILTER_BITS - 1).cast("bigint")) for shift in _SHIFTS]
    words = (
        keys.select(F.explode(F.array(*spots)).alias("spot"))
        .groupBy(F.shiftright("spot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("bits"))
        .toArrow()  # at most FILTER_BITS / 64 rows
    )
    out = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def _merged(keys: np.ndarray, counts: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(keys, counts, sizes, bytes)`` by key: each text once, told apart by its bytes where fingerprints are equal."""
    todo, chosen, sums = np.argsort(keys), [], []
    while len(todo):
        key = keys[todo]
        new = np.append(True, key[1:] != key[:-1])
        first = np.flatnonzero(new)
        lead = todo[first][np.cumsum(new) - 1]
        same = _equal(codes, starts[todo], sizes[todo], codes, starts[lead], sizes[lead])
        chosen.append(todo[first])
        sums.append(np.add.reduceat(np.where(same, counts[todo], 0), first))
        todo = todo[~same]  # other texts with the same fingerprint
    if not chosen:
        return keys, counts, sizes, codes[:0]
    at, sums = np.concatenate(chosen), np.concatenate(sums)
    if len(chosen) > 1:
        order = np.argsort(keys[at])
        at, sums = at[order], sums[order]
    return keys[at], sums, sizes[at], _cut_out(codes, starts[at], sizes[at])


def _not_counted(part: tuple[np.ndarray, ...], table: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Adds the counts of ``part`` to those of ``table``; returns the texts that it does not have."""
    keys, counts, sizes, codes = part
    if not len(keys) or not len(table[0]):
        return part
    starts, at = np.cumsum(sizes) - sizes, np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    hit = np.flatnonzero(table[0][at] == keys)
    found = at[hit]
    same = _equal(codes, starts[hit], sizes[hit], table[3], (np.cumsum(table[2]) - table[2])[found], table[2][found])
    np.add.at(table[1], found[same], counts[hit[same]])
    rest = np.ones(len(keys), dtype=bool)
    rest[hit[same]] = False
    return keys[rest], counts[rest], sizes[rest], _cut_out(codes, starts[rest], sizes[rest])


def _slab_texts(words: Words, order: int, bits: np.ndarray) -> tuple[np.ndarray, ...]:
    """The n-grams that pass ``bits``, as ``_merged`` gives them."""
    firsts = words.firsts(order)
    keys = words.keys(firsts, order)
    passing = _passing(keys, bits)
    firsts = firsts[passing]
    starts = words.starts[firsts]
    return _merged(keys[passing], np.ones(len(firsts), dtype=np.int64), starts, words.ends[firsts + order - 1] - starts, words.codes)


def _verified_slab(words: Words, order: int, bits: np.ndarray) -> Iterator[tuple[bytes, int]]:
    """Texts of the n-grams that pass ``bits`` and how often each occurs, by comparing bytes."""
    _, counts, sizes, codes = _slab_texts(words, order, bits)
    for n, size, end in zip(counts.tolist(), sizes.tolist(), np.cumsum(sizes).tolist(), strict=True):
        yield codes[end - size : end].tobytes(), n


class Texts:
    """How often each text occurs, by language and number of words; of ``TEXTS`` entries and ``TEXT_BYTES`` at most.

    The texts stand one after another in an array: there is no object for each.
    """

    def __init__(self) -> None:
        self.totals: dict[str, int] = {}
        self.parts: dict[tuple[str, int], list[tuple[np.ndarray, ...]]] = {}
        self.size = self.bytes = 0

    def add(self, lang: str, words: Words, bits: np.ndarray) -> None:
        self.totals[lang] = self.totals.get(lang, 0) + words.n
        for order in range(1, MOST_WORDS + 1):
            part, parts = _slab_texts(words, order, bits), self.parts.setdefault((lang, order), [])
            if parts:
                part = _not_counted(part, parts[0])
            parts.append(part)
            self.size += len(part[0])
            self.bytes += len(part[3])

    def _merge(self) -> None:
        for name, parts in self.parts.items():
            if len(parts) > 1:
                keys, counts, sizes, codes = (np.concatenate(c) for c in zip(*parts, strict=True))
                parts[:] = [_merged(keys, counts, np.cumsum(sizes) - sizes, sizes, codes)]
        self.size = sum(len(part[0]) for parts in self.parts.values() for part in parts)
        self.bytes = sum(len(part[3]) for parts in self.parts.values() for part in parts)

    def full(self) -> bool:
        """Whether too many are left when each is there once."""
        if self.size <= TEXTS and self.bytes <= TEXT_BYTES:
            return False
        self._merge()
        return 4 * self.size > 3 * TEXTS or 4 * self.bytes > 3 * TEXT_BYTES

    def flush(self) -> Iterator[pa.RecordBatch]:
        self._merge()
        # No words at all: how many words the language has.
        for lang, n in self.totals.items():
            yield _text_batch(lang, 0, np.zeros(1, dtype=np.int32), np.empty(0, dtype=np.uint8), np.array([n]))
        for (lang, order), [(_, counts, sizes, codes)] in self.parts.items():
            ends = np.cumsum(sizes)
            for i in range(0, len(sizes), 1 << 16):
                j = min(len(sizes), i + (1 << 16))
                data = codes[ends[i] - sizes[i] : ends[j - 1]]
                yield _text_batch(lang, order, sizes[i:j], data, counts[i:j])
        self.totals, self.parts, self.size, self.bytes = {}, {}, 0, 0


def _text_batch(lang: str, order: int, sizes: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    phrases = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(codes)))
    langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(sizes), dtype=np.int32)))
    columns = [langs, phrases, pa.array(np.full(len(sizes), order, dtype=np.int32)), pa.array(counts.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "words", "n"])


def _verified(texts: DataFrame, bits: np.ndarray, least: int) -> tuple[DataFrame, DataFrame]:
    """Stored ``(lang, phrase, words, f)`` of the phrases that occur ``least`` times, and ``(lang, n)``, all words.

    A task hands on a row for each text it has met, so the tasks follow the cores, not the input's splits.
    """
    context = texts.sparkSession.sparkContext
    shared = context.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, found = shared.value, Texts()
        for lang, words in _slabs(batches):
            found.add(lang, words, bits)
            if found.full():
                yield from found.flush()
        yield from found.flush()

    texts = texts.coalesce(VERIFY_TASKS_PER_CORE * context.defaultParallelism)
    found = texts.mapInArrow(run, "lang string, phrase string, words int, n bigint")
    found = found.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f")).where((F.col("f") >= least) | (F.col("words") == 0))
    stored = materialize(found, "phrases")
    shared.destroy()
    sizes = stored.where("words = 0").select("lang", F.col("f").alias("n"))
    return stored.where("words > 0"), sizes


def frequent_phrases(df: DataFrame, least: int = LEAST, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, words, f)`` of the phrases of 2 to 4 words that occur ``least`` times and of their words, and ``(lang, n)``."""
    texts = df.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("data"),
    )
    words = _common(texts, (1,), None, least, "words")
    pairs = _common(texts, (2,), _filter(words), least, "pairs")
    longer = _common(texts, (3, 4), _filter(pairs), least, "longer")
    return _verified(texts, _filter(pairs.unionByName(longer)), least)


def collocations(df: DataFrame, least: int = LEAST, most: int = 2000, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``most`` best phrases of 2 to 4 words of each language.

    ``a`` is how often the phrase occurs, ``l`` and ``r`` its first and second
    part at the cut with the lowest score (of equal ones after the fewest words).
    A phrase inside a longer one that occurs at least four fifths as often is
    left out. Order: score and ``a`` descending, phrase ascending by its bytes.
    """
    phrases, sizes = frequent_phrases(df, least, lang_col, text_col)
    counted = phrases.select("lang", "phrase", "f")
    candidates = phrases.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"))
    cut = candidates.select("*", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cut = cut.select("*", F.expr("substring_index(phrase, ' ', k)").alias("first"), F.expr("substring_index(phrase, ' ', k - words)").alias("rest"))
    cut = cut.join(counted.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cut = cut.join(counted.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr("cast(a as decimal(28, 0)) * 2000000 div (cast(l as decimal(28, 0)) + r)").cast("bigint")
    scored = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    parts = "transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), i -> array_join(slice(split(phrase, ' '), i, m), ' ')))"
    inside = candidates.where("words >= 3").select("lang", F.explode(F.flatten(F.expr(parts))).alias("phrase"), F.col("a").alias("longer"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where("longer is null or 100 * longer < 80 * a")
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
