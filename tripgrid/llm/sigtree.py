"""Signature trees over token bitmaps (numpy; one tree holds one bounded unit of documents).

A document of n tokens has a bitmap of W bits, W a power of two of at least
2n, in which a token sets bit ``hash mod W``. A node holds the OR of its
documents' bitmaps, their least and greatest sizes and the greatest excess
(tokens beyond one per bit). Two documents under two nodes share at most
``popcount(bits1 & bits2) + min(excess1, excess2)`` tokens; a node pair is
pruned if this, or the sizes, rule out the similarity that is asked for.
Documents whose widths differ by one step are compared at the smaller width
(the wider bitmap is folded); greater differences in size cannot link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LEAF = 8
FANOUT = 8
MIN_BITS, MAX_BITS = 256, 1 << 20
PAIR_CHUNK = 1 << 15


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """Words (uint64) of the bitmap of a token set."""
    width = min(MAX_BITS, max(MIN_BITS, 1 << int(2 * len(tokens) - 1).bit_length()))
    bits = np.zeros(width, dtype=np.uint8)
    bits[(tokens & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _popcount(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words).sum(axis=1, dtype=np.int64)


class Signatures:
    """Bitmaps of some documents, by width, with all pair bounds in one place."""

    def __init__(self, sizes: np.ndarray, bitmaps: list[np.ndarray], percent: int) -> None:
        self.sizes, self.percent = sizes, percent
        self.widths = np.array([len(b) for b in bitmaps], dtype=np.int64)
        self.views: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        matrices = {}
        for w in np.unique(self.widths).tolist():
            rows = np.flatnonzero(self.widths == w)
            matrices[w] = rows, np.stack([bitmaps[r] for r in rows.tolist()])
        for w, (rows, matrix) in matrices.items():
            if 2 * w in matrices:
                wide_rows, wide = matrices[2 * w]
                rows = np.concatenate([rows, wide_rows])
                matrix = np.concatenate([matrix, wide[:, :w] | wide[:, w:]])
            at = np.full(len(sizes), -1, dtype=np.int64)
            at[rows] = np.arange(len(rows))
            self.views[w] = rows, matrix, sizes[rows] - _popcount(matrix), at

    def _needed(self, total: np.ndarray) -> np.ndarray:
        """Least overlap of two sets whose sizes add up to ``total``."""
        return -(-self.percent * total // (100 + self.percent))

    def _sizes_fit(self, low1, high1, low2, high2) -> np.ndarray:
        return (100 * high1 >= self.percent * low2) & (100 * high2 >= self.percent * low1)

    def possible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Mask of the document pairs that may be similar enough."""
        out = np.zeros(len(a), dtype=bool)
        sa, sb = self.sizes[a], self.sizes[b]
        fit = self._sizes_fit(sa, sa, sb, sb)
        width = np.minimum(self.widths[a], self.widths[b])
        for w, (_, matrix, excess, at) in self.views.items():
            for start in range(0, len(a), PAIR_CHUNK):
                own = start + np.flatnonzero((fit & (width == w))[start : start + PAIR_CHUNK])
                if len(own):
                    i, j = at[a[own]], at[b[own]]
                    shared = _popcount(matrix[i] & matrix[j]) + np.minimum(excess[i], excess[j])
                    out[own] = shared >= self._needed(sa[own] + sb[own])
        return out

    def small_pairs(self, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Possible pairs inside groups (equal neighbours in ``groups``) of at most LEAF documents."""
        starts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1])) if len(groups) else np.empty(0, dtype=np.int64)
        lengths = np.diff(np.append(starts, len(groups)))
        found = [(np.empty(0, dtype=np.int64),) * 2]
        for n in range(2, LEAF + 1):
            i, j = np.triu_indices(n, 1)
            base = starts[lengths == n][:, None]
            a, b = (base + i).ravel(), (base + j).ravel()
            mask = self.possible(a, b)
            found.append((a[mask], b[mask]))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def tree_pairs(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Possible pairs among ``rows``, by dual traversal of one tree per width."""
        for w, (_, matrix, excess, at) in self.views.items():
            own = rows[at[rows] >= 0]
            if not (self.widths[own] == w).any() or len(own) < 2:
                continue
            yield from self._dual(own, w, matrix[at[own]], excess[at[own]])

    def _dual(self, own: np.ndarray, w: int, matrix: np.ndarray, excess: np.ndarray):
        # Neighbours in this order are alike: first by size, then by some of their bits.
        band = (np.log(np.maximum(self.sizes[own], 1)) / np.log(100 / self.percent)).astype(np.int64)
        order = np.lexsort((matrix[:, 0], band))
        own, matrix, excess = own[order], matrix[order], excess[order]
        sizes = self.sizes[own]
        levels = [(matrix, sizes, sizes, excess)]  # from documents up to the root
        fan = LEAF
        while len(levels[-1][0]) > 1:
            bits, low, high, most = levels[-1]
            cut = np.arange(0, len(bits), fan)
            levels.append(
                (
                    np.bitwise_or.reduceat(bits, cut),
                    np.minimum.reduceat(low, cut),
                    np.maximum.reduceat(high, cut),
                    np.maximum.reduceat(most, cut),
                )
            )
            fan = FANOUT
        stack = [(len(levels) - 1, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
        while stack:
            level, a, b = stack.pop()
            if level == 0:
                # pairs of two wider documents belong to the next width's tree
                mask = (a < b) & ((self.widths[own[a]] == w) | (self.widths[own[b]] == w))
                a, b = a[mask], b[mask]
                if len(a):
                    yield own[a], own[b]
                continue
            below = level - 1
            fan = LEAF if below == 0 else FANOUT
            n = len(levels[below][0])
            step = np.arange(fan)
            i = np.repeat(a[:, None] * fan + step, fan, axis=1).ravel()
            j = np.tile(b[:, None] * fan + step, (1, fan)).ravel()
            keep = (i < n) & (j < n) & (i <= j)
            i, j = i[keep], j[keep]
            bits, low, high, most = levels[below]
            # both children hold sizes that fit each other, or no pair below them can link
            low1 = np.maximum(low[i], -(-self.percent * low[j] // 100))
            low2 = np.maximum(low[j], -(-self.percent * low[i] // 100))
            fit = np.flatnonzero(self._sizes_fit(low[i], high[i], low[j], high[j]))
            for start in range(0, len(fit), PAIR_CHUNK):
                f = fit[start : start + PAIR_CHUNK]
                shared = _popcount(bits[i[f]] & bits[j[f]]) + np.minimum(most[i[f]], most[j[f]])
                f = f[shared >= self._needed(low1[f] + low2[f])]
                if len(f):
                    stack.append((below, i[f], j[f]))


class Forest:
    """Union-find with labels as an array: members of a component share a label."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.label[a] != self.label[b]

    def join(self, a: int, b: int) -> bool:
        x, y = self.label[a], self.label[b]
        if x == y:
            return False
        self.label[self.label == max(x, y)] = min(x, y)
        return True
