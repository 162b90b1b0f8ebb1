"""Sets of word shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tripweave.llm import bytescan as bs

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_STEP = bs.U64(0xD6E8FEB86659FD93)


class Words:
    """Hashes of the words of texts, A-Z taken as a-z if ``lower``. They do not depend on the block a word was found in."""

    def __init__(self, lower: bool = True) -> None:
        self._rolling = bs.Rolling(7, bs.BLOCK)
        self._lower = lower

    def _hashes(self, data: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of each word; ``opens`` are places where a text begins."""
        if len(data) > len(self._rolling.up) - 1:
            self._rolling = bs.Rolling(7, len(data))
        space = _SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[opens] = True
        edge[[0, -1]] = True
        blank = np.concatenate([[True], space, [True]])
        start = np.flatnonzero(~space & (blank[:-2] | edge[:-1]))
        end = np.flatnonzero(~space & (blank[2:] | edge[1:])) + 1
        prefix = self._rolling.prefix(_LOWER[data] if self._lower else data)
        return start, bs.mix(self._rolling.spans(prefix, start, end))

    def of(self, raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Blocks of rows [i, j): the row and the hash of each word, in order.

        A long text is hashed in parts that end at white space.
        """
        for i, j in bs.blocks(at):
            a, b = int(at[i]), int(at[j])
            if j - i > 1 or b - a <= bs.BLOCK:
                start, words = self._hashes(raw[a:b], at[i:j] - a)
                yield i, j, np.searchsorted(at[i + 1 : j + 1] - a, start, "right") + i, words
                continue
            parts, here = [], a
            while here < b:
                end = min(b, here + bs.BLOCK)
                while end < b:
                    found = np.flatnonzero(_SPACE[raw[end : min(b, end + bs.BLOCK)]])
                    end = end + int(found[0]) + 1 if len(found) else min(b, end + bs.BLOCK)
                    if len(found):
                        break
                parts.append(self._hashes(raw[here:end], np.zeros(1, np.int64))[1])
                here = end
            words = np.concatenate(parts)
            yield i, j, np.full(len(words), i), words


def shingle_sets(rows: np.ndarray, words: np.ndarray, i: int, j: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row in [i, j): row and hash, ordered by both.

    A row of fewer than n words has one shingle of all its words.
    """
    out_row, out = [], []
    h = words[: max(0, len(words) - n + 1)].copy()
    for k in range(1, n):
        h = bs.mix(h * _STEP + words[k : k + len(h)])
    same = rows[: len(h)] == rows[n - 1 :][: len(h)]
    out_row.append(rows[: len(h)][same])
    out.append(h[same])
    count = np.bincount(rows - i, minlength=j - i)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        first = (np.cumsum(count) - count)[short]
        h = words[first].copy()
        for k in range(1, n - 1):
            more = count[short] > k
            h[more] = bs.mix(h[more] * _STEP + words[first[more] + k])
        out_row.append(short + i)
        out.append(h)
    row, h = np.concatenate(out_row), np.concatenate(out)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[fresh], h[fresh]
