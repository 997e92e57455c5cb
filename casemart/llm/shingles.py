"""Word-shingle sets of a batch of texts, as 64-bit hashes.

Words are runs of anything but ASCII white space, A-Z lower-cased.  A text with
fewer words than a shingle is one shingle (its whole word sequence); a text
without words has the empty set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from casemart.llm.common import lower_ascii, mix, span_hashes, text_chunks, words

_STEP = np.uint64(0x9FB21C651E98DF25)


def _sequence_hash(h: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` word hashes from each position on."""
    out = np.full(len(at), width, np.uint64)
    for k in range(width):
        out = mix(out * _STEP + h[at + k])
    return out


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """``(first row, sets)`` per chunk of a text column; a set is sorted and distinct."""
    for row, end, data, offsets in text_chunks(column):
        data = lower_ascii(data)
        starts, ends, rows = words(data, offsets)
        h = span_hashes(data, starts, ends)
        first = np.searchsorted(rows, np.arange(end - row + 1))
        count = np.diff(first)
        at = np.arange(max(0, len(h) - width + 1))
        at = at[rows[at] == rows[at + width - 1]]
        full = _sequence_hash(h, at, width)
        upto = np.concatenate([[0], np.cumsum(np.maximum(0, count - width + 1))])
        sets = [full[a:b] for a, b in zip(upto, upto[1:])]
        for i in np.flatnonzero((count > 0) & (count < width)):
            sets[i] = _sequence_hash(h, first[i:i + 1], int(count[i]))
        for i, s in enumerate(sets):
            if len(s) > 1:
                s = np.sort(s)
                sets[i] = s[np.concatenate([[True], s[1:] != s[:-1]])]
        yield row, sets
