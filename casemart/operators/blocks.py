"""Long keys that can be near each other, found inside one task.

``near_keys`` compares a group of longer keys ``x`` with a group of keys ``y``
by the rule of ``casemart.operators.match``: of any ``K // 2 + 1`` disjoint
blocks of ``x``, ``K`` edits leave one with one edit or none.  The pieces of the
windows of ``y`` are an index of bounded size; the pieces of the blocks of ``x``
are looked up in it.  What is found is then followed from block to block: the
blocks as a ring hold ``K`` edits at most, so from one of them on every run of
``l`` blocks holds ``l * K / blocks`` at most (else the runs that hold more
would fill the ring).  The edits of a block are at least its distance to the
nearest text in the places of ``y`` that it can move to.  No pair within ``K``
edits is lost: hashes and codes that fall together only add pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np

INDEX_PIECES = 1 << 24      # pieces of y that are indexed at once
SLICE = 1 << 20             # look-ups that are followed at once
CHECK = 1 << 21             # characters of y that blocks are compared with at once
PAIRS = 1 << 24             # pairs of keys that a batch of x can come to
BATCH = 1 << 18             # characters of a batch of x

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def max_edits(length: int, floor: float) -> int:
    """Largest distance that still reaches ``floor`` for ``max(len) = length``."""
    return int(math.floor((1.0 - floor) * length + 1e-9))


def _codes(texts: list[str], pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes 1 to 255 of all characters with ``pad`` zeros around each text, and where texts start, and their lengths."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = pad + np.cumsum(lengths + pad) - (lengths + pad)
    flat = np.zeros(pad + int((lengths + pad).sum()), np.uint8)
    flat[np.arange(len(points)) + np.repeat(pad * np.arange(1, len(texts) + 1), lengths)] = points % 255 + 1
    return flat, starts, lengths


def _hash(chars: list[np.ndarray], tag: int) -> np.ndarray:
    """32 bits for each text whose characters are given place by place."""
    h = np.full(chars[0].shape, (tag + 1) * 0x2545F4914F6CDD1D & (1 << 64) - 1, np.uint64)
    for c in chars:
        h *= _STEP
        h += c
    h ^= h >> np.uint64(29)
    h *= _MIX
    return (h >> np.uint64(32)).astype(np.uint32)


def _tags(b: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """``(tag, character left out)`` of the pieces of a block and of a window that are
    equal where a character was replaced, inserted (``b``) or lost (``b + 1``)."""
    replaced = [(p, p) for p in range(b)]
    return (replaced + [(b, b - 1)] + [(b + 1, p) for p in range(b - 1)],
            replaced + [(b, p) for p in range(1, b - 1)] + [(b + 1, b - 1)])


class _Windows:
    """The pieces of all windows of the keys ``ys``, sorted by their hashes."""

    def __init__(self, ys: list[str], b: int, pad: int):
        self.flat, self.starts, self.lengths = _codes(ys, pad)
        # one character past the end, so that a block that lost a character meets a window there too
        many = np.maximum(0, self.lengths - (b - 2))
        first = np.cumsum(many) - many
        at = np.arange(int(many.sum())) + np.repeat(self.starts - first, many)
        row = np.repeat(np.arange(len(ys), dtype=np.int32), many)
        chars = [self.flat[at + q].astype(np.uint64) for q in range(b)]
        self.whole = _hash(chars, b + 2)
        self.row, self.place = row, (at - self.starts[row]).astype(np.int32)
        tags = _tags(b)[1]
        packed = np.empty(len(tags) * len(at), np.uint64)
        for i, (tag, p) in enumerate(tags):
            part = packed[i * len(at):(i + 1) * len(at)]
            part[:] = _hash(chars[:p] + chars[p + 1:], tag)
            part <<= np.uint64(32)
            part += np.arange(len(at), dtype=np.uint64)
        # how often texts of b - 1 characters occur, by hash: only the choice of blocks depends on it
        self.often = np.bincount(_hash(chars[:-1], 0) >> np.uint32(12), minlength=1 << 20).astype(np.int32)
        del chars
        packed.sort()
        self.window = packed.astype(np.uint32)      # the low half
        packed >>= np.uint64(32)
        self.piece = packed.astype(np.uint32)
        del packed
        # the first piece of each bucket of leading bits
        self.bits = max(1, min(24, len(self.piece).bit_length()))
        self.bucket = np.zeros((1 << self.bits) + 1, np.int32)
        for a in range(0, len(self.piece), SLICE):
            bucket = self.piece[a:a + SLICE] >> np.uint32(32 - self.bits)
            many = np.bincount(bucket - bucket[0])
            self.bucket[int(bucket[0]) + 1:int(bucket[0]) + 1 + len(many)] += many.astype(np.int32)
        np.cumsum(self.bucket, out=self.bucket)

    def find(self, pieces: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(number of the piece, window)`` for all windows that hold a piece, in bounded slices."""
        order = np.argsort(pieces)
        pieces = pieces[order]
        bucket = pieces >> np.uint32(32 - self.bits)
        low, high = self.bucket[bucket], self.bucket[bucket + np.uint32(1)]
        some = np.flatnonzero(high > low)
        order, pieces, low, many = order[some], pieces[some], low[some], (high - low)[some].astype(np.int64)
        ends = np.cumsum(many)
        i = 0
        while i < len(ends):
            done = ends[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(ends, done + SLICE, "right")))
            for a in range(0, int(ends[j - 1] - done), SLICE):      # a single piece can be in very many windows
                n = np.arange(a, min(a + SLICE, int(ends[j - 1] - done)))
                of = np.repeat(np.arange(i, j), many[i:j]) if j > i + 1 else np.full(len(n), i)
                slot = n + (low[i:j] - (ends[i:j] - many[i:j] - done))[of - i]
                hit = np.flatnonzero(self.piece[slot] == pieces[of])
                yield order[of[hit]], self.window[slot[hit]]
            i = j


def _rarest(x: np.ndarray, b: int, need: int, often: np.ndarray) -> np.ndarray:
    """Places of the ``need`` blocks of each key of ``x`` (a row of codes a key), of
    the cut whose pieces are rarest in ``often``, in order."""
    places = x.shape[1] - b + 2
    n = often[_hash([x[:, q:q + places].astype(np.uint64) for q in range(b - 1)], 0) >> np.uint32(12)].astype(np.int64)
    cost = n[:, :-1] + n[:, 1:]
    best = at = None
    for o in range(min(x.shape[1] - need * b, b - 1) + 1):
        cut = cost[:, o::b]
        pick = np.argpartition(cut, need - 1, axis=1)[:, :need] if need < cut.shape[1] else np.broadcast_to(np.arange(need), (len(x), need))
        total = np.take_along_axis(cut, pick, 1).sum(1)
        here = o + b * np.sort(pick, axis=1)
        if best is None:
            best, at = total, here
        else:
            less = total < best
            best, at = np.where(less, total, best), np.where(less[:, None], here, at)
    return at


def _least_edits(pattern: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Distance of each pattern (a column) to the nearest part of its text: one bit a character of the pattern."""
    m = len(pattern)
    word = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if m <= 8 * t().itemsize)
    one, last = word(1), word(m - 1)
    plus, minus = np.full(text.shape[1], ~word(0)), np.zeros(text.shape[1], word)
    score = np.full(text.shape[1], m, np.uint8)
    best = score.copy()
    for c in text:
        same = np.zeros(text.shape[1], word)
        for p in range(m):
            same |= (c == pattern[p]).astype(word) << word(p)
        down = same | minus
        same |= ((same & plus) + plus) ^ plus
        up, less = minus | ~(same | plus), plus & same
        score += ((up >> last) & one).astype(np.uint8)
        score -= ((less >> last) & one).astype(np.uint8)
        up, less = up << one, less << one
        plus, minus = less | ~(down | up), up & down
        np.minimum(best, score, out=best)
    return best


def _follow(w: _Windows, blocks: np.ndarray, at: np.ndarray, lx: int, k: int, x: np.ndarray, i: np.ndarray, y: np.ndarray,
            edits: np.ndarray) -> np.ndarray:
    """Which pairs (a block ``i`` of ``x`` met ``y`` with so many edits) can hold ``k`` edits, seen from that block on."""
    need, size = blocks.shape[1], min(blocks.shape[2], 64)
    width = size + k
    texts = np.ndarray(len(w.flat) - width + 1, f"V{width}", w.flat, strides=(1,))      # a view of the text from every place
    kept = np.arange(len(x))
    for run in range(2, need + 1):
        left = []
        for a in range(0, len(kept), max(1, CHECK // width)):
            part = kept[a:a + max(1, CHECK // width)]
            j = (i[part] + (run - 1)) % need
            from_ = w.starts[y[part]] + at[x[part], j] - (k + lx - w.lengths[y[part]]) // 2
            text = np.ascontiguousarray(texts[from_].view(np.uint8).reshape(-1, width).T)
            edits[part] += _least_edits(np.ascontiguousarray(blocks[x[part], j, :size].T), text)
            left.append(part[edits[part] <= run * k // need])
        kept = np.concatenate(left) if left else kept
    return kept


def near_keys(xs: list[str], ys: list[str], floor: float, b: int, equal: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in ``xs`` and ``ys``, each pair once, of keys that can reach the floor,
    where the key of ``x`` is longer (``equal``: or as long) and holds its blocks of ``b`` characters."""
    if not xs or not ys:
        return
    xflat, xstarts, xlengths = _codes(xs, 0)
    pad = max(b, max_edits(int(xlengths.max()), floor)) + 1
    ends, most = np.cumsum(np.fromiter(map(len, ys), np.int64, len(ys))), max(1, INDEX_PIECES // (2 * b - 1))
    cuts = np.searchsorted(ends, np.arange(most, ends[-1] + 1, most))
    x_tags = _tags(b)[0]
    for first, after in zip([0, *cuts], [*cuts, len(ys)], strict=True):
        if after <= first:
            continue
        w = _Windows(ys[first:after], b, pad)
        for lx in np.unique(xlengths):
            k = max_edits(int(lx), floor)
            need = k // 2 + 1
            if not ((w.lengths <= lx - (not equal)) & (w.lengths >= lx - k)).any():
                continue
            rows = np.flatnonzero(xlengths == lx)
            batch = max(1, min(BATCH // int(lx), PAIRS // (after - first)))
            for a in range(0, len(rows), batch):
                mine = rows[a:a + batch]
                x = xflat[xstarts[mine][:, None] + np.arange(lx)]
                at = _rarest(x, b, need, w.often)
                blocks = x[np.arange(len(x))[:, None, None], at[:, :, None] + np.arange(b)]
                chars = [blocks[:, :, q].astype(np.uint64).ravel() for q in range(b)]
                whole = _hash(chars, b + 2)
                seen, found = np.zeros(len(x) * len(w.starts), bool), []
                for n, window in w.find(np.concatenate([_hash(chars[:p] + chars[p + 1:], tag) for tag, p in x_tags])):
                    n %= len(whole)                 # the block
                    y, move = w.row[window], w.place[window] - at.ravel()[n]
                    delta = w.lengths[y] - lx
                    fits = np.flatnonzero((delta <= (0 if equal else -1)) & (delta >= -k) & (2 * move >= delta - k) & (2 * move <= delta + k)
                                          & ~seen[n // need * len(w.starts) + y])
                    n, y, window = n[fits], y[fits], window[fits]
                    # a block that meets a key in several windows or pieces is followed once, from its fewest edits
                    met = np.sort((n * len(w.starts) + y) * 2 + (w.whole[window] != whole[n]))
                    met = met[np.concatenate([[True], met[1:] >> 1 != met[:-1] >> 1])[:len(met)]]
                    n, y = np.divmod(met >> 1, len(w.starts))
                    xn, i = n // need, n % need
                    kept = _follow(w, blocks, at, int(lx), k, xn, i, y, (met & 1).astype(np.uint8))
                    pairs = np.unique(xn[kept] * len(w.starts) + y[kept])
                    seen[pairs] = True
                    found.append(pairs)
                if found:
                    pairs = np.concatenate(found)
                    yield mine[pairs // len(w.starts)], first + pairs % len(w.starts)
        w = None                # before the next index is built
