"""Byte-level BPE encoding and decoding with exact merges in linear time.

A merge table is given as ranks (token bytes -> id, ids in merge order).  The
encoder does not replay merges: it lays the longest tokens found by an
Aho-Corasick automaton (over bytes read as Latin-1) from left to right and
backs off to shorter prefixes, or to the token before, wherever two neighbours
could not stand side by side in the result of the merges.  Whether two tokens
may be neighbours depends on the pair alone and is memoised; an end position
that failed once is not tried again, so the work is linear in the text.

Each distinct pre-token is encoded once per Python worker; a batch of texts is
then assembled by index arithmetic over those results.  The tables are emptied
at ``TABLE_ROWS`` segments, which bounds memory.

Edge cases: a null text encodes to no ids; special strings inside texts are
ordinary text; null ids decode to no bytes; an id outside the vocabulary
raises.  Repeated rows are handled one by one, extra columns are kept by
``bpe_decode`` and dropped by ``bpe_encode``.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.common import field_type, query, read, spans, text_chunks, utf8, worker_tables
from casemart.llm.pretokens import Splitter, segments

TABLE_ROWS = 300_000
IDS_AT_ONCE = 1 << 20


def load_ranks(content: bytes) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and its id on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


class MergeTable:
    """Encoder of single pre-tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * self.size
        for token, i in ranks.items():
            self.tokens[i] = token
        #: the two tokens whose merge makes a token (a single byte: itself twice)
        self.halves = [(i, i) for i in range(self.size)]
        #: the longest shorter token that begins a token, or -1
        self.prefix = [-1] * self.size
        self.fits: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in sorted(ranks.items(), key=lambda x: x[1]):
            self.automaton.add_word(token.decode("latin-1"), i)
            if len(token) > 1:
                self.halves[i] = self._last_merge(token, i)
                self.prefix[i] = next((ranks[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in ranks), -1)
        self.automaton.make_automaton()

    def _last_merge(self, token: bytes, own: int) -> tuple[int, int]:
        get = self.ranks.get
        cuts = [(a, b) for k in range(1, len(token))
                if (a := get(token[:k], own)) < own and (b := get(token[k:], own)) < own]
        if len(cuts) == 1:
            return cuts[0]
        parts = [token[k:k + 1] for k in range(len(token))]     # several ways to cut: replay the merges
        while len(parts) > 2:
            rank, k = min((get(parts[k] + parts[k + 1], own), k) for k in range(len(parts) - 1))
            if rank >= own:
                raise ValueError(f"token {own} cannot be made by merges of earlier tokens")
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return get(parts[0]), get(parts[1])

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the merges can leave ``left`` and ``right`` side by side.

        Walks back through the merges that made both, latest first, along the
        border between them: if a pair that faced each other there had a merge
        due before the next step that was taken, the border would be gone.
        """
        known = self.fits.get((left, right))
        if known is not None:
            return known
        a, b, due, ok = left, right, self.size, None
        get, tokens, halves = self.ranks.get, self.tokens, self.halves
        while ok is None:
            if get(tokens[a] + tokens[b], self.size) < due:
                ok = False
            elif a > b and halves[a][1] != a or b > a and halves[b][0] == b and halves[a][1] != a:
                due, a = a, halves[a][1]
            elif halves[b][0] != b:
                due, b = b + 1, halves[b][0]
            elif halves[a][1] != a:
                due, a = a, halves[a][1]
            else:
                ok = True
        if len(self.fits) >= TABLE_ROWS:
            self.fits.clear()
        self.fits[left, right] = ok
        return ok

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        text, known, fits, tokens = piece.decode("latin-1"), self.fits, self.may_follow, self.tokens
        longest = self.automaton.iter_long
        greedy = [i for _, i in longest(text)]
        for pair in zip(greedy, greedy[1:]):
            ok = known.get(pair)
            if not (fits(*pair) if ok is None else ok):
                break
        else:
            return greedy                         # neighbours that all fit are the result of the merges
        prefix, size = self.prefix, len(piece)
        alive = bytearray(b"\x01") * (size + 1)
        out: list[int] = []
        at, token = 0, greedy[0]
        while at < size:
            end = at + len(tokens[token])
            if alive[end] and (not out or fits(out[-1], token)):
                out.append(token)
                at = end
                if at < size:
                    token = next(longest(text, at))[1]
            elif prefix[token] >= 0:
                token = prefix[token]
            else:
                alive[at] = 0
                token = out.pop()                 # its end is dead now, so a shorter one follows
                at -= len(tokens[token])
        return out


class Decoder:
    """Ids to bytes, a batch at a time."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            tokens[i] = token
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(bytes, offsets)`` of the texts that the ids spell."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.length) or not self.length[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        lengths = self.length[ids]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.blob[spans(self.start[ids], lengths)], ends[offsets]


class Encoder:
    """Texts to ids, a batch at a time.

    The ids of a segment stand in ``flat``, ``count`` of them from ``begin`` on;
    ``piece`` has the place of a pre-token's ids there as ``begin << 24 | count``.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.table = MergeTable(ranks)
        self.split = Splitter(pattern).pieces
        self._forget()

    def _forget(self) -> None:
        self.code: dict[str, int] = {}
        self.piece: dict[str, int] = {}
        self.flat, self.begin, self.count = array("i"), array("q"), array("q")

    def _learn(self, key: str) -> int:
        flat, begin = self.flat, len(self.flat)
        for p in self.split(key):
            place = self.piece.get(p)
            if place is None:
                ids = self.table.encode(p.encode())
                if len(ids) < 1 << 24:
                    self.piece[p] = len(flat) << 24 | len(ids)
                flat.extend(ids)
            else:
                at = place >> 24
                flat.extend(flat[at:at + (place & 0xFFFFFF)])
        code = self.code[key] = len(self.begin)
        self.begin.append(begin)
        self.count.append(len(flat) - begin)
        return code

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)``: text i has ids[offsets[i]:offsets[i + 1]]."""
        if len(self.code) > TABLE_ROWS:
            self._forget()
        codes, upto, known = array("q"), [0], self.code
        for text in texts:
            keys = segments(text)
            try:
                codes.extend([known[k] for k in keys])
            except KeyError:
                codes.extend([known[k] if k in known else self._learn(k) for k in keys])
            upto.append(len(codes))
        if not codes:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        c = np.frombuffer(codes, np.int64)
        counts = np.frombuffer(self.count, np.int64)[c]
        ids = np.frombuffer(self.flat, np.int32)[spans(np.frombuffer(self.begin, np.int64)[c], counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])
        return ids, ends[upto]


def _once(kind: type, content: bytes, *more: str) -> Encoder | Decoder:
    """One encoder or decoder per Python worker and vocabulary, kept between tasks."""
    made, key = worker_tables("bpe"), (kind, len(content), zlib.crc32(content), *more)
    if key not in made:
        made[key] = kind(load_ranks(content), *more)
    return made[key]


def _vocabulary(df: DataFrame, path: str):
    """The rank file as a broadcast; its size is that of the vocabulary, not of the data."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def bpe_encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids array<int>)`` of every row's whole text."""
    content = _vocabulary(df, ranks_path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _once(Encoder, content.value, pattern)
        for b in batches:
            texts = utf8(b.column(1))
            for row, end, _, _ in text_chunks(texts):
                ids, offsets = codec.encode(texts.slice(row, end - row).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(row, end - row),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))],
                    names=[id_col, "ids"])

    return (df.select(F.col(id_col), F.col(text_col).alias("text"))
            .mapInArrow(encode, f"`{id_col}` {field_type(df, id_col)}, ids array<int>"))


def bpe_decode(df: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes that each row's ids spell."""
    content = _vocabulary(df, ranks_path)
    at, columns = df.columns.index(ids_col), [*df.columns, out_col]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _once(Decoder, content.value)
        for b in batches:
            ids = b.column(at).fill_null([]) if b.column(at).null_count else b.column(at)
            upto = ids.offsets.to_numpy().astype(np.int64)
            row = 0
            while row < b.num_rows:       # rows of bounded ids at a time; a longer row alone
                end = max(row + 1, int(np.searchsorted(upto, upto[row] + IDS_AT_ONCE, "right")) - 1)
                part = ids.values.slice(upto[row], upto[end] - upto[row]).to_numpy(zero_copy_only=False)
                data, ends = codec.decode(part, upto[row:end + 1] - upto[row])
                out = pa.Array.from_buffers(pa.binary(), end - row, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([*b.slice(row, end - row).columns, out], names=columns)
                row = end

    schema = ", ".join(f"`{c}` {field_type(df, c)}" for c in df.columns)
    return df.mapInArrow(decode, f"{schema}, `{out_col}` binary")


def bpe_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Encode, decode the ids again, and digest both; ``keep`` may name ``ids`` and ``decoded``."""
    coded = bpe_decode(bpe_encode(docs, ranks_path, pattern, id_col, text_col), ranks_path)
    return coded.select(F.col(id_col), F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"), *keep)


@query("op9_bpe_round_trip")
def op9_bpe_round_trip(spark, sf_dir):
    import public_tokenizers as P

    return bpe_digests(read(spark, sf_dir, "documents"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
