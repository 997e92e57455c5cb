"""Helpers shared by the operators: registration, key filters and Arrow text batches.

Texts reach Python as Arrow batches (``mapInArrow``).  ``text_chunks`` cuts a
batch into row ranges of bounded bytes, so the numpy temporaries of an
operator stay small however long the batch is; a single text larger than the
bound is a chunk of its own (texts are always whole).
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        REGISTRY[name] = run
        return run
    return deco


_kept: dict[str, dict] = {}


def worker_tables(owner: str) -> dict:
    """What this Python worker keeps between tasks of one operator.

    Spark reuses its workers, so the tables of an operator would stay beside
    those of the next one; a task of another owner drops them and gives their
    memory back to the system.
    """
    if owner not in _kept:
        if _kept:
            _kept.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
            if trim:
                trim(0)
        _kept[owner] = {}
    return _kept[owner]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id hashes as '')."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def field_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def utf8(column: pa.Array) -> pa.Array:
    """A string or binary column as UTF-8 strings; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).fill_null("")


def text_chunks(column: pa.Array, max_bytes: int = 4 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` pieces of a text column.

    ``bytes`` is a uint8 view of the rows' UTF-8, ``offsets`` (rows + 1) point
    into it from 0.  Nulls are empty texts.
    """
    a = utf8(column)
    off = np.frombuffer(a.buffers()[1], np.int64, len(a) + 1 + a.offset)[a.offset:]
    data = a.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(a):
        end = int(np.searchsorted(off, off[row] + max_bytes, "right")) - 1
        end = min(max(end, row + 1), len(a))
        yield row, end, data[off[row]:off[end]], off[row:end + 1] - off[row]
        row = end


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated index ranges ``starts[i] .. starts[i] + lengths[i]``."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    step = np.repeat(starts - (ends - lengths), lengths)
    return step + np.arange(total)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, every other byte as it is."""
    return _LOWER[data]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX
    h ^= h >> np.uint64(29)
    h = h * _MUL
    h ^= h >> np.uint64(32)
    return h


def add_blocks(blocks: DataFrame, tasks: int, parts: int, leaf: type, mean: bool = False, fan_in: int = 32) -> list:
    """``(part, n, value)`` rows, in order: the sums over all tasks of the
    ``blocks`` (part long, n long, value binary) that each task emits, one a
    part; with ``mean`` the means weighted by ``n``.

    ``value`` holds an array of ``leaf`` numbers, the result doubles.  Tasks are
    added in a tree, ``fan_in`` of them at a time, so the last step and every
    other task read a bounded number of arrays, whatever the number of tasks.
    """
    def adder(numbers: type):
        def add(batches):
            have: dict[tuple[int, int], list] = {}
            for b in batches:
                for group, part, n, value in zip(*(c.to_pylist() for c in b.columns)):
                    x = have.setdefault((group, part), [0, 0])
                    x[0], x[1] = x[0] + n, x[1] + np.frombuffer(value, numbers).astype(float) * (n if mean else 1)
            if have:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g for g, _ in have]), pa.array([p for _, p in have]), pa.array([n for n, _ in have.values()]),
                     pa.array([(v / n if mean else v).tobytes() for n, v in have.values()])], names=["group", "part", "n", "value"])
        return add

    kind = "group long, part long, n long, value binary"
    columns = ["group", "part", "n", "value"]
    groups = max(1, -(-tasks // fan_in))
    rows, numbers = blocks.withColumn("group", F.spark_partition_id().cast("long") % groups), leaf
    while groups > 1:
        rows = rows.select(*columns).repartition(4 * groups, "group", "part").mapInArrow(adder(numbers), kind)
        groups, numbers = -(-groups // fan_in), np.float64
        rows = rows.withColumn("group", F.col("group") % groups)
    rows = rows.select(*columns).repartition(parts, "part").mapInArrow(adder(numbers), kind)
    return rows.select("part", "n", "value").orderBy("part").collect()          # parts rows


def words(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, row)`` of every word of a chunk: a run of bytes that are not
    ``blank`` (the default: ``[^\\x20\\x09-\\x0D]+``).

    A word never crosses a row border.
    """
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = np.empty(n + 1, bool)
    np.logical_not(blank[data], out=solid[:n])
    solid[n] = False
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:]
    first[n] = False
    starts = np.flatnonzero(first)
    last = np.zeros(n + 1, bool)
    last[1:] = solid[:-1] & (~solid[1:] | edge[1:])
    ends = np.flatnonzero(last)
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, computed eight bytes at a time.

    Equal spans hash equally wherever they stand; the length enters the hash.
    """
    n = len(starts)
    h = (ends - starts).astype(np.uint64) * _MUL
    if not n:
        return h
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    view = np.lib.stride_tricks.as_strided(padded[:1].view(np.uint8), (len(data) + 1, 8), (1, 1))
    left = ends - starts
    at = starts
    live = None
    while True:
        block = np.ascontiguousarray(view[at]).view(np.uint64).ravel()
        keep = np.minimum(left, 8)
        block &= _MASK[keep]
        if live is None:
            h = mix(h ^ block)
        else:
            h[live] = mix(h[live] ^ block)
        more = np.flatnonzero(left > 8)
        if not len(more):
            return h
        live = more if live is None else live[more]
        at = at[more] + 8
        left = left[more] - 8


_MASK = np.array([(1 << (8 * i)) - 1 if i < 8 else (1 << 64) - 1 for i in range(9)], np.uint64)
