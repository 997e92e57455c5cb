"""Conversations as training text with a loss mask, assembled column-wise.

A turn becomes ``<s>role\\n`` + text + ``</s>\\n``.  Wherever a role or text
holds one of the template's control strings (or an escaped one), a backslash
goes in after its first character, so the control strings of the output are
exactly the turn borders and the original text can be read back.

Rows are dealt by ranges of (conversation, turn) and sorted inside each task.
A batch of turns is assembled at once: header, content and footer lengths give
cumulative offsets; scatter indices place every header, content byte, escape
and footer in one preallocated buffer, which becomes the Arrow string column.
A conversation comes out as one or more pieces, cut between turns where a task
or a batch ends; so neither a long conversation nor a key with a third of all
rows has to fit in one task.  ``piece`` orders the pieces of a conversation.

The loss mask is the byte ranges of the texts of ``loss_roles``.

Edge cases: null role or text are empty; a null conversation id is a
conversation of its own; null turns come first; rows with equal turns are
ordered by role, then text, and repeated rows all stay.  A newline or
backslash in a role is written ``\\n`` or ``\\\\``.  Extra columns are ignored,
an empty table gives no pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.common import ORACLE, field_type, query, read, spans, text_chunks, utf8


@dataclass(frozen=True)
class ChatTemplate:
    open: str = "<s>"
    close: str = "</s>"
    control: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")
    loss_roles: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        if not {self.open, self.close} <= set(self.control) or any(
                len(c) < 2 or "\\" in c or c[0] in c[1:] or ord(c[0]) > 127 for c in self.control):
            raise ValueError("control strings hold the turn marks, two characters or more, no backslash, their first only once")

    @cached_property
    def risky(self) -> re.Pattern[bytes]:
        """A control string, or one that was escaped before."""
        return re.compile(b"|".join(re.escape(c[0].encode()) + rb"\\*" + re.escape(c[1:].encode()) for c in self.control))

    @cached_property
    def escaped(self) -> re.Pattern[bytes]:
        return re.compile(b"|".join(b"(?<=" + re.escape(c[0].encode()) + rb")\\(?=\\*" + re.escape(c[1:].encode()) + b")"
                                    for c in self.control))

    def header(self, role: str) -> bytes:
        safe = role.replace("\\", "\\\\").replace("\n", "\\n").encode()
        return self.open.encode() + self.risky.sub(lambda m: m[0][:1] + b"\\" + m[0][1:], safe) + b"\n"

    @property
    def footer(self) -> bytes:
        return self.close.encode() + b"\n"

    def unescape(self, text: bytes) -> bytes:
        return self.escaped.sub(b"", text) if b"\\" in text else text

    def role(self, header: bytes) -> str:
        safe = self.unescape(header).decode()
        return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], safe) if "\\" in safe else safe

    def parse(self, formatted: bytes) -> list[tuple[str, bytes]]:
        """``(role, text)`` of every turn of a formatted piece."""
        out = []
        for turn in formatted.split(self.footer)[:-1]:
            head, _, text = turn[len(self.open):].partition(b"\n")
            out.append((self.role(head), self.unescape(text)))
        return out


def assemble(template: ChatTemplate, roles: list[str], data: np.ndarray, offsets: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, turn offsets, content starts, content ends)`` of formatted turns.

    ``data`` and ``offsets`` hold the contents as one buffer.
    """
    names = {r: i for i, r in enumerate(dict.fromkeys(roles))}
    heads = [template.header(r) for r in names]
    which = np.array([names[r] for r in roles], np.int64)
    head_len = np.array([len(h) for h in heads], np.int64)
    head_at = np.cumsum(head_len) - head_len
    blob = np.frombuffer(b"".join(heads) + template.footer, np.uint8)
    foot = len(template.footer)

    lengths = np.diff(offsets)
    found = [(m.start(), m.end()) for m in template.risky.finditer(data.tobytes())]
    at = np.array([s for s, _ in found], np.int64)
    row = np.searchsorted(offsets, at, "right") - 1
    inside = np.array([e for _, e in found], np.int64) <= offsets[row + 1]    # not across two contents
    at, row = at[inside], row[inside]
    added = np.bincount(row, minlength=len(lengths)).astype(np.int64)

    total = head_len[which] + lengths + added + foot
    ends = np.concatenate([[0], np.cumsum(total)])
    content = ends[:-1] + head_len[which]
    out = np.empty(int(ends[-1]), np.uint8)
    out[spans(ends[:-1], head_len[which])] = blob[spans(head_at[which], head_len[which])]
    before = np.zeros(len(data) + 1, np.int64)            # escapes that stand before a byte
    np.add.at(before, at + 1, 1)
    before = np.cumsum(before)
    put = np.arange(len(data)) + before[:-1] + np.repeat(content - offsets[:-1] - before[offsets[:-1]], lengths)
    out[put] = data
    out[put[at] + 1] = ord("\\")
    out[spans(ends[1:] - foot, np.full(len(lengths), foot))] = np.tile(blob[len(blob) - foot:], len(lengths))
    return out, ends, content, ends[1:] - foot


def format_chat(df: DataFrame, template: ChatTemplate = ChatTemplate(), conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text", piece_bytes: int = 4 << 20) -> DataFrame:
    """``(conv, piece, n_turns, formatted, loss_start, loss_end)``; loss ranges in bytes of ``formatted``."""
    names = [conv_col, "piece", "n_turns", "formatted", "loss_start", "loss_end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        piece = TaskContext.get().partitionId() << 32
        for b in batches:
            texts = utf8(b.column(2))
            for row, end, data, offsets in text_chunks(texts, piece_bytes):
                conv = b.column(0).slice(row, end - row)
                roles = utf8(b.column(1).slice(row, end - row)).to_pylist()
                out, ends, start, stop = assemble(template, roles, data, offsets)
                key = conv.dictionary_encode(null_encoding="encode").indices.to_numpy()
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                last = np.concatenate([first[1:], [len(key)]])
                cut = ends[np.concatenate([first, [len(key)]])]
                scored = np.flatnonzero(np.isin(roles, template.loss_roles))
                of = np.searchsorted(first, scored, "right") - 1          # the piece of a scored turn
                lists = np.searchsorted(of, np.arange(len(first) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    conv.take(pa.array(first)), pa.array(piece + np.arange(len(first)), pa.int64()),
                    pa.array(last - first, pa.int64()),
                    pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(cut.astype(np.int32)), pa.py_buffer(out)]),
                    pa.ListArray.from_arrays(lists, pa.array(start[scored] - cut[of], pa.int64())),
                    pa.ListArray.from_arrays(lists, pa.array(stop[scored] - cut[of], pa.int64()))], names=names)
                piece += len(first)

    rows = df.select(F.col(conv_col).alias("c"), F.col(role_col).cast("string").alias("r"), F.col(text_col).alias("x"),
                     F.col(turn_col).alias("n"))
    return (rows.repartitionByRange("c", "n").sortWithinPartitions("c", "n", "r", "x").select("c", "r", "x")
            .mapInArrow(run, f"`{conv_col}` {field_type(df, conv_col)}, piece long, n_turns long, formatted string, "
                             "loss_start array<long>, loss_end array<long>"))


def read_back(pieces: DataFrame, template: ChatTemplate = ChatTemplate(), conv_col: str = "conv_id") -> DataFrame:
    """Digests of each conversation, read from its formatted pieces in order.

    The pieces of a conversation stream through one task (a digest is
    sequential by nature); only one batch of pieces is in memory at a time.
    """
    names = [conv_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    class Digest:
        def __init__(self):
            self.turns, self.loss, self.n, self.loss_chars, self.chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

        def add(self, formatted: str, starts, stops) -> None:
            raw = formatted.encode()
            for role, text in template.parse(raw):
                self.turns.update(b"%b\n%b\n" % (role.encode(), text))
                self.n += 1
            for a, z in zip(starts, stops):
                text = template.unescape(raw[a:z])
                self.loss.update(text)
                self.loss_chars += len(text.decode())
            self.chars += len(formatted)

        def row(self, conv) -> tuple:
            return conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, schema = None, None, None
        for b in batches:
            schema = b.schema.field(0).type
            done = []
            for conv, *piece in zip(*(c.to_pylist() for c in b.columns)):
                if digest is None or conv != now:
                    if digest is not None:
                        done.append(digest.row(now))
                    now, digest = conv, Digest()
                digest.add(*piece)
            if done:
                yield pack(done, schema)
        if digest is not None:
            yield pack([digest.row(now)], schema)

    def pack(rows: list[tuple], conv_type) -> pa.RecordBatch:
        kinds = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return (pieces.repartition(F.col(conv_col)).sortWithinPartitions(conv_col, "piece")
            .select(conv_col, "formatted", "loss_start", "loss_end")
            .mapInArrow(run, f"`{conv_col}` {field_type(pieces, conv_col)}, n_turns long, turns_sha256 string, "
                             "loss_chars long, loss_sha256 string, formatted_chars long"))


@query("op1_chat_formatting")
def op1_chat_formatting(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], rows.schema)
    return read_back(format_chat(rows.unionByName(more)))


ORACLE["op1_chat_formatting"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
safe AS (
  SELECT *, regexp_replace(regexp_replace(text, '<(\\*/?s>)', '<\\\1', 'g'), '\[(\\*/?INST\])', '[\\\1', 'g') AS written FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<s>') + length(role) + 1 + length(written) + length('</s>') + 1)::BIGINT AS formatted_chars
FROM safe GROUP BY conv_id
"""
