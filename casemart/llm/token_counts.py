"""Token counts of whole documents without token ids.

Every task keeps a table of distinct pre-tokens with the number of pieces that
the tokenizer makes of them.  A batch's documents become frequencies of
distinct segments; the distinct pre-tokens that the table lacks go to the
tokenizer once, in one call; the frequencies are joined to the piece counts
and summed per document.  No id list of a document is ever built.

The table is kept per task, not shuffled: a pre-token costs a few
microseconds to count, less than moving a (document, pre-token) row, and the
text is read once with no exchange, so a hot source or word cannot skew a
task.  It is emptied at ``TABLE_ROWS`` entries, which bounds memory and only
makes later batches count again.

Edge cases: a null text is empty (0 bytes, 0 tokens).  Added tokens of the
tokenizer file inside a text count as one token each, as is the library's
default.  Repeated rows are counted one by one; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.common import field_type, query, read, utf8
from casemart.llm.pretokens import Splitter, segments

TABLE_ROWS = 600_000


class PieceCounter:
    """Piece counts per distinct pre-token and, summed, per distinct segment."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        if (spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)):
            raise ValueError("a byte-level tokenizer without normalizer, prefix space or stripping added tokens is needed")
        import public_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.split = Splitter(public_tokenizers.PATTERN).pieces
        texts = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, texts))) if texts else None
        self.pieces: dict[str, int] = {}
        self.of_segment: dict[str, int] = {}

    def learn(self, keys: set[str]) -> None:
        """Count the pieces of the segments that the table lacks."""
        new = [k for k in keys if k not in self.of_segment]
        if len(self.pieces) > TABLE_ROWS:
            self.pieces.clear()
        known = self.pieces
        cut = [self.split(k) for k in new]
        lack = [p for p in {p for parts in cut for p in parts} if p not in known]
        known.update(zip(lack, map(len, self.tokenizer.encode_batch_fast(lack, add_special_tokens=False))))
        self.of_segment.update((k, sum([known[p] for p in parts])) for k, parts in zip(new, cut))

    def count(self, texts: list[str]) -> list[int]:
        if len(self.of_segment) > TABLE_ROWS:
            self.of_segment.clear()
        base, freqs = [], []
        for text in texts:
            parts = self.added.split(text) if self.added else [text]
            base.append(len(parts) - 1)
            freq: Counter[str] = Counter()
            for part in parts:
                freq.update(segments(part))
            freqs.append(freq)
        self.learn(set().union(*freqs) if freqs else set())
        of = self.of_segment
        return [b + sum([n * of[s] for s, n in f.items()]) for b, f in zip(base, freqs)]


@lru_cache(maxsize=2)
def _counter(path: str) -> PieceCounter:
    return PieceCounter(path)      # one per Python worker, kept between its tasks


def token_counts(df: DataFrame, tokenizer_path: str, limit: int, id_col: str = "doc_id", text_col: str = "text",
                 rows_at_once: int = 500) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of every row."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer_path)
        for b in batches:
            texts, n = utf8(b.column(2)), []
            for at in range(0, b.num_rows, rows_at_once):
                n += counter.count(texts.slice(at, rows_at_once).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())],
                                             names=[id_col, "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    return (df.select(id_col, F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
            .mapInArrow(count, f"`{id_col}` {field_type(df, id_col)}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))


@query("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    import public_tokenizers

    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 512)
