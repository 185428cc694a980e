"""Packing by power-of-two decomposition.

A document's token ids are cut into full sequences of ``context`` ids and, for
the rest, into the powers of two of its binary form, longest first. Each piece
is a sequence of its own: sequences of one length form a bucket from which a
batch can be drawn, none crosses a document and none needs padding.

Nothing is shuffled: a piece depends on its document alone.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import rows_of, texts

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
END = 0


def binary_lengths(n: int, context: int) -> list[int]:
    """Full contexts, then the powers of two of the rest, longest first."""
    full, rest = divmod(n, context)
    return [context] * full + [1 << b for b in range(context.bit_length() - 1, -1, -1) if rest >> b & 1]


class Encoder:
    """Ids of the JSON vocabulary without added special tokens.

    The rank file holds the same vocabulary for a faster library. Texts with
    the string of a special token, and runs of white space that this library
    refuses, are encoded by the JSON file itself.
    """

    def __init__(self, vocabulary: bytes, ranks: bytes):
        import tiktoken

        self.vocabulary, self.full = vocabulary, None
        self.special = [t["content"] for t in json.loads(vocabulary)["added_tokens"]]
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def by_file(self, text: str) -> bytes:
        if self.full is None:
            from tokenizers import Tokenizer

            self.full = Tokenizer.from_buffer(self.vocabulary)
        return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.by_file(text)
        try:
            return np.array(self.plain.encode_ordinary(text), "<u4").tobytes()
        except (RuntimeError, ValueError):
            return self.by_file(text)


def pack(
    docs: DataFrame, context: int = 1024, vocabulary: str = VOCABULARY, ranks: str = RANKS, with_ids: bool = True
) -> DataFrame:
    """One row per piece of every document.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and,
    if ``with_ids``, ``ids``. A document is its ids and one id 0 at the end, so
    a null or empty text is one piece of length 1. Repeated rows and null ids
    are packed like any other row; other columns are ignored; an empty table
    gives an empty result.
    """
    if context < 1 or context & (context - 1):
        raise ValueError("context must be a power of two")
    # Two vocabulary files of a few MB at most, so that executors need no local copy.
    files = docs.sparkSession.sparkContext.broadcast([open(p, "rb").read() for p in (vocabulary, ranks)])
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids array<int>" * with_ids

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(*files.value)
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                rows, starts, lengths, sums, totals, ids = [], [], [], [], [], []
                for row, (text,) in enumerate(rows_of([part.select(["text"])])):
                    data = encode(text) + END.to_bytes(4, "little")
                    at, total = 0, len(data) // 4
                    for length in binary_lengths(total, context):
                        own = data[4 * at : 4 * (at + length)]
                        rows.append(row)
                        starts.append(at)
                        lengths.append(length)
                        sums.append(zlib.crc32(own))
                        totals.append(total)
                        if with_ids:
                            ids.append(np.frombuffer(own, "<i4"))
                        at += length
                columns = [part.column("doc_id").take(pa.array(rows, "int64")), *(pa.array(x, "int64") for x in (starts, lengths, sums, totals))]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)

    return (
        texts(docs, "doc_id")
        .mapInArrow(pieces, schema)
        .withColumn("sequence_id", F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("long"))
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Sequences in one folder per length, from which equal lengths are read as a batch."""
    pieces.withColumn("bucket", F.col("length")).write.partitionBy("bucket").parquet(path)
