"""Blocks: documents as arrays of small integers with a word list of their own.

A block is a few MB of text of neighbouring documents. Its words are listed once and
the documents are positions into that list, which compresses to about a third of the
text. What has to meet globally (each distinct word, each window hash) then leaves a
block once, not once for every place where it stands, so a word that stands everywhere
is one entry for each block; and what comes back is a few bits or ids for each entry.

The blocks are written once to the shared folder, bucketed by block, so that answers
join them without another shuffle of the texts.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir

#: Code points of text that fill a block.
BLOCK_CHARS = 8_000_000
SCHEMA = "block long, n_docs long, n_tokens long, n_words long, ids binary, sizes binary, codes binary, words binary"
#: A null id is held as this number and given back as null.
NO_ID = np.iinfo(np.int64).min


def pack(values: np.ndarray) -> bytes:
    """Integers as bytes: the planes of low to high bytes, compressed where that pays."""
    a = np.ascontiguousarray(values)
    raw = a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes()
    if len(raw) < 128:
        return b"\0" + raw
    return b"\1" + zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(data: bytes, dtype: type) -> np.ndarray:
    raw = data[1:] if data[:1] == b"\0" else zstandard.ZstdDecompressor().decompress(data[1:])
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).reshape(-1).view(dtype)


def pack_words(words: list[bytes]) -> bytes:
    sizes = pack(np.fromiter(map(len, words), np.uint32, len(words)))
    return len(sizes).to_bytes(4, "little") + sizes + zstandard.ZstdCompressor(level=3).compress(b"".join(words))


def unpack_words(data: bytes) -> list[bytes]:
    n = int.from_bytes(data[:4], "little")
    ends = np.cumsum(unpack(data[4 : 4 + n], np.uint32).astype(np.int64)).tolist()
    text = zstandard.ZstdDecompressor().decompress(data[4 + n :])
    return [text[a:b] for a, b in zip([0, *ends], ends)]


class Block:
    """A block's row, unpacked: ids and sizes by document, codes of all documents in a row."""

    def __init__(self, row: dict) -> None:
        self.block = row["block"]
        self.ids = unpack(row["ids"], np.int64)
        self.sizes = unpack(row["sizes"], np.int64)
        self.codes = unpack(row["codes"], np.uint32).astype(np.int64)
        self.words = unpack_words(row["words"])
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))


def _pack_documents(split: Callable[[str], list], block_chars: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        seq, chars = 0, 0
        ids: list[int] = []
        codes: list[np.ndarray] = []
        index: defaultdict = defaultdict(count().__next__)

        def row() -> pa.RecordBatch:
            words = [w if isinstance(w, bytes) else w.encode() for w in index]
            each = np.fromiter(map(len, codes), np.int64, len(codes))
            flat = np.concatenate(codes) if codes else np.empty(0, np.uint32)
            values = [number + seq, len(ids), len(flat), len(words), pack(np.array(ids, np.int64)), pack(each), pack(flat), pack_words(words)]
            return pa.RecordBatch.from_arrays([pa.array([v], type=pa.int64() if i < 4 else pa.binary()) for i, v in enumerate(values)], names=[c.split()[0] for c in SCHEMA.split(", ")])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                if chars and chars + len(text) > block_chars:
                    yield row()
                    seq, chars, ids, codes, index = seq + 1, 0, [], [], defaultdict(count().__next__)
                tokens = split(text)
                codes.append(np.fromiter(map(index.__getitem__, tokens), np.uint32, len(tokens)))
                ids.append(NO_ID if doc_id is None else doc_id)
                chars += len(text)
        if ids:
            yield row()

    return run


def make_blocks(docs: DataFrame, split: Callable[[str], list], name: str, *, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """docs as blocks, written to the shared folder and bucketed by block.

    split gives the words of a text (str or bytes). Ids are taken as long.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_pack_documents(split, block_chars), SCHEMA)
    table = f"{name}_{uuid.uuid4().hex}"
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows.write.bucketBy(buckets, "block").option("path", f"{shared_dir(spark)}/{table}").option("compression", "none").format("parquet").saveAsTable(table)
    return spark.table(table)


def parts_for(entries: int, each: int) -> int:
    """Over how many parts to deal out so many entries, so that a part fits in memory."""
    return max(16, -(-entries // each))


def salts_for(blocks: int, each: int) -> int:
    """Over how many tasks to spread a part's blocks, so that a word which stands in all of them
    is not more than so many entries of one task."""
    return max(1, -(-blocks // each))


def ask(entries: DataFrame, answer: Callable[[list[dict]], list[bytes]], *, salts: int = 1) -> DataFrame:
    """Deals entries (part, block, data) out by part; answer gets a part's rows in the
    order of block and gives an answer for each. The result is (block, part, data).

    With salts a part's blocks are spread over so many tasks: for answers that do not depend on
    a part's other blocks.
    """

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["block"])
        return pa.table({"block": pa.array([r["block"] for r in rows], pa.int64()), "part": pa.array([r["part"] for r in rows], pa.int32()), "data": pa.array(answer(rows), pa.binary())})

    return entries.groupBy("part", F.pmod(F.xxhash64("block"), F.lit(salts)).alias("salt")).applyInArrow(run, "block long, part int, data binary")


def tell(blocks: DataFrame, answers: DataFrame, use: Callable[[Block, list[dict]], Iterator[dict]], schema: str, batch: Callable[[list], pa.Table]) -> DataFrame:
    """Joins the answers (rows with block) to their blocks. use gets a block and its answers."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = right.to_pylist()
        return batch([out for row in left.to_pylist() for out in use(Block(row), found)])

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)
