"""Byte-level BPE: every distinct word is encoded once, wherever it stands.

Texts are split into pre-tokens and packed into blocks (see blocks). Each block sends
its word list, dealt out by word, so that equal words meet; they are encoded once (words of more than
PART_WORDS blocks once for so many blocks) and the ids go back to the blocks, where each
document is put together by position. Decoding looks each id up in the table of token
bytes, whose size is the vocabulary's, on each executor: a broadcast join by position in an
array, which moves no token.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B

#: Entries of word lists in one part.
PART_WORDS = 150_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and number. The file lies on the driver."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the adjacent pair of lowest rank merges first, the leftmost on a tie."""
    if word in ranks:
        return [ranks[word]]
    parts = [word[i : i + 1] for i in range(len(word))]
    if len(parts) > 64:
        return _merge_long(parts, ranks)
    none = len(ranks) + 1_000_000_000
    scores = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
    while scores:
        best = min(scores)
        if best == none:
            break
        i = scores.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del scores[i]
        if i < len(scores):
            scores[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            scores[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _merge_long(parts: list[bytes], ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap over linked pieces, in n log n for words without end."""
    import heapq

    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    piece: list[bytes | None] = list(parts)
    heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, both = heapq.heappop(heap)
        j = after[i]
        if piece[i] is None or j >= n or piece[i] + piece[j] != both:
            continue
        piece[i], piece[j], after[i] = both, None, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(both + piece[after[i]])) is not None:
                heapq.heappush(heap, (r, i, both + piece[after[i]]))
        if (h := before[i]) >= 0 and (r := ranks.get(piece[h] + both)) is not None:
            heapq.heappush(heap, (r, h, piece[h] + both))
    return [ranks[p] for p in piece if p is not None]


def by_part(words: list[bytes], parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of words by part, and the part of each in that order."""
    part = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % parts
    order = np.argsort(part, kind="stable")
    return order, part[order]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, id_col: str = "doc_id", text_col: str = "text", block_chars: int = B.BLOCK_CHARS) -> DataFrame:
    """One row (id, ids array<int>) for each row of docs: the token ids of its whole text.

    pattern splits a text into the pre-tokens within which merges happen. A null or empty text
    has no ids (an empty array), a null id stays null, an empty table gives none; repeated
    rows are encoded as often as they stand, and the order of rows decides nothing. Other
    columns play no part, whatever their names; where id_col itself is called ids, the tokens
    are in token_ids. A text is a row of a block, so that it may have 2 GB at most.
    """
    spark = docs.sparkSession

    def split(text: str) -> list[str]:
        import regex

        return regex.findall(pattern, text)

    table = B.make_blocks(docs, split, "bpe", id_col=id_col, text_col=text_col, block_chars=block_chars)
    total, blocks = table.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.count("*")).first()
    salts = B.salts_for(blocks, PART_WORDS)
    parts = B.parts_for(total, PART_WORDS * salts)
    vocabulary = spark.sparkContext.broadcast(ranks)  # its size is the tokenizer's, whatever the corpus

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = B.unpack_words(row["words"])
                order, part = by_part(words, parts)
                cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1)) if len(part) else []
                out = [(int(part[a]), B.pack_words([words[k] for k in order[a:b].tolist()])) for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.int32()), pa.array([row["block"]] * len(out), pa.int64()), pa.array([d for _, d in out], pa.binary())], names=["part", "block", "data"])

    def answer(rows: list[dict]) -> list[bytes]:
        table, known, out = vocabulary.value, {}, []
        for row in rows:
            ids, sizes = [], []
            for w in B.unpack_words(row["data"]):
                if (got := known.get(w)) is None:
                    known[w] = got = merge(w, table)
                ids += got
                sizes.append(len(got))
            packed = B.pack(np.array(sizes, np.uint32))
            out.append(len(packed).to_bytes(4, "little") + packed + B.pack(np.array(ids, np.uint32)))
        return out

    def use(block: B.Block, answers: list[dict]) -> Iterator[tuple]:
        order, part = by_part(block.words, parts)
        sizes, flat = np.zeros(len(order), np.int64), []
        for row in sorted(answers, key=lambda r: r["part"]):
            n = int.from_bytes(row["data"][:4], "little")
            a, b = np.searchsorted(part, [row["part"], row["part"] + 1])
            sizes[a:b] = B.unpack(row["data"][4 : 4 + n], np.uint32)
            flat.append(B.unpack(row["data"][4 + n :], np.uint32))
        ids = np.concatenate(flat).astype(np.int32) if flat else np.empty(0, np.int32)
        first = np.empty(len(order), np.int64)  # where a word's ids stand
        first[order] = np.cumsum(sizes) - sizes
        each = np.empty(len(order), np.int64)
        each[order] = sizes
        n = each[block.codes]
        ends = np.cumsum(n)
        tokens = ids[np.repeat(first[block.codes] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate(([0], ends))[block.starts]
        yield block.ids, bounds, tokens

    def batch(found: list[tuple]) -> pa.Table:
        ids = np.concatenate([i for i, _, _ in found]) if found else np.empty(0, np.int64)
        lists = [pa.ListArray.from_arrays(pa.array(b, pa.int32()), pa.array(t, pa.int32())) for _, b, t in found]
        return pa.table({"id": pa.array(ids, mask=ids == B.NO_ID), "ids": pa.chunked_array(lists, pa.list_(pa.int32()))})

    entries = table.select("block", "words").mapInArrow(send, "part int, block long, data binary")
    out = B.tell(table, B.ask(entries, answer, salts=salts), use, "id long, ids array<int>", batch)
    return out.select(F.col("id").alias(id_col), F.col("ids").alias("token_ids" if id_col.lower() == "ids" else "ids"))


def decode(tokens: DataFrame, ranks: dict[bytes, int], *, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """tokens with out_col: the bytes that the ids of ids_col stand for (null where they are null,
    empty where they are empty). A column that is called out_col already is replaced; an
    empty table gives an empty one.

    An id outside the vocabulary stops the query.
    """
    spark = tokens.sparkSession
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, i in ranks.items():
        table[i] = token
    shared = spark.sparkContext.broadcast(table)

    @F.pandas_udf("binary")
    def joined(ids):  # noqa: ANN001, ANN202
        look = shared.value.__getitem__
        return ids.map(lambda a: None if a is None else b"".join(map(look, a.tolist())))

    return tokens.withColumn(out_col, joined(F.col(ids_col)))
