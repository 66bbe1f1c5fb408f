"""Token ids as word-aligned Simple-8b blocks.

A 64-bit word holds a 4-bit selector and as many of the next ids as fit at one width; the selector says
how many and how wide. A value beyond 60 bits takes an escape word that points into the block's list
of exceptions, so that every word stands for itself and all words of a block decode at once. A block
(little endian) holds whole documents:

    magic 8 bytes; documents, ids, words, exceptions, marks: 5 x uint64
    doc_ids int64 x documents; null flags uint8 x documents, padded to 8
    ends uint64 x documents: ids of the block up to and with each document
    marks uint64 x marks: ids before every MARK-th word, to start decoding there
    words uint64 x words; exceptions uint64 x exceptions

Blocks stand in a Parquet file as rows (part, block, n_docs, n_ids, payload), in ascending doc_id order
over (part, block): Spark's writer commits them, and a lost task is simply written again.

Scale: documents are put in order by range partitioning on doc_id and, for repeated ids, a hash of the
text, so equal ids of a third of all rows are still divided. Each task encodes and packs its sorted
range in one pass with one open block. Where a document starts among all ids follows from sums per
block and two-level running sums; texts are shuffled once and ids never.

Edge cases: a null text counts as empty, its document holds the end id alone; a null doc_id comes
first; repeated rows follow each other; an empty table gives an empty file; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import token_counts
from terrace.llm.common import running_offsets, shared_folder, whole_text

MAGIC = b"SIMPLE8B"
#: Fixed values: (ids per word, bits per id) by selector; 0 is the escape and 1 a run of zeros.
SELECTORS = ((1, 60), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 0
#: Ids after which a block is closed, and words between marks.
BLOCK_IDS, MARK = 65_536, 256
END_ID = 2
BLOCKS = "part int, block int, n_docs int, n_ids long, payload binary"


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, exceptions and the number of ids before each word, for unsigned 64-bit ids."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    big = ids >= np.uint64(1 << 60)
    exceptions = ids[big]
    value = ids.copy()
    value[big] = np.arange(len(exceptions), dtype=np.uint64)
    need = np.zeros(n + 120, dtype=np.uint8)
    small = np.frexp((value & np.uint64((1 << 53) - 1)).astype(np.float64))[1]
    need[:n] = np.where(value >= np.uint64(1 << 53), 60, small)
    need[:n][big] = 61  # shares a word with nothing
    # largest[k]: most bits of any id among the 2^k from here on
    largest = [need]
    while 2 ** len(largest) <= 120:
        last, half = largest[-1], 2 ** (len(largest) - 1)
        largest.append(np.maximum(last, np.concatenate([last[half:], np.zeros(half, dtype=np.uint8)])))
    choice = np.full(n, ESCAPE, dtype=np.uint8)
    for selector in range(len(SELECTORS) - 1, ESCAPE, -1):
        count, bits = SELECTORS[selector]
        level = largest[count.bit_length() - 1]
        over = count - 2 ** (count.bit_length() - 1)
        fits = np.maximum(level[:n], level[over : over + n]) <= bits
        choice[fits] = selector
    steps = np.array([c for c, _ in SELECTORS])[choice].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += steps[at]
    before = np.array(starts, dtype=np.int64)
    chosen = choice[before] if n else choice
    words = chosen.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([value, np.zeros(120, dtype=np.uint64)])
    for selector, (count, bits) in enumerate(SELECTORS):
        rows = np.flatnonzero(chosen == selector)
        for k in range(count if bits else 0):
            words[rows] |= padded[before[rows] + k] << np.uint64(bits * k)
    return words, exceptions, before


def unpack(words: np.ndarray, exceptions: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` ids of the words, all words of a selector at once."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array([c for c, _ in SELECTORS])[chosen]
    before = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), dtype=np.uint64)
    for selector, (count, bits) in enumerate(SELECTORS):
        rows = np.flatnonzero(chosen == selector)
        if not len(rows) or not bits:
            continue
        mask = np.uint64((1 << bits) - 1)
        for k in range(count):
            got = (words[rows] >> np.uint64(bits * k)) & mask
            out[before[rows] + k] = exceptions[got.astype(np.int64)] if selector == ESCAPE else got
    return out[:n]


def write_block(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """A block of whole documents."""
    ends = np.cumsum([len(x) for x in ids], dtype=np.int64)
    words, exceptions, before = pack(np.concatenate(ids) if ids else np.array([], dtype=np.uint64))
    marks = before[::MARK]
    flags = bytes(x is None for x in doc_ids)
    parts = [
        MAGIC,
        struct.pack("<5Q", len(doc_ids), int(ends[-1]) if len(ends) else 0, len(words), len(exceptions), len(marks)),
        np.array([x or 0 for x in doc_ids], dtype="<i8").tobytes(),
        flags + bytes(-len(flags) % 8),
        ends.astype("<u8").tobytes(),
        marks.astype("<u8").tobytes(),
        words.astype("<u8").tobytes(),
        exceptions.astype("<u8").tobytes(),
    ]
    return b"".join(parts)


def read_block(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, the end of each document's ids, and all ids of a block."""
    if data[:8] != MAGIC:
        raise ValueError("not a block of this format")
    n_docs, n_ids, n_words, n_exceptions, n_marks = struct.unpack("<5Q", data[8:48])
    at = 48

    def numbers(n: int, kind: str) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, dtype=kind, count=n, offset=at)
        at += out.nbytes
        return out

    doc_ids = numbers(n_docs, "<i8").tolist()
    flags = numbers(n_docs + -n_docs % 8, "u1")[:n_docs].astype(bool)
    ends = numbers(n_docs, "<u8").astype(np.int64)
    numbers(n_marks, "<u8")
    words, exceptions = numbers(n_words, "<u8"), numbers(n_exceptions, "<u8")
    return [None if null else x for x, null in zip(doc_ids, flags, strict=True)], ends, unpack(words, exceptions, n_ids)


def write(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every document, append ``end_id`` and write the blocks in ascending doc_id order."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, encoder = TaskContext.get().partitionId(), token_counts.words(tokenizer)
        end = np.array([end_id], dtype="<u4").tobytes()
        names: list[int | None] = []
        held: list[np.ndarray] = []
        n = block = 0

        def closed() -> pd.DataFrame:
            return pd.DataFrame({"part": [part], "block": [block], "n_docs": [len(names)], "n_ids": [n], "payload": [write_block(names, held)]})

        for frame in frames:
            for name, data in zip(frame["doc_id"], encoder.ids(frame["text"].tolist()), strict=True):
                ids = np.frombuffer(data + end, dtype="<u4")
                names.append(None if pd.isna(name) else int(name))
                held.append(ids)
                n += len(ids)
                if n >= BLOCK_IDS:
                    yield closed()
                    names, held, n, block = [], [], 0, block + 1
        if names:
            yield closed()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # a doc_id goes through pandas as text, which keeps nulls and large numbers whole
    ordered.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(run, BLOCKS).write.parquet(path)


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """The documents of a written file: (part, block, doc_id, at: ids of the block before it, n_tokens,
    ids_crc32), and with ``with_ids`` its ids."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, block, data in zip(frame["part"], frame["block"], frame["payload"], strict=True):
                names, ends, ids = read_block(bytes(data))
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                flat = ids.astype("<u4")
                each = [flat[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                out = {"part": part, "block": block, "doc_id": pd.array(names, dtype="Int64"), "at": starts, "n_tokens": ends - starts, "ids_crc32": [zlib.crc32(x.tobytes()) for x in each]}
                if with_ids:
                    out["ids"] = [x.astype(np.int64).tolist() for x in each]
                yield pd.DataFrame(out)

    schema = "part int, block int, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return spark.read.schema(BLOCKS).parquet(path).select("part", "block", "payload").mapInPandas(run, schema)


def starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, block, start): the ids of all blocks before each."""
    sizes = spark.read.schema(BLOCKS).parquet(path).select("part", "block", "n_ids", F.expr("shiftleft(bigint(part), 32) + block").alias("cell"))
    return running_offsets(sizes, [], "cell", "n_ids", "start").select("part", "block", "start")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the documents to a file in the shared folder and read them back: doc_id, start, n_tokens,
    ids_crc32."""
    spark = docs.sparkSession
    path = shared_folder(spark, "simple8b")
    write(docs, tokenizer, path, end_id)
    first = starts(spark, path).withColumnsRenamed({"part": "p", "block": "b"})
    found = read(spark, path)
    return found.join(first, (F.col("part") == F.col("p")) & (F.col("block") == F.col("b"))).select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
