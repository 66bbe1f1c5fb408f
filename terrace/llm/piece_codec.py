"""SentencePiece encoding with source offsets, and decoding.

The text is normalised here the way the model's compiled character map says: at each place the longest
prefix found in the map's trie is replaced, a character outside the map stays, and every normalised
byte keeps the source byte it came from. The library's pieces tile the normalised text, so the ends of
the pieces project to source bytes through that record, and each piece gets the span of the original
UTF-8 bytes it stands for. The ids are the library's own, and the tiling is verified for each text.

Every text is encoded whole. Rows are independent, so nothing is shuffled. Texts are taken in batches
of at most BATCH_CHARS characters (or one text), which bounds the memory beside the longest text.

Edge cases: a null text counts as empty and has no ids; repeated rows are encoded each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import batches, whole_text

BATCH_CHARS = 500_000
SPACE = "▁"  # what a space is written as in pieces


def wire_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else 4 if kind == 5 else 8
        yield key >> 3, data[at : at + size]
        at += size


class CharacterMap:
    """A compiled character map: a double-array trie over UTF-8 bytes whose values point at
    replacements that end with a zero byte."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], dtype="<u4").tolist()
        self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest prefix of ``data[at:]`` in the map, and its replacement."""
        if not self.units:
            return None
        step = lambda unit: (unit >> 10) << ((unit & 512) >> 6)
        node, best = step(self.units[0]), None
        for k in range(at, len(data)):
            node ^= data[k]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[k]:
                break
            node ^= step(unit)
            if unit >> 8 & 1:
                best = k + 1 - at, self.units[node] & 0x7FFFFFFF
        return best and (best[0], self.texts[best[1] : self.texts.index(b"\0", best[1])])


class Normalizer:
    """Normalisation with the source byte of every normalised byte."""

    def __init__(self, spec: bytes) -> None:
        f = dict(wire_fields(spec))
        self.map = CharacterMap(bytes(f.get(2, b"")))
        self.prefix, self.trim, self.escape = bool(f.get(3, 1)), bool(f.get(4, 1)), bool(f.get(5, 1))

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each the source byte where what it came from begins, with the
        length of the source as the last entry."""
        data = text.encode()
        out, source = self._mapped(data) if self.map.units else (data, np.arange(len(data)))
        end = len(data)
        if self.trim:
            out, source, end = self._trimmed(out, source, end)
        blank = (SPACE if self.escape else " ").encode()
        chars = np.frombuffer(out, dtype=np.uint8)
        if self.escape:
            source = np.repeat(source, np.where(chars == 32, len(blank), 1))
            out = out.replace(b" ", blank)
        if self.prefix and out:
            out, source = blank + out, np.concatenate([np.full(len(blank), source[0]), source])
        return out, np.append(source, end)

    def _mapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        parts, at, source = [], 0, []
        while at < len(data):
            hit = self.map.longest(data, at)
            first = data[at]
            taken, new = hit or (1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4, None)
            new = data[at : at + taken] if new is None else new
            source += range(at, at + taken) if hit is None else [at] * len(new)
            parts.append(new)
            at += taken
        return b"".join(parts), np.array(source, dtype=np.int64)

    @staticmethod
    def _trimmed(out: bytes, source: np.ndarray, end: int) -> tuple[bytes, np.ndarray, int]:
        """Without spaces at either end, and with one space for several."""
        keep = np.ones(len(out), dtype=bool)
        for m in re.finditer(rb" +", out):
            whole = m.start() == 0 or m.end() == len(out)
            keep[m.start() if whole else m.start() + 1 : m.end()] = False
            if m.end() == len(out):
                end = int(source[m.start()])
        return bytes(np.frombuffer(out, dtype=np.uint8)[keep]), source[keep], end


class Codec:
    """The library's processor of one model, with the byte lengths of its pieces."""

    def __init__(self, model: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        data = open(model, "rb").read()
        self.normalizer = Normalizer(next((v for k, v in wire_fields(data) if k == 3), b""))
        pieces = [dict(wire_fields(v)) for k, v in wire_fields(data) if k == 1]
        kinds = np.array([p.get(3, 1) for p in pieces])
        self.unknown = kinds == 2
        self.lengths = np.where(kinds == 6, 1, np.array([len(p[1]) for p in pieces]))  # kind 6: one byte

    def spans(self, text: str, ids: list[int]) -> np.ndarray | None:
        """Source byte ends of the pieces: piece k spans from the end before it (0 at first) to its
        own. None where the pieces don't tile the normalised text, as with unknown characters."""
        normal, source = self.normalizer(text)
        at = np.asarray(ids, dtype=np.int64)
        ends = np.cumsum(self.lengths[at])
        if self.unknown[at].any() or (ends[-1] if len(ends) else 0) != len(normal):
            return None
        return source[ends]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1) if ids else []


@lru_cache(maxsize=2)
def codec(model: str) -> Codec:
    return Codec(model)


ENCODED = "n_tokens long, ids_sha256 string, decoded_sha256 string, n_aligned long, span_ends_crc32 long"


def encode_documents(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256, n_aligned (pieces with a source
    span), span_ends_crc32 (of the spans' ends as little-endian 64-bit numbers); with ``keep_ids`` also
    ids and span_ends."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        it = codec(model)
        for frame in frames:
            texts = frame["text"].tolist()
            for a, b in batches(texts, BATCH_CHARS):
                ids = it.encode(texts[a:b])
                back = it.decode(ids)
                ends = [it.spans(t, x) for t, x in zip(texts[a:b], ids, strict=True)]
                out = {
                    "doc_id": frame["doc_id"].iloc[a:b],
                    "n_tokens": [len(x) for x in ids],
                    "ids_sha256": [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in ids],
                    "decoded_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in back],
                    "n_aligned": [0 if e is None else len(e) for e in ends],
                    "span_ends_crc32": [zlib.crc32(b"" if e is None else e.astype("<i8").tobytes()) for e in ends],
                }
                if keep_ids:
                    out |= {"ids": [np.array(x, dtype=np.int32) for x in ids], "span_ends": ends}
                yield pd.DataFrame(out)

    # a doc_id goes through pandas as text, which keeps nulls and large numbers whole
    rows = docs.select(F.col(doc_id).cast("long").cast("string").alias("doc_id"), whole_text(text).alias("text"))
    schema = f"doc_id string, {ENCODED}" + (", ids array<int>, span_ends array<long>" if keep_ids else "")
    return rows.mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def decode_ids(rows: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the text of an array of ids (null: null)."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def text(batch: pd.Series) -> pd.Series:
        known = [i for i, x in enumerate(batch) if x is not None]
        back = codec(model).decode([[int(y) for y in batch.iloc[i]] for i in known])
        return pd.Series(dict(zip(known, back, strict=True)), index=range(len(batch)), dtype=object)

    return rows.withColumn(out, text(F.col(ids)))
