"""Token counts of whole texts; huge documents are encoded in overlapping chunks and spliced.

A document longer than CHUNK characters is cut into chunks that overlap. Neighbours are encoded with
offsets and spliced at a white space inside the overlap where both agree: neither has a token across
it, and the words next to it carry the same ids at the same offsets. White space is a proven boundary
for this kind of tokenizer: it is dropped, no token and no special string spans it, and normalisation
composes nothing across it. If an overlap holds no such place it is widened, in the end to the whole
of both chunks, which then grow by a chunk and by twice as much each further time. So the memory of an
encoding is bounded by a chunk, or by the longest part of a document without such places.

Shorter documents are one chunk. For them the same boundary is used the other way round: the words of
PART characters are numbered in arrays, the library encodes each distinct one once, and the ids are put
together by the numbers. Nothing is remembered beyond that, so the memory is bounded by PART or by the
longest word.

Rows are independent, so nothing is shuffled. Edge cases: a null text counts as empty (no tokens); a
text without white space is encoded as one piece; repeated rows are counted each; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import batches, whole_text

CHUNK, OVERLAP = 16_384, 512
#: Characters whose words are numbered together.
PART = 8_000_000
LIMIT = 2048

#: A word of letters is one run of the tokenizer, of which exactly one token ends a word, its last; so many
#: such words are encoded in one text and told apart by that. Signs after letters, if they begin no run of
#: their own and no special string, are a second run, encoded apart from the first. Normalising such
#: letters, which are composed and carry no marks, is lowering them; the lower case of İ has a mark.
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_RUNS = f"^(?P<letters>[{_LETTERS}]+)(?P<signs>[-!#$%&()*+,./:;=?@^_~]*)$"
TOGETHER = 1_000
_BLANK = re.compile(r"[\x20\x09-\x0D]")

#: ids, and for each the first and the end character
Encoded = tuple[list[int], list[tuple[int, int]]]


def _agreed(text: str, left: Encoded, at_left: int, right: Encoded, at_right: int, least: int, end_left: int) -> tuple[int, int, int] | None:
    """Numbers of left tokens before and right tokens from a common boundary after ``least`` in the
    overlap, from its middle outwards, and its place; None if there is none."""
    places = [m.start() for m in _BLANK.finditer(text, max(at_right, least) + 1, end_left - 1)]
    middle = (at_right + end_left) // 2
    l_start, r_start = [a for a, _ in left[1]], [a for a, _ in right[1]]
    # the whole word before and the whole word after, within both chunks
    for before, p, after in sorted(zip(places, places[1:], places[2:], strict=False), key=lambda x: abs(x[1] - middle)):
        i, j = bisect_left(l_start, p - at_left), bisect_left(r_start, p - at_right)
        i0, j0 = bisect_left(l_start, before - at_left), bisect_left(r_start, before - at_right)
        i1, j1 = bisect_left(l_start, after - at_left), bisect_left(r_start, after - at_right)
        tokens = lambda e, a, b, at: [(x, s + at, t + at) for x, (s, t) in zip(e[0][a:b], e[1][a:b], strict=True)]
        if i0 < i < i1 and tokens(left, i0, i1, at_left) == tokens(right, j0, j1, at_right) and left[1][i - 1][1] + at_left <= p:
            return i, j, p
    return None


def spliced(text: str, encode: Callable[[str], Encoded], chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[list[int]]:
    """The ids of ``text``, in pieces that follow each other."""
    if len(text) <= chunk:
        yield encode(text)[0]
        return
    at, end, last = 0, chunk, -1
    now, skip, grow = encode(text[:end]), 0, chunk
    while end < len(text):
        wide = overlap
        while True:
            start = max(at, end - wide)
            until = min(len(text), end + (grow if start == at else max(chunk - wide, overlap)))
            following = encode(text[start:until])
            cut = _agreed(text, now, at, following, start, last, end) if start > at else None
            if cut or start == at:
                break
            wide *= 2
        if cut:
            yield now[0][skip : cut[0]]
            _, skip, last = cut
            grow = chunk
        else:
            grow *= 2  # both chunks have become one; it doubles, so its encodings stay in proportion
        at, end, now = start, until, following
    yield now[0][skip:]


class Words:
    """The library's tokenizer of one file, for texts whose words are encoded once for many."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.plain = Tokenizer.from_str(json.dumps(json.loads(self.library.to_str()) | {"normalizer": None}))
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def with_offsets(self, text: str) -> Encoded:
        e = self.library.encode(text, add_special_tokens=False)
        return e.ids, e.offsets

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of distinct pieces of text (those of letters lowered), one after the other, and where
        those of each piece start and how many they are."""
        letters = pc.match_substring_regex(pieces, f"^[{_LETTERS}]+$").to_numpy(zero_copy_only=False)
        first, sizes = np.zeros(len(pieces), dtype=np.int64), np.zeros(len(pieces), dtype=np.int64)
        held, n = [np.zeros(0, dtype="<u4")], 0

        def keep(at: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
            nonlocal n
            first[at], sizes[at] = n + np.cumsum(size) - size, size
            held.append(ids)
            n += len(ids)

        alone, plain = [np.flatnonzero(~letters)], np.flatnonzero(letters)
        words = pieces.take(pa.array(plain)).to_pylist()
        for k in range(0, len(words), TOGETHER):
            some = words[k : k + TOGETHER]
            ids = np.array(self.plain.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(some):
                keep(plain[k : k + TOGETHER], ids, np.diff(stops, prepend=0))
            else:  # not as expected: one by one
                alone.append(plain[k : k + TOGETHER])
        rest = np.concatenate(alone)
        got = [e.ids for e in self.library.encode_batch_fast(pieces.take(pa.array(rest)).to_pylist(), add_special_tokens=False)]
        keep(rest, np.array([i for ids in got for i in ids], dtype="<u4"), np.array([len(ids) for ids in got], dtype=np.int64))
        return np.concatenate(held), first, sizes

    def _together(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of some texts. ASCII text is lowered first, as the tokenizer would, so that words are
        found in any case; special strings are found before that, so a text that may hold one stays."""
        whole = pa.array(texts, pa.large_string())
        lower = pc.and_(pc.string_is_ascii(whole), pc.invert(pc.match_substring(whole, "<|")))
        split = pc.ascii_split_whitespace(pc.if_else(lower, pc.ascii_lower(whole), whole))
        coded = split.flatten().dictionary_encode()
        number, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
        runs = pc.extract_regex(words, _RUNS)
        one = pc.if_else(runs.is_valid(), pc.utf8_lower(pc.struct_field(runs, "letters")), words)
        two = pc.if_else(runs.is_valid(), pc.struct_field(runs, "signs"), "")
        both = pa.concat_arrays([one, two]).dictionary_encode()
        ids, first, sizes = self._pieces(both.dictionary)
        piece = both.indices.to_numpy(zero_copy_only=False).reshape(2, -1)
        ends = np.concatenate([[0], np.cumsum(sizes[piece].sum(axis=0)[number])])
        at = ends[split.offsets.to_numpy()].tolist()
        piece = piece.T[number].ravel()  # the two pieces of each word, in order
        n = sizes[piece]
        flat = ids[np.repeat(first[piece] - (np.cumsum(n) - n), n) + np.arange(ends[-1])]
        yield from [flat[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)]

    def _huge(self, text: str) -> bytes:
        """The ids of a text that is cut at white space."""
        out, a = [], 0
        while a < len(text):
            cut = _BLANK.search(text, min(a + PART, len(text)))
            b = cut.start() if cut else len(text)
            out += self._together([text[a:b]])
            a = b
        return b"".join(out)

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian 32-bit numbers. Texts are taken PART characters at a
        time, and so is a longer text."""
        for a, b in batches(texts, PART):
            if b == a + 1 and len(texts[a]) > PART:
                yield self._huge(texts[a])
            else:
                yield from self._together(texts[a:b])


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    return Words(path)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        it = words(path)
        for frame in frames:
            texts = frame["text"].tolist()
            short = it.ids([t for t in texts if len(t) <= CHUNK])
            n = [len(next(short)) // 4 if len(t) <= CHUNK else sum(map(len, spliced(t, it.with_offsets))) for t in texts]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n_bytes": frame["n_bytes"], "n_tokens": n, "over_limit": [x > limit for x in n]})

    t = whole_text(text)
    # a doc_id goes through pandas as text, which keeps nulls and large numbers whole
    rows = docs.select(F.col(doc_id).cast("long").cast("string").alias("doc_id"), F.octet_length(t).cast("long").alias("n_bytes"), t.alias("text"))
    counted = rows.mapInPandas(run, "doc_id string, n_bytes long, n_tokens long, over_limit boolean")
    return counted.withColumn("doc_id", F.col("doc_id").cast("long"))
