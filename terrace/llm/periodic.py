"""Periodic runs of words, found by recursive frequency splitting and a lag scan.

A run is a longest stretch of consecutive words in which words ``q`` apart are identical, for its
smallest such ``q``, of at least max(LEAST, TIMES * q) words. Each word of a run occurs at least TIMES
times in it, so a word with fewer occurrences in a segment belongs to no run there: such words split
the segment, the parts are counted anew, and so on until all words of a part are frequent or the part
is too short. What survives is scanned lag by lag: a run of period q holds at least TIMES words whose
number is a multiple of q, so only every q-th word is compared with the one q further on, m / q
comparisons for m words. Where TIMES of them in a row agree, the stretch is extended word by word to
both sides. Lags go up, and places within a run found before are passed over: a stretch there has the
smaller period. So a text of one word takes about m log m steps, like any other.

Rows are independent, so nothing is shuffled; a text is held by one task, in bytes and as numbers.

Edge cases: a null or blank text has no words and no runs; repeated rows are treated alike; of runs with
equal exponent the first, then the one with the smallest period is the strongest; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import WORD, let, whole_text

#: Words of a run at least, and periods.
LEAST, TIMES = 6, 4

RUN = "struct<start: bigint, length: bigint, period: bigint>"


def segments(codes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of the words (as numbers from 0) in which every word occurs TIMES times or more."""
    todo = [(0, len(codes))]
    while todo:
        a, b = todo.pop()
        if b - a < LEAST:
            continue
        own = codes[a:b]
        if b - a < len(codes) // 8:  # so that counting takes time by the part, not by the text
            own = np.unique(own, return_inverse=True)[1]
        rare = np.flatnonzero(np.bincount(own)[own] < TIMES)
        if not len(rare):
            yield a, b
            continue
        cuts = np.concatenate([[-1], rare, [b - a]])
        wide = np.flatnonzero(np.diff(cuts) > LEAST)
        todo += zip((cuts[wide] + 1 + a).tolist(), (cuts[wide + 1] + a).tolist(), strict=True)


def _ends(same_from, room: int) -> int:
    """Leading agreements, where ``same_from(a, b)`` compares places a to b."""
    done, step = 0, 32
    while done < room:
        same = same_from(done, min(done + step, room))
        if not same.all():
            return done + int(same.argmin())
        done, step = done + len(same), step * 4
    return room


def scan(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of one segment."""
    m, found = len(codes), {}
    covered = np.zeros(m, dtype=np.int64)  # the end of the run that reaches furthest from here
    for q in range(1, m // TIMES + 1):
        every = codes[::q]
        same = every[:-1] == every[1:]
        if len(same) < TIMES - 1:
            break
        hits = same[: len(same) - (TIMES - 2)]
        for k in range(1, TIMES - 1):
            hits = hits & same[k : len(same) - (TIMES - 2) + k]
        if not hits.any():
            continue
        at = np.flatnonzero(hits) * q
        at = at[covered[at] <= at + (TIMES - 1) * q]
        past = -1
        for p in at.tolist():
            if p <= past:
                continue
            right = p + _ends(lambda a, b: codes[p + a : p + b] == codes[p + q + a : p + q + b], m - q - p)
            past = right  # the first place that differs, or the end
            left = p - _ends(lambda a, b: codes[p - b : p - a][::-1] == codes[p + q - b : p + q - a][::-1], p)
            end = right + q
            if end - left >= max(LEAST, TIMES * q) and (left, end) not in found:
                found[left, end] = q
                covered[left:end] = np.maximum(covered[left:end], end)
    return [(a, b - a, q) for (a, b), q in found.items()]


def numbered(words: list) -> np.ndarray:
    """The words as numbers, equal ones alike."""
    seen: dict = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))


def find(words: list) -> list[tuple[int, int, int]]:
    """All runs of the words as (start, length, period), by start, then period."""
    if len(words) < LEAST:
        return []
    codes = numbered(words)
    return sorted((a + start, length, q) for a, b in segments(codes) for start, length, q in scan(codes[a:b]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the most periods, the first of equals."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that stand in a run after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, q in runs:
        gone[start + q] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone).tolist(), strict=False) if not g]


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, runs (by start, then period), strongest (null without runs) and collapsed,
    the words that remain when each run is cut to its first period, with one space between them."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            runs, tops, rest = [], [], []
            for t in frame["text"]:
                words = t.encode().split()  # bytes split at just the six characters of white space
                got = find(words)
                runs.append([dict(zip(("start", "length", "period"), x, strict=True)) for x in got])
                tops.append(dict(zip(("start", "length", "period"), top, strict=True)) if (top := strongest(got)) else None)
                rest.append(b" ".join(collapsed(words, got)).decode())
            yield pd.DataFrame({"doc_id": frame["doc_id"], "runs": runs, "strongest": tops, "collapsed": rest})

    # a doc_id goes through pandas as text, which keeps nulls and large numbers whole
    rows = docs.select(F.col(doc_id).cast("long").cast("string").alias("doc_id"), whole_text(text).alias("text"))
    found = rows.mapInPandas(run, f"doc_id string, runs array<{RUN}>, strongest {RUN}, collapsed string")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def looped(doc_id: Column, text: Column) -> Column:
    """``text`` with its words repeated from some place on, where a hash of doc_id says so (never for a
    null doc_id): the fixed edit that the registered query makes before it looks for runs."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def edit(words: Column) -> Column:
        n = F.size(words)

        def repeat(place: Column) -> Column:
            a, p = place["a"], place["p"]
            return F.array_join(F.transform(words, lambda _, i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

        a = g % n
        return F.when(n > 0, let(F.struct(a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("p")), repeat)).otherwise(text)

    return F.when(h % 10 == 0, let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), edit)).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run and the digests of the runs and of the remaining words."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("strongest.start").alias("start"),
        F.col("strongest.length").alias("length"),
        F.col("strongest.period").alias("period"),
        F.expr("strongest.length * 1000 div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
