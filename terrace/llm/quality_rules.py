"""Quality rules at host level: count rule failures by host, shrink the rates with an empirical beta
prior, and join the host verdicts back to the documents.

Everything is built from SQL functions. The measures of a document come from arrays within its row,
so texts are never shuffled; only (host, counts) rows are. A host may hold a third of all rows: its
counts are summed on the map side first. The refused hosts are written as a small table, and Spark
broadcasts it only if the size of its files is under the session's limit.

Edge cases: a null or empty text has no words and fails the base rules. A very long text is measured
whole, in arrays of its words. A null host is a host of its
own. Repeated rows each get their own verdict. An empty table gives an empty result. Columns other
than those named by the arguments are carried along or ignored, and helper columns take free names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import BLANKS, fresh, if_small, let, placed, settle, whole_text, without

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: The further rules count against the host only: symbols per word, repeated lines per line, and the
#: mean length of a word.
MAX_SYMBOLS_PER_WORD = 0.1
MAX_DUP_LINES = 0.3
WORD_LENGTH = (2.0, 14.0)
#: A host is refused, whatever the document, when its shrunken failure rate lies so many standard
#: deviations of the fitted prior above the prior's mean; the limit is held within HOST_RATE.
TAIL = 3.0
HOST_RATE = (0.5, 0.9)
#: The prior weighs between so many and so many documents.
PRIOR_WEIGHT = (10.0, 10_000.0)


def words_of(text: Column) -> Column:
    """The words of a text as an array."""
    return F.array_remove(F.split(without(text, BLANKS[1:], " "), " ", -1), "")


def _windows(words: Column) -> Column:
    """The hash of each three-word window, in order."""

    def hashed(h: Column) -> Column:
        m = F.size(h) - 2
        pairs = F.zip_with(F.slice(h, 1, m), F.slice(h, 2, m), lambda a, b: F.xxhash64(a, b))
        return F.zip_with(pairs, F.slice(h, 3, m), lambda a, b: F.xxhash64(a, b))

    return let(F.transform(words, lambda x: F.xxhash64(x)), hashed)


def _sorted_windows(windows: Column) -> Column:
    """The hash and position of each window, sorted."""
    return F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("hash"), i.cast("long").alias("at"))))


def _covered(keys: Column) -> Column:
    """Words covered by the windows whose hash occurs twice or more among the sorted ``keys``."""
    m = F.size(keys) - 1
    same = F.zip_with(F.slice(keys, 1, m), F.slice(keys, 2, m), lambda a, b: a["hash"] == b["hash"])

    def starts(s: Column) -> Column:
        no = F.array(F.lit(False))
        twice = F.zip_with(F.concat(no, s), F.concat(s, no), lambda a, b: a | b)
        at = F.zip_with(keys, twice, lambda k, d: F.when(d, k["at"]))
        return F.sort_array(F.filter(at, lambda x: x.isNotNull()))

    def union(s: Column) -> Column:
        gaps = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), lambda a, b: F.least(b - a, F.lit(3)))
        return F.aggregate(gaps, F.lit(3).cast("long"), lambda t, x: t + x)

    return let(same, lambda s: F.when(F.array_contains(s, True), let(starts(s), union)).otherwise(F.lit(0)))


def repeat_words(w: Column) -> Column:
    """Words inside three-word windows found twice or more in the text, the first one included. ``w``:
    the words, a column or lambda variable. Only texts in which some window repeats go beyond the
    comparison of the two sizes."""

    counted = lambda x: let(_sorted_windows(x), _covered)
    none = F.lit(0).cast("long")
    repeated = lambda x: F.when(F.size(F.array_distinct(x)) < F.size(x), counted(x)).otherwise(none)
    return F.when(F.size(w) > 3, let(_windows(w), repeated)).otherwise(none)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")


def measures(text: Column) -> Column:
    """A struct of MEASURES; ``text`` is not null."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.trim(x, F.lit(BLANKS))) > 0)
    of_words = let(words_of(text), lambda w: F.struct(F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"), repeat_words(w).alias("again")))
    of_lines = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    symbols = F.length(text) - F.length(without(text, "#*$%&|<>"))
    return let(
        F.struct(of_words.alias("w"), of_lines.alias("l"), symbols.alias("s")),
        lambda x: F.struct(*[c.cast("long").alias(k) for k, c in zip(MEASURES, (x["w"]["n"], x["w"]["chars"], x["s"], x["l"]["dup"], x["l"]["n"], x["w"]["again"]), strict=True)]),
    )


def base_failed(m: dict[str, Column]) -> Column:
    return (m["n_words"] < MIN_WORDS) | (m["n_repeat_words"] * 100 > m["n_words"] * MAX_REPEAT_PERCENT)


def host_failed(m: dict[str, Column]) -> Column:
    """A document that counts against its host: it fails a base rule or one of the further rules."""
    return (
        base_failed(m)
        | (m["n_symbols"] > m["n_words"] * MAX_SYMBOLS_PER_WORD)
        | (m["n_dup_lines"] > m["n_lines"] * MAX_DUP_LINES)
        | ~m["word_chars"].between(m["n_words"] * WORD_LENGTH[0], m["n_words"] * WORD_LENGTH[1])
    )


def host_rates(rows: DataFrame, host: str, failed: str) -> DataFrame:
    """Per host: documents, failures, the failure rate shrunken to the prior, and whether it reaches the
    prior's upper tail (``refused``); a rate of HOST_RATE[1] always does, one below HOST_RATE[0]
    never, and one right at the limit does.

    The prior is a beta distribution whose mean and weight fit the hosts' rates by their moments: with
    m the overall rate and v the variance of the rates (weighted by documents), its weight is
    m (1 - m) / v - 1, held within PRIOR_WEIGHT.
    """
    hosts = rows.groupBy(host).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col(failed).cast("long")).alias("n_failed"))
    hosts = settle(hosts, "host-counts")
    n, f, sq = hosts.agg(F.sum("n_docs"), F.sum("n_failed"), F.sum(F.expr("double(n_failed) * n_failed / n_docs"))).first()
    m = f / n if n else 0.0
    v = max(0.0, sq / n - m * m) if n else 0.0
    weight = min(max(m * (1 - m) / v - 1 if v > 0 else PRIOR_WEIGHT[1], PRIOR_WEIGHT[0]), PRIOR_WEIGHT[1])
    limit = min(max(m + TAIL * math.sqrt(m * (1 - m) / (weight + 1)), HOST_RATE[0]), HOST_RATE[1])
    rated = hosts.withColumn("rate", (F.col("n_failed") + F.lit(weight * m)) / (F.col("n_docs") + F.lit(weight)))
    return rated.withColumn("refused", F.col("rate") >= F.lit(limit))


def _judged(docs: DataFrame, text: str, host: str, carry: list[str], names: dict[str, str]) -> DataFrame:
    """The carried columns, the measures and verdicts under ``names``, measured once and written."""
    box = names["measures"]
    measured = docs.select(*carry, F.col(host).alias(names["host"]), measures(whole_text(text)).alias(box))
    measured = measured.withColumns({names[k]: F.col(box)[k] for k in MEASURES}).drop(box)
    m = {k: F.col(names[k]) for k in MEASURES}
    measured = settle(measured.withColumns({names["base_failed"]: base_failed(m), names["host_failed"]: host_failed(m)}), "quality-measures")
    rates = host_rates(measured, names["host"], names["host_failed"])
    refused = settle(rates.where("refused").select(F.col(names["host"]).alias(names["refused"]), F.lit(True).alias(names["host_refused"])), "refused-hosts")
    judged = measured.join(refused, F.col(names["host"]).eqNullSafe(F.col(names["refused"])), "left")
    refusal = F.col(names["host_refused"]).isNotNull()
    return judged.withColumns({names["host_refused"]: refusal, names["kept"]: ~F.col(names["base_failed"]) & ~refusal})


_HELPERS = (*MEASURES, "measures", "base_failed", "host", "host_failed", "refused", "host_refused", "kept")


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per document: doc_id, the measures, ``base_failed``, ``host_refused`` and ``kept``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(host).alias("host_of_row"))
    return _judged(rows, "text", "host_of_row", ["doc_id"], {k: k for k in _HELPERS}).drop("host", "host_failed", "refused", "n_lines")


def keep_documents(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The documents that pass, with the columns of ``docs``. What is written are the measures and the
    places of the rows that go, no texts."""
    names = {k: fresh(docs, f"__{k}") for k in _HELPERS}
    place = fresh(docs, "__place")
    whole = placed(docs, place)
    judged = _judged(whole, text, host, [place], names)
    dropped = settle(judged.where(~F.col(names["kept"])).select(place), "dropped-rows")
    return whole.join(if_small(dropped), place, "left_anti").select(*docs.columns)
