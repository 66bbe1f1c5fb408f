"""Secret scan: three fixed patterns, and strings that pass a battery of randomness tests.

Candidates of the battery are runs of key characters of LEAST or more with both a letter and a digit.
The smallest alphabet that holds a candidate is its inferred encoding. Under the hypothesis that the
symbols are drawn evenly and independently from that alphabet, three tests give tail probabilities:
chi-squared of the symbol counts (too uneven), the runs above and below the middle of the alphabet
(too few or too many), and the correlation of neighbours. The smallest of the three, corrected for
their number, is the candidate's p: even over (0, 1) for random strings, next to 0 for names and words.

False discoveries are words taken as random, and short strings are easily mistaken. So the acceptance
level is set per encoding and length class from the distinct candidates of all documents: random strings
alone fill the upper half of p, which gives their number; at a level t, (1 - t) of them lie above, and
what lies above beyond that is not random. Of the levels whose share of such strings is at most
MAX_FALSE, the lowest is taken. A class with fewer than ENOUGH strings above the lowest level tells too
little: it takes the level of its length class over all encodings, and where that is as thin, the level
of all candidates. A table that is thin as a whole takes THIN_LEVEL at most. What has ENOUGH strings
above the lowest level but no level that fits holds no random ones and accepts nothing.

Everything is built from SQL functions. Matches are located by splitting the text at the pattern: the
lengths of the pieces and of the matches add up to the positions. Only the matches leave the scan,
never the texts, and running sums go over the matches of one document and kind.

Edge cases: a null or empty text has no spans (an empty list, whose hash is that of the empty string).
Equal rows are scanned separately. Positions are code points, ends exclusive, of the whole text. An
empty table gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import let, settle, whole_text

# The kinds in their order, their patterns (group 1 of assign is the value), the least
# length of the value or match.
PATTERNS = {
    "assign": ("(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 6),
    "access": ("AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": ("[0-9a-f]{24,}", 0, 24),
    "random": ("[A-Za-z0-9+/_-]{20,}={0,2}", 0, 20),
}
KINDS = tuple(PATTERNS)
BASE = KINDS[:3]
# Alphabets of the encodings, narrowest first.
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "hex": DIGITS + "abcdef",
    "hex_upper": DIGITS + "ABCDEF",
    "base32": UPPER + "234567",
    "base36": DIGITS + LOWER,
    "base36_upper": DIGITS + UPPER,
    "base62": DIGITS + UPPER + LOWER,
    "base64": UPPER + LOWER + DIGITS + "+/",
    "base64_url": UPPER + LOWER + DIGITS + "-_",
}
#: Length classes start here; the last has no end.
LENGTH_CLASSES = (20, 32, 48, 64)
#: Candidate acceptance levels, and the share of non-random strings that is put up with.
LEVELS = (0.001, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5)
MAX_FALSE = 0.1
#: Distinct strings that a level of their own takes, and the level of a table with fewer.
ENOUGH = 50
THIN_LEVEL = 0.05


def _found(text: Column, kind: str) -> Column:
    """The matches of a kind as (kind, nth, gap before in code points, match, value)."""
    pattern, group, _ = PATTERNS[kind]
    p = F.lit(pattern)

    def located(m: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        values = F.regexp_extract_all(text, p, F.lit(group)) if group else m
        return F.transform(
            F.arrays_zip(F.transform(gaps, lambda x: F.length(x).cast("long")).alias("gap"), m.alias("match"), values.alias("value")),
            lambda x, i: F.struct(F.lit(KINDS.index(kind)).alias("kind"), i.alias("nth"), x["gap"].alias("gap"), x["match"].alias("match"), x["value"].alias("value")),
        )

    empty = "array<struct<kind:int,nth:int,gap:bigint,match:string,value:string>>"
    return let(F.regexp_extract_all(text, p, F.lit(0)), lambda m: F.when(F.size(m) > 0, located(m)).otherwise(F.array().cast(empty)))


def matches(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """All documents as (row, doc_id), and all matches as (row, kind, start, stop, match)."""
    t = whole_text(text)
    found = F.concat(*[_found(F.col("t"), k) for k in KINDS])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), t.alias("t"))
    rows = settle(rows.select("row", "doc_id", found.alias("found")), "secret-matches")
    each = rows.select("row", F.explode("found").alias("m")).select("row", "m.*")
    done = Window.partitionBy("row", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    # up to and with a match: all gaps and matches so far; the piece after the last match has none
    stop = F.sum(F.col("gap") + F.coalesce(F.length("match"), F.lit(0))).over(done)
    each = each.withColumn("stop", stop).where(F.col("match").isNotNull())
    least = F.element_at(F.array(*[F.lit(PATTERNS[k][2]) for k in KINDS]), F.col("kind") + 1)
    each = each.where(F.length("value") >= least)
    return rows.select("row", "doc_id"), each.select("row", "kind", (F.col("stop") - F.length("match")).alias("start"), "stop", "match")


# --- the battery -----------------------------------------------------------------------------------


def _beyond(z: Column) -> Column:
    """The upper tail of the normal distribution, by a logistic curve that is right to 2e-4."""
    z = F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(z * 1.5976 + z * z * z * 0.070566))


def _both(z: Column) -> Column:
    return F.least(F.lit(1.0), _beyond(F.abs(z)) * 2)


def battery(candidates: DataFrame, token: str) -> DataFrame:
    """Add encoding, length and p of each candidate; encoding and p are null for those that no
    alphabet holds or that lack a letter or digit."""
    body = F.regexp_replace(token, "=+$", "")
    encoding = F.coalesce(*[F.when(body.rlike(f"^[{a.replace('-_', '_-')}]+$"), F.lit(k)) for k, a in ALPHABETS.items()])
    mixed = body.rlike("[0-9]") & body.rlike("[A-Za-z]")
    df = candidates.withColumn("body", body).withColumn("encoding", F.when(mixed, encoding))
    letters = F.create_map(*[F.lit(x) for pair in ALPHABETS.items() for x in pair])
    df = df.withColumn("alphabet", F.element_at(letters, F.col("encoding"))).withColumn("length", F.length("body"))
    n, k = F.col("length").cast("double"), F.length("alphabet").cast("double")
    df = df.withColumn("x", F.expr("transform(split(body, ''), c -> double(instr(alphabet, c) - 1))"))
    squares = F.expr("aggregate(split(alphabet, ''), 0D, (s, c) -> s + pow(length(body) - length(replace(body, c)), 2))")
    chi = squares * k / n - n
    z_chi = (chi - (k - 1)) / F.sqrt((k - 1) * 2 * (1 - 1 / n))
    df = df.withColumn("p_chi", _beyond(z_chi))
    df = df.withColumn("up", F.expr("transform(x, v -> int(v >= length(alphabet) / 2))"))
    high = F.expr("aggregate(up, 0, (s, v) -> s + v)").cast("double")
    runs = F.expr("1 + aggregate(zip_with(slice(up, 1, size(up) - 1), slice(up, 2, size(up) - 1), (a, b) -> int(a != b)), 0, (s, v) -> s + v)").cast("double")
    pairs = high * (n - high) * 2
    z_runs = (runs - pairs / n - 1) / F.sqrt(pairs * (pairs - n) / (n * n * (n - 1)))
    df = df.withColumn("p_runs", F.when((pairs > n), _both(z_runs)).otherwise(F.lit(0.0)))
    df = df.withColumn("mean", F.expr("aggregate(x, 0D, (s, v) -> s + v) / size(x)"))
    df = df.withColumn("spread", F.expr("aggregate(x, 0D, (s, v) -> s + pow(v - mean, 2))"))
    lag = F.expr("aggregate(zip_with(slice(x, 1, size(x) - 1), slice(x, 2, size(x) - 1), (a, b) -> (a - mean) * (b - mean)), 0D, (s, v) -> s + v)")
    df = df.withColumn("p_serial", F.when(F.col("spread") > 0, _both((lag / F.col("spread") + 1 / n) * F.sqrt(n))).otherwise(F.lit(0.0)))
    p = F.lit(1.0) - F.pow(F.lit(1.0) - F.least("p_chi", "p_runs", "p_serial"), F.lit(3.0))
    return df.withColumn("p", F.when(F.col("encoding").isNotNull(), p)).drop("body", "alphabet", "x", "up", "mean", "spread", "p_chi", "p_runs", "p_serial")


def _length_class() -> Column:
    return F.expr("CASE " + " ".join(f"WHEN length >= {a} THEN {a}" for a in reversed(LENGTH_CLASSES)) + " END")


def _fitting(n: list[Column]) -> Column:
    """The lowest level that fits, from the numbers of strings above each level; null if there is none."""
    random = n[-1] / (1 - LEVELS[-1])
    return F.coalesce(*[F.when((x > 0) & (x - random * (1 - t) <= x * MAX_FALSE), F.lit(t)) for x, t in zip(n, LEVELS, strict=True)])


def levels(tested: DataFrame) -> DataFrame:
    """The acceptance level per encoding and length class (at most one row for each pair of them)."""
    above = [F.count_if(F.col("p") > t).alias(f"n{k}") for k, t in enumerate(LEVELS)]
    strings = tested.where("p IS NOT NULL").select("match", "encoding", "length", "p").dropDuplicates(["match"])
    counts = strings.groupBy("encoding", _length_class().alias("length_class")).agg(*above)
    # pools of at most a row for each class: the class, its lengths over all encodings, everything
    own = [F.col(f"n{k}") for k in range(len(LEVELS))]
    same_length, all_ = ([F.sum(n).over(w) for n in own] for w in (Window.partitionBy("length_class"), Window.partitionBy(F.lit(0))))
    thin = F.least(_fitting(all_), F.lit(THIN_LEVEL))  # without a null
    level = F.when(own[0] >= ENOUGH, _fitting(own)).when(same_length[0] >= ENOUGH, _fitting(same_length)).when(all_[0] >= ENOUGH, _fitting(all_)).otherwise(thin)
    return counts.select(F.col("encoding").alias("of_encoding"), F.col("length_class").alias("of_class"), level.alias("level"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    rows, found = matches(docs, doc_id, text)
    found = settle(found, "secret-spans")
    random = KINDS.index("random")
    tested = settle(battery(found.where(F.col("kind") == random), "match"), "secret-tests")
    at = F.broadcast(levels(tested))
    accepted = tested.join(at, (F.col("encoding") == F.col("of_encoding")) & (_length_class() == F.col("of_class"))).where(F.col("p") > F.col("level"))
    spans = found.where(F.col("kind") != random).select("row", "kind", "start", "stop").unionByName(accepted.select("row", "kind", "start", "stop"))
    names = F.array(*[F.lit(k) for k in KINDS])
    said = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))
    counts = [F.count_if(F.col("kind") == k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    per = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "stop"))).alias("s"), *counts)
    per = per.select(
        F.col("row").alias("of_row"),
        *[f"n_{k}" for k in KINDS],
        F.array_join(F.transform(F.filter("s", lambda x: x["kind"] < random), said), ",").alias("base"),
        F.array_join(F.transform("s", said), ",").alias("spans"),
    )
    count = lambda k: F.coalesce(F.col(f"n_{k}"), F.lit(0)).cast("long").alias(f"n_{k}")
    return rows.join(per, F.col("row") == F.col("of_row"), "left").select(
        "doc_id", *[count(k) for k in BASE], F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), count("random")
    )
