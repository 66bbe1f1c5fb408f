"""Mixing sources to target weights by temperature.

A source with N tokens has the share p = N / sum N; at exponent a its weight is p^a / sum p^a. The
exponent lies in [0, 1] (0: all sources alike, 1: as they come) and is bisected to the largest mixing
that keeps to a limit: an entropy of the weights that must be reached, or a number of passes over a
source that must not be exceeded. The weights then become token budgets, and each source fills its
budget with passes over its documents, each pass in a permutation of its own; the last pass is cut at
the budget. The stream is divided into blocks; a document's place in its source's budget says which
block it goes to, so every block holds the sources in their weights, and a hash orders each block.

Without a budget it is set so that no source is cut below one whole pass: every document occurs.

Scale: only (source, cell) sums are shuffled for the running totals; a cell is a range of permutation
hashes of about CELL_TOKENS tokens, so a source with a third of all rows is spread over many cells and
the totals take two levels. Each bisection job evaluates all midpoints of LEVELS halvings at once over
the table of sources and returns one row. Everything is built from SQL functions.

Edge cases: a null text has no tokens; a null source is a source of its own; repeated rows are separate
documents; a source without tokens passes once, in block 0; an empty table gives an empty result.
Other columns are carried by ``mix_documents``, whose helper columns take free names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import fresh, if_small, n_words, placed, running_offsets, settle, whole_text

#: Tokens of a cell, about, and of a block.
CELL_TOKENS = 65_536
BLOCK_TOKENS = 1_048_576
#: Halvings of the interval per job, and jobs.
LEVELS, JOBS = 6, 5
MAX_PASSES = 2.0
#: 48 bits of a hash order the permutations.
HASH_RANGE = 1 << 48


def _hash(*parts: Column) -> Column:
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def bisect_exponent(sources: DataFrame, total: int, budget: float | None, target_entropy: float | None, max_passes: float) -> float:
    """The largest exponent whose weights reach ``target_entropy`` (nats), or else the smallest whose
    passes stay within ``max_passes``, to 2^-(LEVELS * JOBS), rounded to six digits."""
    low, high = 0.0, 1.0
    n = F.col("tokens").cast("double")
    share = n / F.lit(float(total))
    power = F.pow(share, F.col("a"))
    for _ in range(JOBS):
        points = [low + (high - low) * k / 2**LEVELS for k in range(1, 2**LEVELS)]
        tried = sources.withColumn("a", F.explode(F.array(*[F.lit(a) for a in points])))
        sums = tried.groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.log(share)).alias("t"), F.max(power / n).alias("most"), F.min(power / n).alias("least"))
        got = sorted(sums.collect(), key=lambda x: x.a)
        if target_entropy is not None:
            holds = [math.log(x.z) - x.a * x.t / x.z >= target_entropy for x in got]
        else:
            holds = [(x.most / x.least if budget is None else x.most / x.z * budget) > max_passes for x in got]
        # for either limit ``holds`` is true up to some exponent and false after it
        k = next((k for k, x in enumerate(holds) if not x), len(points))
        low, high = low + (high - low) * k / 2**LEVELS, low + (high - low) * (k + 1) / 2**LEVELS
    return round(low if target_entropy is not None else high, 6)


def budgets(rows: DataFrame, budget: int | None = None, target_entropy: float | None = None, max_passes: float = MAX_PASSES) -> tuple[DataFrame, float]:
    """Per source: tokens, weight, budget, whole passes and the rest of the last one; and the number of
    blocks. ``rows`` has (source, tokens)."""
    sources = settle(rows.groupBy("source").agg(F.sum("tokens").alias("tokens")), "source-tokens")
    some = sources.where(F.col("tokens") > 0)
    total = some.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        zero = F.lit(0).cast("long")
        return settle(sources.select("source", "tokens", F.lit(0.0).alias("weight"), zero.alias("budget"), zero.alias("whole"), zero.alias("rest")), "budgets"), 1.0
    a = bisect_exponent(some, total, budget, target_entropy, max_passes)
    power = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(a))
    z, least = some.agg(F.sum(power), F.min(power / F.col("tokens"))).first()
    # without a budget: the smallest that gives every source one whole pass
    size = float(budget) if budget is not None else z / least
    n, weight = F.col("tokens"), F.when(F.col("tokens") > 0, power / F.lit(z)).otherwise(F.lit(0.0))
    own = F.round(F.col("weight") * F.lit(size)).cast("long")
    table = sources.withColumn("weight", weight).withColumn("budget", own if budget is not None else F.greatest(own, n))
    table = table.withColumn("whole", F.when(n > 0, F.expr("budget div tokens")).otherwise(F.lit(1).cast("long")))
    table = table.withColumn("rest", F.when(n > 0, F.col("budget") % n).otherwise(F.lit(0).cast("long")))
    return settle(table, "budgets"), float(max(1, -(-int(size) // BLOCK_TOKENS)))


def schedule(rows: DataFrame, table: DataFrame, n_blocks: float, seed: int = 0) -> DataFrame:
    """(id, source, tokens) rows of ``rows`` once per pass that reaches them, with ``pass``, ``block``
    and ``block_order``. A pass goes through its source in the order of a hash of (seed, pass, id)."""
    same = F.col("source").eqNullSafe(F.col("of_source"))
    held = table.select(F.col("source").alias("of_source"), F.col("tokens").alias("of_tokens"), "budget", "whole", "rest")
    dealt = rows.join(held, same).withColumn("pass", F.explode(F.expr("sequence(0L, whole - if(rest > 0, 0, 1))")))
    dealt = dealt.where((F.col("pass") < F.col("whole")) | (F.col("rest") > 0))
    dealt = dealt.withColumn("at", _hash(F.lit(seed), F.col("pass"), F.col("id")))
    n_cells = F.expr(f"greatest(1, of_tokens div {CELL_TOKENS})")
    dealt = dealt.withColumn("cell", F.col("pass") * n_cells + F.floor(F.col("at") / F.lit(float(HASH_RANGE)) * n_cells)).drop("of_source")
    sums = dealt.groupBy("source", "cell").agg(F.sum("tokens").alias("n"))
    starts = running_offsets(sums, ["source"], "cell", "n", "start").select(F.col("source").alias("s"), F.col("cell").alias("c"), "start")
    inside = Window.partitionBy("source", "cell").orderBy("at", "id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    within = dealt.withColumn("inner", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    placed = within.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c")))
    before = F.col("start") + F.col("inner")
    placed = placed.withColumn("before", before).where((F.col("pass") < F.col("whole")) | (F.col("before") < F.col("budget")))
    block = F.when(F.col("budget") > 0, F.least(F.floor(F.col("before") / F.col("budget") * F.lit(n_blocks)), F.lit(n_blocks - 1))).otherwise(F.lit(0))
    return placed.select("id", "source", "tokens", "pass", block.cast("long").alias("block"), _hash(F.lit(seed), F.lit("block"), F.col("pass"), F.col("id")).alias("block_order"))


def mix(docs: DataFrame, budget: int | None = None, target_entropy: float | None = None, max_passes: float = MAX_PASSES, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed stream: doc_id, source, n_tokens, pass, block, block_order; its order is (block,
    block_order, doc_id)."""
    rows = settle(docs.select(F.col(doc_id).alias("id"), F.col(source).alias("source"), n_words(whole_text(text)).alias("tokens")), "mix-rows")
    table, n_blocks = budgets(rows, budget, target_entropy, max_passes)
    return schedule(rows, table, n_blocks).withColumnRenamed("id", "doc_id").withColumnRenamed("tokens", "n_tokens")


def mix_documents(docs: DataFrame, max_passes: float = MAX_PASSES, text: str = "text", source: str = "source") -> DataFrame:
    """The documents as often as the mixture has them, at least once, with the columns of ``docs``, in no
    order. Only the places of rows that come again are written, no texts."""
    place, again = fresh(docs, "__place"), fresh(docs, "__again")
    whole = placed(docs, place)
    rows = whole.select(F.monotonically_increasing_id().alias("id"), F.col(place).alias("place"), F.col(source).alias("source"), n_words(whole_text(text)).alias("tokens"))
    rows = settle(rows, "mix-rows")
    table, n_blocks = budgets(rows, None, None, max_passes)
    times = schedule(rows.drop("place"), table, n_blocks).groupBy("id").agg(F.count(F.lit(1)).cast("int").alias(again)).where(F.col(again) > 1)
    more = settle(times.join(rows.select("id", F.col("place").alias(place)), "id").select(place, again), "repeated-rows")
    each = F.explode(F.sequence(F.lit(1), F.coalesce(again, F.lit(1))))
    return whole.join(if_small(more), place, "left").withColumn(again, each).select(*docs.columns)
