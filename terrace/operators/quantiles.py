"""Exact order statistics without gathering a group in one task.

Spark's exact ``percentile``/``median`` keeps a map of every distinct value of the group and merges
it in one task, so a global median over a huge table needs memory proportional to the number of
distinct values on one executor. ``kth_smallest`` instead narrows the value range step by step:

1. collapse duplicates (``groupBy(x).count()``, combined map-side, so a hot value costs one row);
2. take ``buckets - 1`` approximate quantile cut points of the remaining values (a bounded sketch);
3. count rows per bucket (one distributed aggregation, ``buckets`` result rows);
4. keep only the bucket that holds rank ``k`` and repeat, until at most ``final_rows`` distinct
   values remain; those are read in order to pick the exact value.

The driver sees at most ``buckets`` counters or ``final_rows`` values per step; each step shrinks
the candidates by about ``buckets``×, so a few passes suffice even for billions of values.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _in_range(lo, hi) -> Column:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col("x") > F.lit(lo))
    if hi is not None:
        cond = cond & (F.col("x") <= F.lit(hi))
    return cond


def _bucket_of(x: Column, cuts: list, lo: int = 0, hi: int | None = None) -> Column:
    """Number of cut points below ``x`` as a balanced CASE tree: log2(len(cuts)) comparisons per
    row, all inside generated code."""
    hi = len(cuts) if hi is None else hi
    if lo >= hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(x <= F.lit(cuts[mid]), _bucket_of(x, cuts, lo, mid)).otherwise(_bucket_of(x, cuts, mid + 1, hi))


def order_statistics(values: DataFrame, ranks: list[int], buckets: int = 64, final_rows: int = 10_000, accuracy: int = 10_000) -> list:
    """Values at the given 1-based ``ranks`` of ``values`` = frame of (``x``, ``c`` = multiplicity).

    The candidate range narrows to the buckets spanning all requested ranks at once (for a median
    that is the bucket, or two adjacent buckets, holding the middle).
    """
    lo = hi = None  # candidate range (lo, hi]
    below = 0  # rows with x <= lo
    want = sorted(ranks)
    fracs = [i / buckets for i in range(1, buckets)]
    m = None  # distinct candidate values, when known
    stuck = False  # the sketch's cut points no longer narrow the range
    while True:
        cand = values.where(_in_range(lo, hi))
        cuts = None
        if m is None:  # one job for the size and the cut points
            r = cand.agg(F.count(F.lit(1)).alias("m"), F.percentile_approx("x", fracs, accuracy).alias("q")).first()
            m, cuts = r["m"], r["q"] or []
        if m <= final_rows:
            rows = cand.orderBy("x").collect()  # at most final_rows rows
            out, seen, i = {}, below, 0
            for row in rows:
                seen += row["c"]
                while i < len(want) and seen >= want[i]:
                    out[want[i]] = row["x"]
                    i += 1
            if i < len(want):
                raise ValueError("rank outside the data")
            return [out[r] for r in ranks]
        if cuts is None:
            cuts = cand.agg(F.percentile_approx("x", fracs, accuracy).alias("q")).first()["q"]
        cuts = sorted({c for c in cuts if (lo is None or c > lo) and (hi is None or c < hi)})
        if not cuts or stuck:  # halfway between the ends always leaves values on both sides
            ends = cand.agg(F.min("x").alias("a"), F.max("x").alias("b")).first()
            cuts = [(ends["a"] + ends["b"]) // 2 if isinstance(ends["a"], int) else (ends["a"] + ends["b"]) / 2]
        stats = {
            r["b"]: (r["n"], r["d"])
            for r in cand.groupBy(_bucket_of(F.col("x"), cuts).alias("b")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("d")).collect()
        }
        seen, first, last, first_below, distinct = below, None, None, below, 0
        for b in range(len(cuts) + 1):
            n, d = stats.get(b, (0, 0))
            if first is None and seen + n >= want[0]:
                first, first_below = b, seen
            if first is not None:
                distinct += d
            if seen + n >= want[-1]:
                last = b
                break
            seen += n
        if first is None or last is None:
            raise ValueError("rank outside the data")
        new_lo = cuts[first - 1] if first > 0 else lo
        new_hi = cuts[last] if last < len(cuts) else hi
        if (new_lo, new_hi) == (lo, hi):
            if want[0] != want[-1]:  # the ranks lie on both sides of every cut: look for each alone
                return [order_statistics(values, [r], buckets, final_rows, accuracy)[0] for r in ranks]
            stuck = True
        lo, hi, below, m = new_lo, new_hi, first_below, distinct


def kth_smallest(values: DataFrame, k: int, **kw):
    """The ``k``-th smallest (1-based) value of a (``x``, ``c``) frame."""
    return order_statistics(values, [k], **kw)[0]


def exact_median(df: DataFrame, column: str, count: int | None = None, **kw):
    """Exact median of a numeric column (mean of the two middle values for an even count).

    Returns a Python value (Decimal for decimals, float otherwise); NULLs are ignored and an empty
    column gives ``None``. ``count`` (non-NULL values), when already known, saves one pass.
    """
    from pyspark import StorageLevel

    values = (
        df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("x")).agg(F.count(F.lit(1)).alias("c"))
        .persist(StorageLevel.MEMORY_AND_DISK)  # reused by every narrowing step; recomputed if lost
    )
    try:
        n = count if count is not None else (values.agg(F.sum("c").alias("n")).first()["n"] or 0)
        if n == 0:
            return None
        lower, upper = order_statistics(values, [(n + 1) // 2, n // 2 + 1], **kw)
    finally:
        values.unpersist()
    if isinstance(lower, Decimal):
        return (lower + upper) / 2
    return (float(lower) + float(upper)) / 2.0


#: Values that differ only in so many trailing bits share a range of ``middle_values``.
RANGE_BITS = 16


def middle_values(values: DataFrame, bits: int = RANGE_BITS) -> DataFrame:
    """The lower and upper middle of ``values`` = frame of (``u`` long, ``c`` = multiplicity), as one row
    (lower, upper); NULLs without values. A plan only: nothing runs before it does.

    Ranges are runs of 2^``bits`` values. Rows per range combine ahead of their exchange, their running
    sums show in which range either middle lies, and the values of those one or two ranges are ranked.
    The first window holds a row for each range with values (prices in cents: one for each 655 units of
    money), the second at most 2^``bits`` values a middle; no task sees all values. Both read the same
    grouped values, which Spark computes once.
    """
    ranges = values.groupBy(F.shiftright("u", bits).alias("p")).agg(F.sum("c").alias("m"))
    upto, n = F.sum("m").over(Window.orderBy("p")), F.sum("m").over(Window.partitionBy())
    ranges = ranges.select("p", "m", upto.alias("upto"), n.alias("n"))
    ranks = F.array(F.struct(F.lit(1).alias("r"), F.expr("(n + 1) div 2").alias("k")), F.struct(F.lit(2).alias("r"), F.expr("n div 2 + 1").alias("k")))
    found = ranges.select("p", (F.col("upto") - F.col("m")).alias("before"), "upto", F.explode(ranks).alias("t"))
    found = found.where("before < t.k AND t.k <= upto").select("t.r", F.expr("t.k - before").alias("k"), "p")
    # two rows; <=> adds no filter on ``values``, so that both readings of it stay the same
    inside = values.join(F.broadcast(found), F.shiftright("u", bits).eqNullSafe(F.col("p")))
    placed = inside.select("r", "k", "u", "c", F.sum("c").over(Window.partitionBy("r").orderBy("u")).alias("upto"))
    placed = placed.where("upto - c < k AND k <= upto")
    return placed.agg(F.max(F.expr("if(r = 1, u, NULL)")).alias("lower"), F.max(F.expr("if(r = 2, u, NULL)")).alias("upper"))
