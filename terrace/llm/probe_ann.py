"""Approximate nearest neighbours by multiprobe p-stable hashing.

Nearness is the inner product. With M the largest norm, a candidate x becomes (x, sqrt(M² - |x|²)) / M and
a query q becomes (q, 0) / |q|: unit vectors whose distance falls as the inner product grows. TABLES
tables hash them by ``k`` Gaussian projections, floor((a·x + b) / WIDTH). A query visits, in each table,
its own bucket and perturbed ones in the order of their estimated success: a neighbour's projection
differs by a normal amount of the neighbours' distance, which gives each step of each projection a
probability, and the product over the projections orders the buckets. The ``probes`` likeliest are
found exactly, projection by projection, keeping the best partial steps. All rows in the visited
buckets are ranked by the exact inner product in double precision; tables are merged at the end.

The index is fitted on SAMPLE queries (those with the smallest hash of their id) whose true neighbours
one pass over all rows gives: their distance, and the fewest probes with which TARGET of them are found.
Where these would be more than MOST_PROBES, ``k`` is lowered: fewer, larger buckets. A query with fewer
than TOP results visits all buckets of the first table, which is exact.

Scale: buckets are dealt to cells by hash; a cell with more than CELL rows (a hot bucket) is split into
pieces that each get its queries. A task reads the rows of a cell, then streams the queries past them,
so it holds CELL rows and a batch of queries. A query sends one row with TOP results from each cell it
visits. Equal vectors are one candidate with their TOP + 1 smallest ids, which is all of them that any
result can hold, so copies cost nothing. Vectors are copied once a table, and a query once a cell. On
vectors without structure (as in the given tables: 64 random dimensions) near and far hardly differ,
and the recall takes a large share of all rows: about half at 50,000 rows, whatever the parameters.

Edge cases: vectors that are null, empty, zero or hold nulls or non-finite numbers take no part, nor do
rows without an id; vectors are compared with those of the same length only; a repeated row counts once,
and rows with a query's id are its own, so they are none of its candidates; equal scores go by id; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import settle

TABLES = 4
#: Width of a bucket along one projection, for unit vectors.
WIDTH = 2.0
#: Rows in a bucket, about, and rows of a cell.
BUCKET, CELL = 128, 8192
#: Queries the index is fitted on, the share of their neighbours to find, and the most probes a table.
SAMPLE, TARGET, MOST_PROBES = 128, 0.95, 1024
SEED = 20_177
#: Stands for the id of a row that has several.
NOBODY = -(2**63)


class Hashing:
    """The hash functions of all tables and the order of probes."""

    def __init__(self, dims: int, k: int, scale: float, near: float = 1.0) -> None:
        rng = np.random.default_rng(SEED)
        self.a = rng.standard_normal((TABLES, dims + 1, max(k, 1)))[:, :, :k]
        self.b = rng.uniform(0, WIDTH, (TABLES, max(k, 1)))[:, :k]
        self.mix = rng.integers(1, 2**63, (max(k, 1),), dtype=np.uint64)[:k] | np.uint64(1)
        self.k, self.scale, self.near = k, scale, max(near, 1e-3)

    def places(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Projections in units of a bucket: (tables, rows, k)."""
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        if query:
            unit = np.hstack([x / norm, np.zeros_like(norm)])
        else:
            unit = np.hstack([x / self.scale, np.sqrt(np.maximum(0.0, 1 - (norm / self.scale) ** 2))])
        return (np.einsum("rd,tdk->trk", unit, self.a, optimize=True) + self.b[:, None, :]) / WIDTH

    def keys(self, cells: np.ndarray) -> np.ndarray:
        """One number for the k cells of a bucket."""
        out = np.zeros(cells.shape[:-1], dtype=np.uint64)
        for j in range(self.k):
            out = (out ^ (cells[..., j].astype(np.int64).astype(np.uint64) * self.mix[j])) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out.astype(np.int64)

    def costs(self, at: np.ndarray, step: int) -> np.ndarray:
        """Minus the log of the probability that a neighbour lies ``step`` cells on from places ``at``."""
        low = (np.floor(at) + step - at) * WIDTH / self.near
        return -np.log(np.maximum(_normal(low + WIDTH / self.near) - _normal(low), 1e-12))

    def probes(self, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For the places (rows, k) of queries in one table: the keys of the ``n`` likeliest buckets (or
        all within two steps) and their costs, the likeliest first. The cheapest sums have the cheapest
        sums over fewer projections as their parts, so keeping ``n`` of those loses none."""
        rows = len(at)
        cost, steps = np.zeros((rows, 1)), np.zeros((rows, 1, self.k), dtype=np.int8)
        for j in range(self.k):
            option = np.stack([self.costs(at[:, j], s) for s in (-2, -1, 0, 1, 2)], axis=1)
            total = (cost[:, :, None] + option[:, None, :]).reshape(rows, -1)
            keep = np.argpartition(total, n - 1, axis=1)[:, :n] if total.shape[1] > n else np.broadcast_to(np.arange(total.shape[1]), total.shape)
            cost = np.take_along_axis(total, keep, axis=1)
            steps = np.take_along_axis(steps, (keep // 5)[:, :, None], axis=1)
            steps[:, :, j] = keep % 5 - 2
        order = np.argsort(cost, axis=1, kind="stable")
        cells = np.floor(at)[:, None, :] + np.take_along_axis(steps, order[:, :, None], axis=1)
        return self.keys(cells), np.take_along_axis(cost, order, axis=1)


def _normal(z: np.ndarray) -> np.ndarray:
    """The normal distribution function."""
    return 0.5 * (1 + np.vectorize(math.erf, otypes=[float])(z / math.sqrt(2))) if z.size else z


def matrix(column, kind: str) -> np.ndarray:
    """Vectors held as bytes of numbers, as rows of doubles."""
    parts = [bytes(x) for x in column]
    return np.frombuffer(b"".join(parts), dtype=kind).reshape(len(parts), -1).astype(np.float64)


def exactly(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed in one order, so that equal vectors score alike wherever they stand."""
    return (left * right).sum(axis=1)


class Cell:
    """Rows of a cell, bucket by bucket, and the queries' nearest among those they visit."""

    def __init__(self, x: np.ndarray, ids: list[list[int]], bucket: np.ndarray) -> None:
        order = np.argsort(bucket, kind="stable")
        self.x, self.ids = np.ascontiguousarray(x[order]), [ids[k] for k in order.tolist()]
        self.buckets, self.starts = np.unique(bucket[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(x))
        self.alone = np.array([i[0] if len(i) == 1 else NOBODY for i in self.ids], dtype=np.int64)

    def visits(self, wanted: list) -> tuple[np.ndarray, np.ndarray]:
        """(query, bucket) numbers of all visits, by bucket; a query that wants None visits every bucket."""
        flat = [self.buckets if w is None else np.asarray(w, dtype=np.int64) for w in wanted]
        owner, flat = np.repeat(np.arange(len(flat)), [len(w) for w in flat]), np.concatenate(flat)
        at = np.minimum(np.searchsorted(self.buckets, flat), len(self.buckets) - 1)
        here = self.buckets[at] == flat
        owner, at = owner[here], at[here]
        order = np.argsort(at, kind="stable")
        return owner[order], at[order]

    def nearest(self, q: np.ndarray, query_ids: np.ndarray, wanted: list, top: int) -> list[tuple[list, list]]:
        """For each query the ``top`` nearest rows of its buckets as ids and scores, nearest first, ties to
        the smaller id. A bucket meets all its queries in one product; what falls behind a query's ``top``
        best so far is dropped at once."""
        owner, at = self.visits(wanted)
        edge = np.full(len(q), -np.inf)
        held: list[tuple] = []
        n_held = 0
        cuts = np.flatnonzero(np.diff(at)) + 1
        for queries, b in zip(np.split(owner, cuts), at[np.concatenate([[0], cuts])].tolist() if len(at) else [], strict=False):
            low = int(self.starts[b])
            rough = q[queries] @ self.x[low : int(self.ends[b])].T
            i, j = np.nonzero(rough >= edge[queries][:, None])
            other = self.alone[low + j] != query_ids[queries[i]]
            i, j = i[other], j[other]
            held.append((queries[i], low + j, rough[i, j]))
            n_held += len(i)
            if n_held > 4 * top * len(q):
                held = [_foremost(held, edge, top)]
                n_held = len(held[0][0])
        if not n_held:
            return [([], [])] * len(q)
        mine, row, _ = _foremost(held, edge, top)
        scores = exactly(q[mine], self.x[row]).tolist()
        found: list[list] = [[] for _ in range(len(q))]
        for k, r, s in zip(mine.tolist(), row.tolist(), scores, strict=True):
            found[k] += [(-s, i) for i in self.ids[r] if i != query_ids[k]]
        found = [sorted(f)[:top] for f in found]
        return [([i for _, i in f], [-s for s, _ in f]) for f in found]


def _foremost(held: list[tuple], edge: np.ndarray, top: int) -> tuple:
    """Of (query, row, rough score) the ``top`` best of each query and what may equal the last of them;
    raises ``edge``, the score that a later row must reach."""
    query, row, score = (np.concatenate([h[c] for h in held]) for c in range(3))
    order = np.lexsort((-score, query))
    query, row, score = query[order], row[order], score[order]
    first = np.concatenate([[True], query[1:] != query[:-1]])
    starts = np.flatnonzero(first)
    nth = np.arange(len(query)) - starts[np.cumsum(first) - 1]
    last = nth == top - 1
    edge[query[last]] = score[last] - 1e-9 * np.maximum(1.0, np.abs(score[last]))
    keep = score >= edge[query]
    return query[keep], row[keep], score[keep]


RESULT = "qid long, query_id long, ids array<long>, scores array<double>"
HIT = "array<struct<minus: double, vec_id: bigint>>"


def merged(partial: DataFrame, top: int) -> DataFrame:
    """(qid, query_id, hits): the nearest of all cells that a query visited. A row may come from each
    table, so the first TABLES * top hold the top different ones."""
    pairs = F.transform(F.arrays_zip("ids", "scores"), lambda z: F.struct((-z["scores"]).alias("minus"), z["ids"].alias("vec_id")))
    ordered = F.sort_array(F.flatten(F.collect_list(pairs)))
    return partial.groupBy("qid", "query_id").agg(F.slice(F.array_distinct(F.slice(ordered, 1, TABLES * top)), 1, top).alias("hits"))


class Index:
    """One index over the vectors of one length."""

    def __init__(self, points: DataFrame, queries: DataFrame, dims: int, n: int, n_ids: int, longest: float, kind: str, top: int) -> None:
        self.needed = min(top, n_ids - 1)
        self.points, self.queries, self.dims, self.n, self.kind, self.top = points, queries, dims, n, kind, top
        self.scale = longest or 1.0
        self.hashing, self.n_probes = self._fitted()

    def _nearest_of(self, sample: pd.DataFrame) -> pd.DataFrame:
        """True neighbours of the sampled queries, by one pass over all rows."""
        kind, top, qid, query_id = self.kind, self.top, sample["qid"].tolist(), sample["query_id"].to_numpy()
        q = matrix(sample["v"], kind)

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                rows = Cell(matrix(frame["v"], kind), [a.tolist() for a in frame["ids"]], np.zeros(len(frame), dtype=np.int64))
                found = rows.nearest(q, query_id, [None] * len(q), top)
                yield pd.DataFrame({"qid": qid, "query_id": query_id, "ids": [a for a, _ in found], "scores": [b for _, b in found]})

        hits = merged(self.points.select("ids", "v").mapInPandas(run, RESULT), top).select("qid", F.explode("hits.vec_id").alias("id"))
        one = self.points.select(F.explode("ids").alias("id"), "v")
        return one.join(F.broadcast(hits), "id").select("qid", "v").toPandas()  # SAMPLE * top rows on either side

    def _fitted(self) -> tuple[Hashing, int]:
        k = max(0, int(math.log2(max(1, self.n / BUCKET))))
        sample = self.queries.orderBy(F.xxhash64("query_id"), "qid").limit(SAMPLE).select("qid", "query_id", "v").toPandas()
        pairs = self._nearest_of(sample) if len(sample) and k else []
        if not len(pairs):
            return Hashing(self.dims, 0, self.scale), 1
        of = {int(q): i for i, q in enumerate(sample["qid"])}
        q, x = matrix(sample["v"], self.kind), matrix(pairs["v"], self.kind)
        at = np.array([of[int(i)] for i in pairs["qid"]])
        cosine = np.clip(exactly(q[at], x) / np.linalg.norm(q[at], axis=1) / self.scale, -1, 1)
        near = float(np.median(np.sqrt(2 - 2 * cosine)))
        while True:
            h = Hashing(self.dims, k, self.scale, near)
            q_at, x_at = h.places(q, True), h.places(x, False)
            rank = np.full(len(x), MOST_PROBES + 1)
            for t in range(TABLES):
                keys, _ = h.probes(q_at[t], MOST_PROBES)
                hit = keys[at] == h.keys(np.floor(x_at[t]))[:, None]
                rank = np.minimum(rank, np.where(hit.any(axis=1), hit.argmax(axis=1) + 1, MOST_PROBES + 1))
            need = int(np.sort(rank)[min(len(rank) - 1, int(TARGET * len(rank)))])
            if need <= MOST_PROBES or k == 0:
                return h, need
            k -= 1

    def _hashed(self) -> DataFrame:
        """Candidates with their bucket in each table."""
        h, kind = self.hashing, self.kind

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                yield frame.assign(buckets=h.keys(np.floor(h.places(matrix(frame["v"], kind), False))).T.tolist())

        return settle(self.points.select("ids", "v").mapInPandas(run, "ids array<long>, v binary, buckets array<long>"), "ann-hashed")

    def _visits(self, queries: DataFrame, cells: int) -> DataFrame:
        """(tbl, cell, qid, query_id, v, buckets): the buckets that a query visits, by cell."""
        h, kind, n = self.hashing, self.kind, self.n_probes

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for whole in frames:
                for a in range(0, len(whole), 256):
                    frame = whole.iloc[a : a + 256]
                    places = h.places(matrix(frame["v"], kind), True)
                    for t in range(TABLES):
                        keys, _ = h.probes(places[t], n)
                        cell = keys % cells
                        order = np.argsort(cell, axis=1, kind="stable")
                        rows = []
                        for row, (keys_, cell_) in zip(frame.itertuples(index=False), zip(np.take_along_axis(keys, order, 1), np.take_along_axis(cell, order, 1), strict=True), strict=True):
                            cuts = np.flatnonzero(np.diff(cell_)) + 1
                            for part, c in zip(np.split(keys_, cuts), cell_[np.concatenate([[0], cuts])].tolist(), strict=True):
                                rows.append((t, c, row.qid, row.query_id, row.v, part.tolist()))
                        yield pd.DataFrame(rows, columns=["tbl", "cell", "qid", "query_id", "v", "buckets"])

        return queries.select("qid", "query_id", "v").mapInPandas(run, "tbl int, cell long, qid long, query_id long, v binary, buckets array<long>")

    def _ranked(self, rows: DataFrame, visits: DataFrame) -> DataFrame:
        """The nearest of each cell for each query that visits it. Rows of a cell come before its queries."""
        kind, top = self.kind, self.top

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            now, held, cell = None, [], None
            for frame in frames:
                for name, part in frame.groupby(["tbl", "cell", "piece"], sort=False):
                    if name != now:
                        now, held, cell = name, [], None
                    points = part[part["query_id"].isna()]
                    if len(points):
                        held.append(points)
                    asking = part[part["query_id"].notna()]
                    if not len(asking) or not held:
                        continue
                    if cell is None:
                        rows = pd.concat(held)
                        cell = Cell(matrix(rows["v"], kind), [a.tolist() for a in rows["ids"]], np.array([b[0] for b in rows["buckets"]], dtype=np.int64))
                    for a in range(0, len(asking), 512):
                        some = asking.iloc[a : a + 512]
                        query_id = np.array([int(i) for i in some["query_id"]], dtype=np.int64)
                        found = cell.nearest(matrix(some["v"], kind), query_id, some["buckets"].tolist(), top)
                        some = pd.DataFrame({"qid": some["qid"].to_numpy(), "query_id": query_id, "ids": [i for i, _ in found], "scores": [x for _, x in found]})
                        yield some[[len(i) > 0 for i in some["ids"]]]

        # ids go through pandas as text, which keeps nulls apart and large numbers whole
        columns = ["tbl", "cell", "piece", F.col("qid"), F.col("query_id").cast("string").alias("query_id"), "v", "buckets", "ids"]
        none = {"qid": F.lit(-1).cast("long"), "query_id": F.lit(None).cast("long")}
        both = rows.withColumns(none).select(*columns).unionByName(visits.withColumn("ids", F.lit(None).cast("array<long>")).select(*columns))
        dealt = both.repartition("tbl", "cell", "piece").sortWithinPartitions("tbl", "cell", "piece", F.col("query_id").asc_nulls_first())
        return dealt.mapInPandas(run, RESULT)

    def search(self) -> DataFrame:
        """(qid, query_id, hits) for every query."""
        hashed = self._hashed()
        cells = max(1, -(-self.n // CELL))
        spread = hashed.select("ids", "v", F.posexplode("buckets").alias("tbl", "bucket")).withColumn("cell", F.pmod("bucket", F.lit(cells)))
        pieces = settle(spread.groupBy("tbl", "cell").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("pieces")), "ann-cells")
        part = F.pmod(F.xxhash64(F.col("ids")[0]), F.col("pieces")).alias("piece")
        rows = spread.join(pieces, ["tbl", "cell"]).select("tbl", "cell", part, "v", F.array("bucket").alias("buckets"), "ids")
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece")

        def asked(visits: DataFrame) -> DataFrame:
            return visits.join(pieces, ["tbl", "cell"]).select("tbl", "cell", each, "qid", "query_id", "v", "buckets")

        first = settle(merged(self._ranked(rows, asked(self._visits(self.queries, cells))), self.top), "ann-first")
        enough = first.where(F.size("hits") >= self.needed)
        short = self.queries.join(enough, "qid", "left_anti").select("qid", "query_id", "v")
        if short.isEmpty():
            return first
        # the first table holds each row once: a visit of all its buckets is exact
        all_cells = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))).alias("cell")
        everywhere = short.select(F.lit(0).alias("tbl"), all_cells, "qid", "query_id", "v", F.lit(None).cast("array<long>").alias("buckets"))
        return enough.unionByName(merged(self._ranked(rows.where("tbl = 0"), asked(everywhere)), self.top))


def prepared(vectors: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, str]:
    """Distinct (vec_id, v, dims, norm) of the rows that take part, vectors as bytes, and their number type."""
    narrow = vectors.schema[embedding].dataType.elementType.simpleString() == "float"
    kind = "<f4" if narrow else "<f8"
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast(f"array<{'float' if narrow else 'double'}>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & sound).where(F.exists("v", lambda x: x != 0))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            each = [np.asarray(v, dtype=kind) + np.array(0, dtype=kind) for v in frame["v"]]  # no negative zeros
            norms = [float(np.linalg.norm(v.astype(np.float64))) for v in each]
            yield pd.DataFrame({"vec_id": frame["vec_id"], "v": [v.tobytes() for v in each], "dims": [len(v) for v in each], "norm": norms})

    return settle(rows.mapInPandas(run, "vec_id long, v binary, dims int, norm double").dropDuplicates(["vec_id", "v"]), "ann-vectors"), kind


def search(vectors: DataFrame, every: int = 20, top: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the ``top`` nearest found, for every row whose id ``every``
    divides."""
    base, kind = prepared(vectors, vec_id, embedding)
    queries = settle(
        base.where(F.col("vec_id") % every == 0).select(F.monotonically_increasing_id().alias("qid"), F.col("vec_id").alias("query_id"), "v", "dims"), "ann-queries"
    )
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    fewest = base.withColumn("nth", nth).where(F.col("nth") <= top + 1)
    points = settle(fewest.groupBy("v", "dims").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-points")
    sizes = points.groupBy("dims").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("ids")).alias("n_ids"))
    longest = base.groupBy("dims").agg(F.max("norm").alias("longest"))
    found = [
        Index(points.where(F.col("dims") == s.dims), queries.where(F.col("dims") == s.dims), s.dims, s.n, s.n_ids, s.longest, kind, top).search()
        for s in sizes.join(longest, "dims").orderBy("dims").collect()  # a row for each length of vectors
    ]
    hits = found[0] if found else vectors.sparkSession.createDataFrame([], f"qid long, query_id long, hits {HIT}")
    for more in found[1:]:
        hits = hits.unionByName(more)
    each = hits.select("query_id", F.posexplode("hits").alias("at", "hit"))
    return each.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (0.0 - F.col("hit.minus")).alias("score"))
