"""Approximate nearest neighbours by inner product: balanced posting lists behind an in-memory graph of centroids.

Vectors get one more component, the square root of the largest squared norm less their own. A query
gets 0 there and is brought to the largest norm, which does not change its order, so that the nearest
by distance is the largest by inner product whatever the norms are. A bounded sample is split at medians until the
pieces are small; their means are the centroids, linked into a neighbour graph that every task holds.
A vector goes to the list of its nearest centroid, and near a boundary also to others whose distance
is little more. A query walks the graph and searches the lists whose distance ratio is low enough,
however many these are, and farther ones until it has enough candidates. The ratio is fitted: the true nearest of
a bounded sample of queries, found by comparing all vectors with them, tell how far their lists are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaylake.session import materialize

SAMPLE = 20_000  # vectors, in the mean, that the centroids are fitted on
LIST_LENGTH = 200  # vectors of a list, in the mean, while there are fewer than MAX_LISTS
MAX_LISTS = 8_192
DEGREE, BEAM, STEPS = 24, 64, 40
COPIES, COPY_RATIO = 6, 1.05  # lists of a boundary vector, and how much farther than the nearest they may be
FIT_QUERIES = 200  # queries, in the mean, that the ratio is fitted on
FIT_RECALL = 0.97  # share of their true nearest whose lists the ratio has to take in
WALK_RECALL = 0.99  # share of the lists within the ratio that the walk has to find for them; else all centroids are compared
NEAR = 3  # lists of a query that are searched first; the others give only what may beat what these have
TILE = 1_024  # vectors, and queries, of a list that meet in one task


def _augment(v: np.ndarray, top: float) -> np.ndarray:
    return np.column_stack([v, np.sqrt(np.maximum(top - (v * v).sum(axis=1), 0))])


def _augment_queries(q: np.ndarray, top: float) -> np.ndarray:
    """On (q, 0) scaled to the norm of the augmented vectors, squared distances are 2 top less twice the scaled inner product."""
    q = q / np.abs(q).max(axis=1, keepdims=True)  # squares of tiny components would vanish
    scale = np.sqrt(top) / np.sqrt((q * q).sum(axis=1, keepdims=True))
    return np.column_stack([q * scale, np.zeros(len(q))])


class Centroids:
    def __init__(self, sample: np.ndarray, top: float, lists: int):
        x, rng = _augment(sample, top), np.random.default_rng(11)
        pieces = [np.arange(len(x))]
        while len(pieces) < lists:
            pieces.sort(key=len)
            piece = pieces.pop()
            if len(piece) < 2:
                pieces.append(piece)
                break
            y = x[piece] - x[piece].mean(axis=0)
            d = rng.normal(size=y.shape[1])
            for _ in range(12):  # the direction in which the piece is longest
                d = y.T @ (y @ d)
                d /= np.linalg.norm(d) + 1e-300
            order = np.argsort(y @ d, kind="stable")
            half = len(piece) // 2
            pieces += [piece[order[:half]], piece[order[half:]]]
        self.top, self.points = top, np.stack([x[p].mean(axis=0) for p in pieces])
        n = len(self.points)
        norms = (self.points ** 2).sum(axis=1)
        links = []
        for a in range(0, n, 1024):
            d = norms[None, :] - 2 * self.points[a:a + 1024] @ self.points.T
            d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
            near = np.argsort(d, axis=1, kind="stable")[:, :min(DEGREE, max(1, n - 1))]
            links.append(near)
        far = rng.integers(0, n, (n, 4))  # a few long links keep the graph in one piece
        self.links = np.concatenate([np.concatenate(links), far], axis=1)
        self.entry = rng.permutation(n)[:BEAM]
        self.walks = True

    def _distance(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(((x[:, None, :] - self.points[at]) ** 2).sum(axis=2), 0))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best lists found for each augmented vector, nearest first, and their distances."""
        width = min(BEAM, len(self.points))
        beam = np.tile(self.entry[:width], (len(x), 1))
        dist, done = self._distance(x, beam), np.zeros(beam.shape, dtype=bool)
        for _ in range(STEPS):
            open_ = np.where(done, np.inf, dist)
            pick = open_.argmin(axis=1)
            rows = np.arange(len(x))
            if not np.isfinite(open_[rows, pick]).any():
                break
            done[rows, pick] = True
            new = self.links[beam[rows, pick]]
            ids = np.concatenate([beam, new], axis=1)
            d = np.concatenate([dist, self._distance(x, new)], axis=1)
            flag = np.concatenate([done, np.zeros(new.shape, dtype=bool)], axis=1)
            order = np.lexsort((~flag, ids), axis=1)  # of equal lists the one that is done stays
            ids, d, flag = (np.take_along_axis(a, order, 1) for a in (ids, d, flag))
            d[:, 1:][ids[:, 1:] == ids[:, :-1]] = np.inf
            flag |= ~np.isfinite(d)
            order = np.argsort(d, axis=1, kind="stable")[:, :width]
            beam, dist, done = (np.take_along_axis(a, order, 1) for a in (ids, d, flag))
        return beam, dist

    def every(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All lists for each augmented vector, nearest first, and their distances."""
        d = (x ** 2).sum(axis=1)[:, None] + (self.points ** 2).sum(axis=1)[None, :] - 2 * x @ self.points.T
        order = np.argsort(d, axis=1, kind="stable")
        return order, np.sqrt(np.maximum(np.take_along_axis(d, order, 1), 0))

    def probes(self, x: np.ndarray, ratio: float, own: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of all lists within ``ratio`` of a query's nearest one, and of farther ones until ``least`` vectors are met.

        ``own`` has the number of vectors whose nearest list each one is. Where the walk's beam is too
        short for that, all lists are looked at.
        """
        def chosen(lists: np.ndarray, dist: np.ndarray) -> np.ndarray:
            seen = np.isfinite(dist)
            met = np.cumsum(np.where(seen, own[lists], 0), axis=1)
            before = np.column_stack([np.zeros(len(met), dtype=met.dtype), met[:, :-1]])
            return seen & ((dist <= dist[:, :1] * ratio + 1e-9) | (before < least))

        lists, dist = self.nearest(x) if self.walks else self.every(x)
        good = chosen(lists, dist)
        if not self.walks:
            row, col = np.nonzero(good)
            return row, lists[row, col]
        short = good[:, -1] | (np.where(good, own[lists], 0).sum(axis=1) < least)
        row, col = np.nonzero(good & ~short[:, None])
        rows, found = [row], [lists[row, col]]
        again = np.flatnonzero(short)
        for part in np.array_split(again, len(again) // 128 + 1):
            lists, dist = self.every(x[part])
            row, col = np.nonzero(chosen(lists, dist))
            rows.append(part[row])
            found.append(lists[row, col])
        return np.concatenate(rows), np.concatenate(found)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _assign(batches: Iterator[pa.RecordBatch], centroids: Centroids, ratio: float, most: int, scale: float) -> Iterator[pa.RecordBatch]:
    """(vh, v, list, own) for the lists within ``ratio`` of the nearest one, at most ``most``; ``own`` marks the nearest."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            b = batch.slice(start, 512)
            x = _augment(_matrix(b.column("v")) / scale, centroids.top)
            lists, dist = centroids.nearest(x)
            good = (dist <= dist[:, :1] * ratio + 1e-9) & np.isfinite(dist) & (np.arange(dist.shape[1]) < most)
            row, col = np.nonzero(good)
            yield pa.RecordBatch.from_arrays(
                [b.column("vh").take(pa.array(row)), b.column("v").take(pa.array(row)), pa.array(lists[row, col].astype(np.int64)), pa.array(col == 0)],
                ["vh", "v", "list", "own"])


def _probe(batches: Iterator[pa.RecordBatch], centroids: Centroids, ratio: float, own: np.ndarray, least: int, scale: float) -> Iterator[pa.RecordBatch]:
    """(vh, v, list, near) for the lists that a query searches; ``near`` marks its ``NEAR`` nearest."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            b = batch.slice(start, 512)
            row, lists = centroids.probes(_augment_queries(_matrix(b.column("v")) / scale, centroids.top), ratio, own, least)
            new = np.flatnonzero(np.append(True, row[1:] != row[:-1]))  # a query's lists stand together, nearest first
            near = np.arange(len(row)) - np.repeat(new, np.diff(np.append(new, len(row)))) < NEAR
            for a in range(0, len(row), 10_000):
                at = pa.array(row[a:a + 10_000])
                yield pa.RecordBatch.from_arrays(
                    [b.column("vh").take(at), b.column("v").take(at), pa.array(lists[a:a + 10_000].astype(np.int64)), pa.array(near[a:a + 10_000])],
                    ["vh", "v", "list", "near"])


def _tile_search(queries: pa.Table, vectors: pa.Table, k: int) -> pa.Table:
    """The best k vectors of a tile for each of its queries, those that reach its ``bound`` if it has one; scores are exact and
    do not depend on the tile."""
    q, v = _matrix(queries.column("v").combine_chunks()), _matrix(vectors.column("v").combine_chunks())
    qh, vh = np.asarray(queries.column("vh")), np.asarray(vectors.column("vh"))
    if not len(q) or not len(v):
        return pa.table({"qh": pa.array([], pa.int64()), "vh": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    rough = q @ v.T
    keep = min(len(v), k)
    worst = -np.partition(-rough, keep - 1, axis=1)[:, keep - 1]
    bound = queries.column("bound").to_numpy()  # NaN for none
    worst = np.fmax(worst, np.where(np.isfinite(bound), bound, np.nan))
    worst = np.where(np.isfinite(worst), worst - 1e-9 * (1 + np.abs(worst)), worst)
    row, col = np.nonzero(rough >= worst[:, None])  # and all that may tie
    return pa.table({"qh": qh[row], "vh": vh[col], "score": (q[row] * v[col]).sum(axis=1)})


def _nearest_of(batches: Iterator[pa.RecordBatch], asked: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """(q, v, score): the k nearest to each asked vector among a task's."""
    held: pa.Table | None = None
    for batch in batches:
        v = _matrix(batch.column("v"))
        with np.errstate(over="ignore", invalid="ignore"):
            score = np.nan_to_num(v @ asked.T, nan=-np.inf, posinf=np.finfo(np.float64).max)
        q = np.tile(np.arange(len(asked)), len(v))
        row = np.repeat(np.arange(len(v)), len(asked))
        if len(v) > k:
            least = -np.partition(-score, k - 1, axis=0)[k - 1]
            good = (score >= least).ravel()
            q, row = q[good], row[good]
        new = pa.table({"q": q, "v": batch.column("v").take(pa.array(row)), "score": score[row, q]})
        held = new if held is None else pa.concat_tables([held, new])
        order = np.lexsort((-held.column("score").to_numpy(), held.column("q").to_numpy()))
        q = held.column("q").to_numpy()[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        held = held.take(pa.array(order[place < k])).combine_chunks()
    if held is not None:
        yield from held.to_batches()


def fit_ratio(vectors: DataFrame, asked: np.ndarray, centroids: Centroids, scale: float, k: int, recall: float = FIT_RECALL) -> float:
    """The distance ratio that takes in a list of this share of the true k nearest of the asked vectors."""
    near = vectors.select("v").mapInArrow(lambda it: _nearest_of(it, asked, k), "q bigint, v array<double>, score double")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
    near = near.withColumn("_r", place).filter(F.col("_r") <= k).select("q", "v").toArrow()  # k rows an asked vector
    lists, dist = centroids.every(_augment(_matrix(near.column("v").combine_chunks()) / scale, centroids.top))
    holds = (dist <= dist[:, :1] * COPY_RATIO + 1e-9) & (np.arange(dist.shape[1]) < COPIES)
    to_lists = np.empty((len(asked), len(centroids.points)))
    order, d = centroids.every(_augment_queries(asked / scale, centroids.top))
    np.put_along_axis(to_lists, order, d, axis=1)
    q = near.column("q").to_numpy()
    need = np.where(holds, np.take_along_axis(to_lists[q], lists, axis=1), np.inf).min(axis=1)
    ratio = float(np.quantile((need + 1e-9) / (d[q, 0] + 1e-9), recall, method="higher"))
    inside = int((d <= d[:, :1] * ratio + 1e-9).sum())
    row, _ = centroids.probes(_augment_queries(asked / scale, centroids.top), ratio, np.ones(len(centroids.points), dtype=np.int64), 0)
    centroids.walks = len(row) >= WALK_RECALL * inside
    return ratio


def search(embeddings: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the k nearest found of each query, by inner product in double precision.

    ``queries`` are rows like those of ``embeddings``. A query's own id is no candidate; equal scores go
    to smaller ids. Distances are taken of vectors divided by the largest component. Vectors that are null, zero, of another length than most, or hold null or
    non-finite components take no part, nor do rows without an id; repeated rows count once. Equal vectors
    are one entry of the index with their k + 1 smallest ids, all that an answer can need, so copies
    of a vector cost nothing. With fewer candidates than k all found are returned; an empty table
    gives no rows. Lists and queries of any number meet in tiles of bounded size.
    """
    spark = embeddings.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        v = F.col(vector_col).cast("array<double>")
        finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        rows = df.select(F.col(id_col).alias("id"), v.alias("v")).filter(
            F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
        return rows.withColumn("vh", F.xxhash64("v"))

    vectors, asked = clean(embeddings), clean(queries)
    lengths = vectors.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return vectors.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias(id_col), F.lit(0.0).alias("score")).limit(0)
    vectors, asked = (df.filter(F.size("v") == lengths["n"]) for df in (vectors, asked))

    def smallest(df: DataFrame, part: list, n: int) -> DataFrame:
        return df.withColumn("_r", F.row_number().over(Window.partitionBy(*part).orderBy("id"))).filter(F.col("_r") <= n).drop("_r")

    ids = vectors.select("vh", "id").distinct()
    ids = materialize(smallest(smallest(ids, ["vh", F.pmod(F.xxhash64("id"), F.lit(64))], k + 1), ["vh"], k + 1), "ids")
    distinct = materialize(vectors.select("vh", "v").dropDuplicates(["vh"]), "vectors")
    query_ids = materialize(asked.select("vh", "id").distinct(), "queries")
    n = distinct.count()
    scale = distinct.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))).first()[0]
    top = distinct.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / scale) * (x / scale)))).first()[0]
    part = distinct.filter(F.pmod(F.xxhash64("vh"), F.lit(1_000_000)) < int(min(1.0, SAMPLE / n) * 1_000_000)).select("v").toArrow()
    sample = _matrix(part.column("v").combine_chunks())
    if not len(sample):
        sample = _matrix(distinct.select("v").limit(1).toArrow().column("v").combine_chunks())
    centroids = Centroids(sample / scale, float(top), int(min(MAX_LISTS, max(1, n // LIST_LENGTH))))
    asked = materialize(asked.select("vh", "v").dropDuplicates(["vh"]), "asked")
    m = asked.count()
    some = asked.filter(F.pmod(F.xxhash64("vh", F.lit(1)), F.lit(1_000_000)) <= int(min(1.0, FIT_QUERIES / max(m, 1)) * 1_000_000)).select("v").toArrow()
    ratio = fit_ratio(distinct, _matrix(some.column("v").combine_chunks()), centroids, scale, k + 1) if len(some) else float("inf")
    shared = spark.sparkContext.broadcast(centroids)
    schema = "vh bigint, v array<double>, list bigint"
    postings = materialize(distinct.mapInArrow(lambda it: _assign(it, shared.value, COPY_RATIO, COPIES, scale), f"{schema}, own boolean"), "postings")
    own = np.zeros(len(shared.value.points), dtype=np.int64)  # each vector is one of a single list's own
    for r in postings.filter("own").groupBy("list").count().collect():
        own[r["list"]] = r["count"]
    met = spark.sparkContext.broadcast(own)
    probes = asked.mapInArrow(lambda it: _probe(it, shared.value, ratio, met.value, k + 1, scale), f"{schema}, near boolean")
    probes = materialize(probes, "probes")

    def tiles(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias(name))

    home = lambda n: F.pmod(F.xxhash64("vh"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = ["list", "vtile", "qtile"]

    def searched(some: DataFrame) -> DataFrame:
        """(qh, vh, score) of the lists of ``some`` probes with a bound; a vector in several lists has the same score in each."""
        sizes = materialize(tiles(postings, "vt").join(tiles(some, "qt"), "list"), "sizes")
        left = some.join(sizes, "list").select("list", "vh", "v", "bound", each("vt").alias("vtile"), home("qt").alias("qtile"))
        right = postings.join(sizes, "list").select("list", "vh", "v", home("vt").alias("vtile"), each("qt").alias("qtile"))
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
            lambda a, b: _tile_search(a, b, k + 1), "qh bigint, vh bigint, score double")
        return found.groupBy("qh", "vh").agg(F.max("score").alias("score"))

    def best_of(found: DataFrame) -> DataFrame:
        """The k + 1 best and all that tie with the last of them."""
        return found.withColumn("_r", F.rank().over(Window.partitionBy("qh").orderBy(F.desc("score")))).filter(F.col("_r") <= k + 1)

    first = materialize(best_of(searched(probes.filter("near").withColumn("bound", F.lit(None).cast("double")))).drop("_r"), "first")
    # the last of k + 1 found so far: nothing below it is an answer, so rows of farther lists do not grow with their number
    bounds = first.groupBy(F.col("qh").alias("vh")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("bound")).filter(F.col("n") > k).drop("n")
    rest = searched(probes.filter("not near").join(bounds, "vh", "left"))
    best = best_of(first.unionByName(rest).groupBy("qh", "vh").agg(F.max("score").alias("score")))
    answers = best.join(ids, "vh").select("qh", "id", "score")
    answers = answers.withColumn("_r", F.row_number().over(Window.partitionBy("qh").orderBy(F.desc("score"), "id"))).filter(F.col("_r") <= k + 1)
    rows = query_ids.select(F.col("id").alias("query_id"), F.col("vh").alias("qh")).join(answers.drop("_r"), "qh").filter(F.col("id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id", "qh").orderBy(F.desc("score"), "id"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
