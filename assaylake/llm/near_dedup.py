"""Near-duplicates: improved consistent weighted sampling of TF-IDF shingles, bands, exact verification.

A document is the weighted set of its runs of five words; a weight is the run's count times an
idf between 1 (in every document) and 1.5 (in at most one document of a thousand). Its signature has
48 consistent weighted samples in 12 bands of 4, so two texts of similarity 0.8 meet in some band
with a probability of 0.998, those of 0.9 all but surely. Equal texts are one text with copies;
texts that meet are compared by their exact weighted Jaccard similarity, and links of 0.8 or more
are joined into classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.llm.components import components
from assaylake.llm.words import blocks, mix, row_counts, shingles, words_of
from assaylake.session import materialize

SHINGLE = 5
BANDS, ROWS = 12, 4
SIMILARITY = 0.8
RARE_SHARE = 1e-3  # shingles in fewer documents than this share all have the largest idf
IDF_RANGE = 0.5  # how far the idf of a rare shingle exceeds that of one in every document
SEGMENT = 3_000_000  # shingles counted at once in a task
SEGMENT_ROWS = 6_000  # documents of a task, in the mean, at least: below 2,000 every shingle would be locally frequent
SMALL_BUCKET = 8  # a bucket's texts up to this number go to the pair table
HUBS, TILE = 64, 256  # in one task, of a bucket larger than both: texts that all others are compared with, and others
KEY_BUCKETS = 1 << 20
_DRAWS = 1 << 16
_SLACK = 1e-9
LINK = 1 - SIMILARITY + _SLACK  # largest distance of a link


@dataclass
class Idf:
    """Weights of the frequent shingles (sorted hashes); any other shingle is rare."""

    hashes: np.ndarray
    weights: np.ndarray
    rare: float = 1 + IDF_RANGE

    def __post_init__(self):
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[self.hashes >> np.uint64(44)] = True

    def known(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which values are frequent, and where in the table."""
        likely = np.flatnonzero(self.maybe[values >> np.uint64(44)])
        if not len(likely):
            return likely, likely
        at = np.minimum(np.searchsorted(self.hashes, values[likely]), len(self.hashes) - 1)
        hit = self.hashes[at] == values[likely]
        return likely[hit], at[hit]

    def weigh(self, values: np.ndarray, times: np.ndarray) -> np.ndarray:
        weight = np.full(len(values), self.rare)
        which, at = self.known(values)
        weight[which] = self.weights[at]
        return weight * times


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


def _locally_frequent(batches: Iterator[pa.RecordBatch], share: float) -> Iterator[pa.RecordBatch]:
    """(shingle, documents, rows of the segment) for shingles in at least ``share`` of a segment's documents."""
    held: list[np.ndarray] = []
    rows = 0

    def flush() -> pa.RecordBatch:
        values, n = np.unique(np.concatenate(held), return_counts=True)
        often = n >= share * rows
        return _batch(shingle=values[often].view(np.int64), n=n[often].astype(np.int64), rows=np.full(int(often.sum()), rows, np.int64))

    for b in blocks(batches):
        held.append(row_counts(*shingles(words_of(b.column("text")), SHINGLE))[0])
        rows += b.num_rows
        if sum(map(len, held)) >= SEGMENT:
            yield flush()
            held, rows = [], 0
    if held:
        yield flush()


def fit_idf(texts: DataFrame) -> Idf:
    """Document frequencies over all rows, exact for every shingle in at least ``RARE_SHARE`` of them.

    A shingle that frequent is half as frequent in some segment of some task, so two passes find and
    count all of them, and there are at most (shingles per document) / (RARE_SHARE / 2) candidates,
    however large the table: few enough to send to the tasks.
    """
    spark, n = texts.sparkSession, texts.count()
    least, half = max(1.0, RARE_SHARE * n), RARE_SHARE / 2
    joined = texts.coalesce(max(1, n // SEGMENT_ROWS))  # small files together; larger splits stay as they are
    local = joined.mapInArrow(lambda it: _locally_frequent(it, half), "shingle bigint, n bigint, rows bigint")
    sums = local.groupBy("shingle").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"))
    found = sums.filter(F.col("n") + half * (n - F.col("rows")) >= least).select("shingle").toArrow()
    candidates = np.sort(np.asarray(found.column("shingle")).view(np.uint64))
    shared = spark.sparkContext.broadcast(Idf(candidates, np.ones(len(candidates))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        total = np.zeros(len(table.hashes), dtype=np.int64)
        for b in blocks(batches):
            total += np.bincount(table.known(row_counts(*shingles(words_of(b.column("text")), SHINGLE))[0])[1], minlength=len(total))
        some = np.flatnonzero(total)
        yield _batch(shingle=table.hashes[some].view(np.int64), n=total[some])

    exact = texts.mapInArrow(count, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    kept = exact.filter(F.col("n") > least).toArrow()
    hashes, df = np.asarray(kept.column("shingle")).view(np.uint64), np.asarray(kept.column("n")).astype(float)
    order = np.argsort(hashes)
    weights = 1 + IDF_RANGE * np.log(n / df[order]) / np.log(1 / RARE_SHARE)
    return Idf(hashes[order], np.minimum(weights, 1 + IDF_RANGE))


class Sampler:
    """Consistent weighted samples: for each function the least of ln a over a row's shingles.

    r, c ~ Gamma(2, 1) and beta ~ U(0, 1) of a shingle come from tables that its hash points into;
    t = floor(ln S / r + beta), ln a = ln c - r (t - beta) - r. As a falls when t rises, (shingle, ln a)
    names the sample (shingle, t), and one integer holds both: the order of ln a, then bits of the hash.
    """

    def __init__(self, idf: Idf):
        self.idf, self.draws = idf, []
        rng = np.random.default_rng(7)
        for _ in range(BANDS * ROWS):
            r, log_c, beta = rng.gamma(2, 1, _DRAWS), np.log(rng.gamma(2, 1, _DRAWS)), rng.random(_DRAWS)
            odd = rng.integers(0, 1 << 62, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            self.draws.append((odd, r, log_c, beta, self._order(self._log_a(np.log(idf.rare), r, log_c, beta))))

    @staticmethod
    def _log_a(log_s, r: np.ndarray, log_c: np.ndarray, beta: np.ndarray) -> np.ndarray:
        return log_c - r * (np.floor(log_s / r + beta) - beta + 1)

    @staticmethod
    def _order(x: np.ndarray) -> np.ndarray:
        """The values' order in the upper half of an integer."""
        bits = x.astype(np.float32).view(np.uint32)
        bits = np.where(bits >> 31 == 1, ~bits, bits | np.uint32(1 << 31))
        return bits.astype(np.uint64) << np.uint64(32)

    def bands(self, values: np.ndarray, weights: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Band hashes (one column each) of the sets that begin at ``first``."""
        common = weights == self.idf.rare
        other = np.flatnonzero(~common)
        log_s, low = np.log(weights[other]), values & np.uint64(0xFFFFFFFF)
        out = np.zeros((len(first), BANDS), dtype=np.uint64)
        for i, (odd, r, log_c, beta, rare) in enumerate(self.draws):
            at = (values * odd) >> np.uint64(48)
            key = rare[at]
            if len(other):
                t = at[other]
                key[other] = self._order(self._log_a(log_s, r[t], log_c[t], beta[t]))
            key |= low
            least = np.minimum.reduceat(key, first)
            b = i // ROWS
            out[:, b] = mix(out[:, b] * np.uint64(0xD6E8FEB86659FD93) + least + np.uint64(b))
        return out


def _sign(batches: Iterator[pa.RecordBatch], sampler: Sampler) -> Iterator[pa.RecordBatch]:
    for b in blocks(batches):
        values, rows, times = row_counts(*shingles(words_of(b.column("text")), SHINGLE))
        which, first = np.unique(rows, return_index=True)
        lists: list = [None] * b.num_rows
        if len(which):
            for r, band in zip(which, sampler.bands(values, sampler.idf.weigh(values, times), first).view(np.int64), strict=True):
                lists[r] = band
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("k"), pa.array(lists, pa.list_(pa.int64()))], ["id", "k", "bands"])


def _distances(batches: Iterator[pa.RecordBatch], idf: Idf) -> Iterator[pa.RecordBatch]:
    """1 - weighted Jaccard similarity of the texts of each pair."""
    for b in blocks(batches, "ta"):
        sides = []
        for name in ("ta", "tb"):
            v, r, n = row_counts(*shingles(words_of(b.column(name)), SHINGLE))
            sides.append((v, r, idf.weigh(v, n)))
        v, r, s = (np.concatenate(x) for x in zip(*sides, strict=True))
        order = np.argsort(v, kind="stable")
        order = order[np.argsort(r[order].astype(np.uint16), kind="stable")]
        v, r, s = v[order], r[order], s[order]
        both = np.flatnonzero((v[1:] == v[:-1]) & (r[1:] == r[:-1]))
        shared = np.bincount(r[both], np.minimum(s[both], s[both + 1]), b.num_rows)
        total = np.bincount(r, s, b.num_rows) - shared
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(1 - shared / np.maximum(total, 1e-12))], ["a", "b", "d"])


class _Sets:
    """The weighted sets of a task's texts, and distances from one of them to all."""

    def __init__(self, texts: pa.ChunkedArray | pa.Array, idf: Idf):
        self.n = len(texts)
        self.v, self.r, times = row_counts(*shingles(words_of(texts), SHINGLE))
        self.s = idf.weigh(self.v, times)
        self.total = np.bincount(self.r, self.s, self.n)
        self.first = np.searchsorted(self.r, np.arange(self.n + 1))

    def distances(self, h: int) -> np.ndarray:
        """1 - weighted Jaccard similarity of text ``h`` and each text; infinite to itself."""
        hv, hs = self.v[self.first[h]:self.first[h + 1]], self.s[self.first[h]:self.first[h + 1]]
        at = np.minimum(np.searchsorted(hv, self.v), len(hv) - 1)
        hit = np.flatnonzero(hv[at] == self.v)
        shared = np.bincount(self.r[hit], np.minimum(hs[at[hit]], self.s[hit]), self.n)
        d = 1 - shared / (self.total + self.total[h] - shared)
        d[h] = np.inf
        return d


def _whole_links(bucket: pa.Table, idf: Idf) -> pa.Table:
    """(a, b) links that join the texts of a bucket of bounded size into the classes of all its links."""
    bucket = bucket.combine_chunks()
    keys, sets = bucket.column("k").to_pylist(), _Sets(bucket.column("text"), idf)
    of, found = np.arange(sets.n), []
    for h in range(sets.n):
        if (of == of[h]).all():
            break
        near = np.flatnonzero((sets.distances(h) <= LINK) & (of != of[h]))
        classes, one = np.unique(of[near], return_index=True)
        found += [(keys[h], keys[x]) for x in near[one]]
        of[np.isin(of, classes)] = of[h]
    return pa.table({c: pa.array([f[i] for f in found], pa.binary()) for i, c in enumerate("ab")})


def _tile_links(tile: pa.Table, idf: Idf, turn: int | None = None) -> pa.Table:
    """Rows of a tile, of three kinds.

    (bucket, hub, k, d): each text's nearest linked hub, and links that join its texts into the classes of all their links
    with hubs. Where ``turn`` tells the round, also one row (…, k, far) for each text with hubs of another such class
    up to twice the distance of a link from it, ``far`` holding their numbers and distances; and (…, hub, i)
    for each hub, if there is such a text. Rows of hubs as texts are given in tile 0 only.
    """
    tile = tile.combine_chunks()
    keys, hub, sets = tile.column("k").to_pylist(), np.asarray(tile.column("hub")), _Sets(tile.column("text"), idf)
    hubs, of, found = np.flatnonzero(hub), np.arange(sets.n), set()
    d = np.full((len(hubs), sets.n), np.inf)
    for i, h in enumerate(hubs):
        d[i] = sets.distances(h)
        near = np.flatnonzero((d[i] <= LINK) & (of != of[h]))
        classes, one = np.unique(of[near], return_index=True)
        found |= {(i, x) for x in near[one]}
        of[np.isin(of, classes)] = of[h]
    far = np.zeros((sets.n, 0), dtype=bool)
    if len(hubs):
        wanted = ~hub | (tile.column("tile")[0].as_py() == 0)
        nearest = d.argmin(axis=0)
        found |= {(nearest[x], x) for x in np.flatnonzero((d.min(axis=0) <= LINK) & wanted)}
        far = ((d > LINK) & (d <= 2 * LINK) & (of[hubs][:, None] != of) & wanted).T
    some = np.flatnonzero(far.any(axis=1)) if turn is not None else np.zeros(0, dtype=np.int64)
    x, i = np.nonzero(far[some])
    offsets = np.concatenate([[0] * (len(found) + 1), np.cumsum(np.bincount(x, minlength=len(some)))]).astype(np.int32)
    named = hubs if len(some) else []
    offsets = np.append(offsets, np.repeat(offsets[-1], len(named)).astype(np.int32))
    n = len(found) + len(some) + len(named)
    gap, other = [None] * len(found), [None] * (n - len(found))
    place = {c: pa.array([tile.column(c)[0].as_py() if c in tile.column_names else None] * n, pa.int64()) for c in ("bucket", "chunk", "tile")}
    return pa.table({
        **place, "turn": pa.array([turn] * n, pa.int32()),
        "hub": pa.array([keys[hubs[h]] for h, _ in found] + [None] * len(some) + [keys[h] for h in named], pa.binary()),
        "k": pa.array([keys[t] for _, t in found] + [keys[t] for t in some] + [None] * len(named), pa.binary()),
        "d": pa.array([d[h, t] for h, t in found] + other, pa.float64()),
        "far": pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(d.T[some][x, i])], names=["i", "d"])),
        "i": pa.array(gap + [None] * len(some) + list(range(len(named))), pa.int32())})


def _in_round(shared, turn: int):
    return lambda tile: _tile_links(tile, shared.value, turn)


_PLACE = ("bucket", "chunk", "tile", "turn")
_TILE = "bucket bigint, chunk bigint, tile bigint, turn int, hub binary, k binary, d double, far array<struct<i:int,d:double>>, i int"


def _deal(of: Column | str, n: Column | str) -> Column:
    return F.pmod(F.xxhash64(of), F.col(n) if isinstance(n, str) else n)


def _every(n: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))


def _across_classes(tiles: DataFrame, roots: DataFrame, texts: DataFrame, shared) -> DataFrame:
    """(a, b) links between two texts of a crowded bucket that no hub compared, where their classes are not one already.

    1 - weighted Jaccard is a metric: if x is linked to its nearest hub at d(x) and y to x, then y is
    at most d(x) + 0.2 from that hub, so ``tiles`` has the row of y. Only such y of another class
    than the hub's are compared with the hub's texts, 64 of them with 256 texts in a task.
    """
    of = lambda c: roots.select(F.col("a").alias(c), F.col("b").alias("root"))
    own = materialize(tiles.filter(F.col("d") <= LINK).groupBy("bucket", "k").agg(F.min(F.struct("d", "hub")).alias("n")).select("bucket", "n.hub", "k", "n.d"), "own")
    reach = own.groupBy("bucket", "hub").agg(F.max("d").alias("most"))
    # a tile's hubs, 64 at most, with their classes and the farthest of their texts, meet its texts as one array
    hubs = tiles.filter("i IS NOT NULL").select(*_PLACE, "hub", "i").join(reach, ["bucket", "hub"]).join(of("hub"), "hub", "left")
    hubs = hubs.groupBy(*_PLACE).agg(F.collect_list(F.struct("i", "hub", F.coalesce("root", "hub").alias("root"), "most")).alias("hubs"))
    far = tiles.filter(F.size("far") > 0).select(*_PLACE, "k", "far").join(of("k"), "k", "left").withColumn("root", F.coalesce("root", "k"))
    met = far.join(hubs, list(_PLACE))
    apart = F.filter("hubs", lambda h: (h["root"] != F.col("root")) & F.exists("far", lambda x: (x["i"] == h["i"]) & (x["d"] <= h["most"] + LINK)))
    met = met.withColumn("apart", apart).filter(F.size("apart") > 0).select("bucket", "k", "far", F.explode_outer("apart").alias("h"))
    near = F.filter("far", lambda x: x["i"] == F.col("h.i"))
    others = materialize(met.select("bucket", F.col("h.hub").alias("hub"), "k", F.get(near, F.lit(0))["d"].alias("d")), "others")
    own = materialize(own.join(others.select("bucket", "hub").distinct(), ["bucket", "hub"], "left_semi"), "own")
    ends = others.groupBy("bucket", "hub").agg(F.min("d").alias("least"), F.count(F.lit(1)).alias("ny"))
    own = own.join(ends, ["bucket", "hub"]).filter(F.col("d") >= F.col("least") - LINK)
    sizes = materialize(own.groupBy("bucket", "hub").agg(
        F.ceil(F.max("ny") / HUBS).alias("chunks"), F.ceil(F.count(F.lit(1)) / TILE).alias("tiles")), "sizes")
    x = own.select("bucket", "hub", "k").join(sizes, ["bucket", "hub"]).select(
        "bucket", F.col("hub").alias("of"), "k", _deal("k", "tiles").alias("tile"), _every("chunks").alias("chunk"), F.lit(False).alias("hub"))
    y = others.select("bucket", "hub", "k").join(sizes, ["bucket", "hub"]).select(
        "bucket", F.col("hub").alias("of"), "k", _every("tiles").alias("tile"), _deal("k", "chunks").alias("chunk"), F.lit(True).alias("hub"))
    out = x.unionByName(y).join(texts, "k").groupBy("bucket", "of", "chunk", "tile").applyInArrow(lambda t: _tile_links(t, shared.value), _TILE)
    return out.filter(F.col("d") <= LINK).select(F.col("hub").alias("a"), F.col("k").alias("b"))


def near_duplicate_links(keyed: DataFrame, signed: DataFrame, idf: Idf) -> DataFrame:
    """(a, b): each text that is linked to another one, and the text that names its class.

    A link is a pair of different texts of similarity 0.8 or more that share a band; a class is what links
    join. ``keyed`` has (k, text) of every document, ``signed`` (k, bands) of every distinct text. Texts of
    buckets of up to 8 are all compared, a pair once whatever its buckets; those of buckets of up to 320
    in one task a bucket, without the pairs whose classes are one already. Of a larger bucket about 64
    texts, drawn by a hash, are its hubs; all are dealt into tiles of about 256, and each tile is compared with
    the hubs in one task. Texts that no hub is linked to go on to a next round among themselves with
    twice as many hubs, 64 in a task, so the rounds are as many as the logarithm of the largest bucket. In the
    end texts of different hubs are compared wherever they can be linked and are not yet in one class.
    """
    spark = keyed.sparkSession
    live = materialize(signed.select("k", F.explode("bands").alias("bucket")), "bands")
    shared = spark.sparkContext.broadcast(idf)
    texts, links, tiled, hubs = None, [], [], HUBS
    while True:
        sizes = live.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        members = materialize(live.join(sizes, "bucket"), "members")
        if not members.take(1):
            break
        if texts is None:
            keys = materialize(members.select("k").distinct(), "keys")
            at = F.pmod(F.xxhash64("k"), F.lit(KEY_BUCKETS)).alias("_at")  # at most 2^20 numbers go to the tasks
            near = keyed.withColumn("_at", at).join(F.broadcast(keys.select(at).distinct()), "_at", "left_semi").select("k", "text")
            texts = materialize(near.dropDuplicates(["k"]).join(keys.hint("merge"), "k", "left_semi"), "texts")  # copies are one in the map tasks
            small = members.filter(F.col("n") <= SMALL_BUCKET)
            pairs = small.alias("x").join(small.alias("y"), (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.k") < F.col("y.k")))
            pairs = pairs.select(F.col("x.k").alias("a"), F.col("y.k").alias("b")).distinct()
            first, second = (texts.select(F.col("k").alias(c), F.col("text").alias(f"t{c}")) for c in "ab")
            rows = pairs.join(first, "a").join(second, "b").select("a", "b", "ta", "tb")
            found = rows.mapInArrow(lambda it: _distances(it, shared.value), "a binary, b binary, d double")
            links.append(materialize(found.filter(F.col("d") <= LINK).select("a", "b"), "links"))
            members = members.filter(F.col("n") > SMALL_BUCKET)
        whole = members.filter(F.col("n") <= HUBS + TILE).join(texts, "k").select("bucket", "k", "text")
        links.append(materialize(whole.groupBy("bucket").applyInArrow(lambda t: _whole_links(t, shared.value), "a binary, b binary"), "links"))

        large = members.filter(F.col("n") > HUBS + TILE).withColumn("step", F.ceil(F.col("n") / hubs)).select(
            "bucket", "k", (F.pmod(F.xxhash64("k", "bucket", F.lit(hubs)), F.col("step")) == 0).alias("hub"),
            F.ceil(F.col("n") / F.col("step") / HUBS).alias("chunks"), F.ceil(F.col("n") / TILE).alias("tiles"))
        if not large.take(1):
            break
        own = F.when(F.col("hub"), _deal("k", "chunks"))
        others = large.withColumn("own", own).select("bucket", "k", "own", _deal("k", "tiles").alias("tile"), _every("chunks").alias("chunk"))
        others = others.filter(~F.col("own").eqNullSafe(F.col("chunk"))).select("bucket", "k", "chunk", "tile", F.lit(False).alias("hub"))
        every = large.filter("hub").select("bucket", "k", _deal("k", "chunks").alias("chunk"), _every("tiles").alias("tile"), "hub")
        dealt = others.unionByName(every).join(texts, "k")
        out = dealt.groupBy("bucket", "chunk", "tile").applyInArrow(_in_round(shared, len(tiled)), _TILE)
        tiled.append(materialize(out, "tiles"))
        near = tiled[-1].filter(F.col("d") <= LINK)
        links.append(near.select(F.col("hub").alias("a"), F.col("k").alias("b")))
        live = materialize(large.filter("NOT hub").select("k", "bucket").join(near.select("k", "bucket"), ["k", "bucket"], "left_anti"), "bands")
        hubs *= 2
    if not links:
        return live.select(F.col("k").alias("a"), F.col("k").alias("b")).limit(0)
    roots = components(reduce(DataFrame.union, links)).select(F.col("node").alias("a"), F.col("root").alias("b"))
    if not tiled:
        return roots
    return _joined(roots, materialize(_across_classes(reduce(DataFrame.union, tiled), roots, texts, shared), "across"))


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(a, b) of ``roots`` after ``links`` joined some of their classes, and texts that were in none."""
    up = lambda c: roots.select(F.col("a").alias(c), F.col("b").alias(f"{c}_up"))
    above = links.join(up("a"), "a", "left").join(up("b"), "b", "left").select(F.coalesce("a_up", "a").alias("a"), F.coalesce("b_up", "b").alias("b"))
    top = components(above)
    raised = roots.join(top.withColumnRenamed("node", "b"), "b", "left").select("a", F.coalesce("root", "b").alias("b"))
    alone = top.join(roots.select(F.col("a").alias("node")), "node", "left_anti").select(F.col("node").alias("a"), F.col("root").alias("b"))
    return raised.unionByName(alone)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, k, class_id, class_key, class_size) per document: ``class_id`` is the smallest id of its class, ``k`` the text's key.

    Equal texts are of one class, and texts of similarity 0.8 or more, directly or through others. Texts
    without words, null ones too, have no shingles: each such document is a class of its own. A
    document without an id takes part; it names a class only if no member has an id (null then).
    Texts of fewer than five words are one shingle. Repeated rows are copies; an empty table gives
    no rows; other columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    idf = fit_idf(keyed.select("text"))
    shared = spark.sparkContext.broadcast(idf)
    id_type = docs.schema[id_col].dataType.simpleString()
    signed = materialize(
        keyed.mapInArrow(lambda it: _sign(it, Sampler(shared.value)), f"id {id_type}, k binary, bands array<bigint>"), "signatures")
    worded = signed.filter(F.col("bands").isNotNull())
    distinct = materialize(worded.groupBy("k").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands")), "distinct")
    links = materialize(near_duplicate_links(keyed.select("k", "text"), distinct.select("k", "bands"), idf), "links")
    roots = links.withColumnsRenamed({"a": "k", "b": "root"})
    named = materialize(distinct.select("k", "id", "n").join(roots, "k", "left").withColumn("root", F.coalesce("root", "k")), "named")
    classes = materialize(named.groupBy("root").agg(F.min("id").alias("class_id"), F.sum("n").alias("class_size")), "classes")
    of_text = materialize(named.select("k", "root").join(classes, "root").select("k", "class_id", F.col("root").alias("class_key"), "class_size"), "of_text")
    alone = signed.filter(F.col("bands").isNull()).select("id", "k", F.col("id").alias("class_id"), F.col("k").alias("class_key"),
                                                      F.lit(1).cast("bigint").alias("class_size"))
    return (
        worded.select("id", "k").join(of_text, "k").select("id", "k", "class_id", "class_key", "class_size").unionByName(alone)
        .withColumnRenamed("id", id_col))


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class, all columns as they were: the one of the smallest id, among those the smallest key.

    Documents without words all stay.
    """
    found = materialize(near_duplicates(docs, id_col, text_col), "classes_of")
    named = found.filter(F.col(id_col).eqNullSafe(F.col("class_id")))
    first = named.groupBy(F.col("class_id").alias("first_id"), "class_key").agg(F.min("k").alias("first")).drop("class_key")
    empty = F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")), F.lit(0)) == 0
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"),
                         text_key(F.col(text_col)).alias("k"), empty.alias("empty"))
    kept = marked.filter("NOT empty").join(first.hint("merge"), F.col("id").eqNullSafe(F.col("first_id")) & (F.col("k") == F.col("first")), "left_semi")
    return kept.dropDuplicates(["id", "k"]).unionByName(marked.filter("empty")).select("row.*")
