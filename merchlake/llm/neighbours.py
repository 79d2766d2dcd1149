"""Approximate nearest neighbours with balanced posting lists.

* Fit: hierarchical k-means splits a bounded sample (``sample`` vectors, the first by a
  hash) until no cluster holds more than ``list_size`` of it or ``most_lists`` is reached.
* A navigable graph over the centroids, pruned by relative neighbourhood, lies in every task's
  memory; its size is bounded by most_lists.  A beam search on it finds centroids;
  a query whose beam ends within the ratio scans them all.
* Every vector goes to its nearest list, and boundary vectors also to others
  nearly as near, unless a chosen centroid is too close to theirs.
* A query probes the lists whose centroid is no farther than a ratio of the
  nearest one's distance, and compares exactly with all vectors there.  The ratio
  is fitted, by how near the nearest one is: on the sample, it finds the share ``recall`` of the true neighbours, so
  clustered vectors are read in small part and others as far as they need it.

Lists that grow beyond a block are dealt over blocks, and queries over groups of bounded size.
The blocks are dealt over tasks, where they pass by; a task holds one block's queries and the best of one group,
so what goes on grows with the queries, not with the lists that each one probes.  Equal vectors are one node: of a node only the
k + 1 smallest ids can ever be among the k nearest, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Stage

SAMPLE = 20_000
MOST_LISTS = 4096
BLOCK = 1024
#: Queries whose nearest a task holds at once.
GROUP = 4096
#: Vectors of the sample that ask when the ratio is fitted.
TRIALS = 512


def _matrix(column) -> np.ndarray:
    """A list column whose rows are all equally long, as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b, for choosing only."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T), 0)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """The cluster of each row."""
    c = x[rng.choice(len(x), k, replace=False)]
    own = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        own = squared(x, c).argmin(axis=1)
        for j in range(k):
            if (own == j).any():
                c[j] = x[own == j].mean(axis=0)
    return own


def centroids(x: np.ndarray, list_size: int, most: int = MOST_LISTS, seed: int = 1) -> np.ndarray:
    """Means of a hierarchical clustering, the largest cluster split first.

    Clusters of less than an eighth of list_size are no lists: a query in one of them would be
    so near to its centroid that the ratio finds nothing else.
    """
    import heapq

    rng = np.random.default_rng(seed)
    heap = [(-len(x), 0, np.arange(len(x)))]
    done: list[np.ndarray] = []
    made = 1
    while heap:
        n, _, rows = heapq.heappop(heap)
        if -n <= list_size or len(heap) + len(done) + 8 > most:
            done.append(rows)
            continue
        own = _kmeans(x[rows], min(8, max(2, -n // list_size)), rng)
        parts = [rows[own == j] for j in np.unique(own)]
        if len(parts) < 2:
            done.append(rows)
            continue
        for p in parts:
            heapq.heappush(heap, (-len(p), made, p))
            made += 1
    kept = [r for r in done if len(r) >= max(2, list_size // 8)] or done
    return np.array([x[r].mean(axis=0) for r in kept])


class CentroidGraph:
    """Neighbours of each centroid: near ones that no nearer neighbour stands between."""

    def __init__(self, c: np.ndarray, degree: int = 24):
        self.c = c
        n = len(c)
        links = np.repeat(np.arange(n)[:, None], degree, axis=1)
        for i in range(n):
            d = squared(c[i : i + 1], c)[0]
            near = np.argsort(d, kind="stable")[1 : 4 * degree + 1]
            kept: list[int] = []
            for j in near:
                if len(kept) < degree and all(d[j] < ((c[j] - c[k]) ** 2).sum() for k in kept):
                    kept.append(int(j))
            rest = [int(j) for j in near if j not in kept]
            kept += rest[: degree - len(kept)]
            links[i, : len(kept)] = kept
        self.links = links
        self.start = int(squared(c.mean(axis=0, keepdims=True), c)[0].argmin()) if n else 0

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each query the nearest centroids found, nearest first, and their distances (infinite: none)."""
        rows, n = len(q), len(self.c)
        beam = min(beam, n)
        ids = np.full((rows, beam), self.start)
        dist = np.full((rows, beam), np.inf)
        dist[:, 0] = np.sqrt(((q - self.c[self.start]) ** 2).sum(axis=1))
        open_ = np.isfinite(dist)
        seen = np.zeros((rows, n), bool)
        seen[:, self.start] = True
        every = np.arange(rows)[:, None]
        while open_.any():
            at = np.where(open_, dist, np.inf).argmin(axis=1)
            live = open_[np.arange(rows), at]
            open_[np.arange(rows), at] = False
            near = self.links[ids[np.arange(rows), at]]
            fresh = ~seen[every, near] & live[:, None]
            seen[every, near] |= live[:, None]
            d = np.where(fresh, np.sqrt(((self.c[near] - q[:, None]) ** 2).sum(axis=2)), np.inf)
            ids, dist, open_ = np.hstack([ids, near]), np.hstack([dist, d]), np.hstack([open_, fresh])
            best = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            ids, dist, open_ = ids[every, best], dist[every, best], open_[every, best]
        return ids, dist

    def within(self, q: np.ndarray, ratio, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Query and centroid of each pair that lies within 1 + ratio times the query's least distance.

        ratio is a number, or one for each query made from its least distance.  Where the beam
        does not reach beyond the bound, all centroids are scanned.
        """
        bound = lambda least: least * (1 + (ratio(least) if callable(ratio) else ratio))
        ids, dist = self.search(q, beam)
        most = bound(dist[:, 0])
        wide = ~(np.isfinite(dist[:, -1]) & (dist[:, -1] > most))
        at, cols = np.nonzero((dist <= most[:, None]) & ~wide[:, None])
        rows, lists = [at], [ids[at, cols]]
        for part in np.array_split(np.flatnonzero(wide), -(-int(wide.sum()) // 64) or 1):
            if len(part):
                d = np.sqrt(squared(q[part], self.c))
                at, cols = np.nonzero(d <= bound(d.min(axis=1))[:, None])
                rows.append(part[at])
                lists.append(cols)
        return np.concatenate(rows), np.concatenate(lists)

    def enough(self, q: np.ndarray, rows: np.ndarray, lists: np.ndarray, sizes: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
        """The pairs, and for queries whose lists hold less than need postings the nearest lists that do."""
        few = np.flatnonzero(np.bincount(rows, sizes[lists], len(q)) < need)
        keep = ~np.isin(rows, few)
        out = [(rows[keep], lists[keep])]
        for i in few:
            near = np.argsort(squared(q[i : i + 1], self.c)[0], kind="stable")
            own = lists[rows == i]
            more = near[: int(np.searchsorted(np.cumsum(sizes[near]), need)) + 1]
            found = np.union1d(own, more)
            out.append((np.full(len(found), i), found))
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def replicate(g: CentroidGraph, v: np.ndarray, replicas: int, closure: float, beam: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """Row and list of each posting: a vector's nearest list, and others nearly as near that no chosen list's centroid is nearer to."""
    ids, dist = g.search(v, beam)
    rows, lists = [], []
    for i in range(len(v)):
        chosen: list[int] = []
        for j, d in zip(ids[i], dist[i], strict=True):
            if len(chosen) == replicas or d > (1 + closure) * dist[i, 0]:
                break
            if not chosen or all(((g.c[j] - g.c[c]) ** 2).sum() > d * d for c in chosen):
                chosen.append(int(j))
        rows += [i] * len(chosen)
        lists += chosen
    return np.array(rows, np.int64), np.array(lists, np.int32)


class Best:
    """The k nearest found so far of each of some queries."""

    def __init__(self, k: int):
        self.k, self.at, self.found = k, {}, []

    def compare(self, ids: np.ndarray, fs: np.ndarray, q: np.ndarray, node: np.ndarray, f: np.ndarray, p: np.ndarray) -> None:
        """Queries (ids, fs, q) against postings (node, f, p): what is no farther than a query's k-th is kept, ties to the smaller node."""
        for i, key in enumerate(zip(ids.tolist(), fs.tolist(), strict=True)):
            d = np.sqrt(((p - q[i]) ** 2).sum(axis=1))
            at = self.at.setdefault(key, len(self.found))
            if at == len(self.found):
                self.found.append((np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)))
            score, n, g = self.found[at]
            near = np.flatnonzero(d <= score[-1]) if len(score) == self.k else np.arange(len(d))
            if not len(near):
                continue
            if len(near) > 4 * self.k:  # all that is no farther than the k-th of these
                near = near[d[near] <= np.partition(d[near], self.k - 1)[self.k - 1]]
            score, n, g = np.r_[score, d[near]], np.r_[n, node[near]], np.r_[g, f[near]]
            order = np.lexsort((g, n, score))
            score, n, g = score[order], n[order], g[order]
            new = np.r_[True, (n[1:] != n[:-1]) | (g[1:] != g[:-1])]  # a vector stands in several lists, with one score
            self.found[at] = tuple(x[new][: self.k] for x in (score, n, g))

    def rows(self) -> Iterator[pa.RecordBatch]:
        keys = list(self.at)
        for k0 in range(0, len(keys), 1024):
            own = [self.found[self.at[key]] for key in keys[k0 : k0 + 1024]]
            n = [len(score) for score, *_ in own]
            asks = [np.repeat(np.array([key[j] for key in keys[k0 : k0 + 1024]], np.int64), n) for j in range(2)]
            score, node, f = (np.concatenate(x) for x in zip(*own, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*asks, node, f, score)], ["query", "query_f", "node", "f1", "score"])


def nearest_of_task(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Of each query in a task the k nearest of all postings it meets there.

    Rows (q, list, b, its, node, f1, v) in the order of the first four: of each block the queries
    (its is false) and then the postings, which pass by. What is held are one block's queries and the best
    of one group q of queries.
    """
    group, block, best, asks = None, None, Best(k), []
    for whole in batches:
        cols = [whole.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
        edges = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0)) + 1 if whole.num_rows > 1 else np.zeros(0, np.int64)
        for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), whole.num_rows], strict=True):
            if lo == hi:
                continue
            if cols[0][lo] != group:
                yield from best.rows()
                group, best = cols[0][lo], Best(k)
            if (now := tuple(c[lo] for c in cols[:3])) != block:
                block, asks = now, []
            part = cols[4][lo:hi], cols[5][lo:hi], _matrix(whole.column(6).slice(lo, hi - lo))
            if not cols[3][lo]:
                asks.append(part)
                continue
            for own in asks:
                best.compare(*own, *part)
    yield from best.rows()


class FittedRatio:
    """A ratio for each of some classes of queries, by the distance of their nearest centroid: dense parts need larger ones.

    In each class it is the least at which the lists within it hold the share recall of the
    sample's true neighbours of some of its vectors.
    """

    def __init__(self, g: CentroidGraph, x: np.ndarray, k: int, recall: float, replicas: int, closure: float, trials: int = TRIALS, classes: int = 8):
        self.edges, self.ratios = np.zeros(0), np.zeros(1)
        if len(x) < 2:
            return
        base, needed = [], []
        for q in np.array_split(x[:: max(1, len(x) // trials)][:trials], 8):
            if not len(q):
                continue
            near = np.argsort(squared(q, x), axis=1)[:, 1 : k + 1]
            rows, lists = replicate(g, x[near.ravel()], replicas, closure)
            far = np.sqrt(squared(q, g.c))
            ratio = far / np.maximum(far.min(axis=1, keepdims=True), 1e-30) - 1
            least = np.full(near.size, np.inf)
            np.minimum.at(least, rows, ratio[np.repeat(np.arange(len(q)), near.shape[1])[rows], lists])
            base.append(far.min(axis=1))
            needed += list(least.reshape(len(q), -1))
        base = np.concatenate(base)
        self.edges = np.quantile(base, np.arange(1, classes) / classes)
        own = np.searchsorted(self.edges, base)
        self.ratios = np.zeros(classes)
        for j in range(classes):
            found = np.sort(np.concatenate([n for n, o in zip(needed, own, strict=True) if o == j] or [np.zeros(1)]))
            self.ratios[j] = found[min(len(found) - 1, int(np.ceil(recall * len(found))))] + 1e-9

    def __call__(self, least: np.ndarray) -> np.ndarray:
        return self.ratios[np.searchsorted(self.edges, least)]


def _usable(vectors: DataFrame) -> DataFrame:
    """vec_id, f1, f2 (digest of the vector), v: rows that take part."""

    def run(batches):
        for b in batches:
            ids, vs = b.column(0).to_pylist(), b.column(1)
            keep, digest = [], []
            for i in range(len(vs)):
                v = vs[i]
                x = v.values.to_numpy(zero_copy_only=False) if v.is_valid and not v.values.null_count else None
                if x is not None and len(x) and ids[i] is not None and np.isfinite(x).all() and x.any():
                    keep.append(i)
                    digest.append(xxhash.xxh3_128_digest((x + 0.0).astype(np.float64).tobytes()))
            f = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
            own = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([own.column(0), pa.array(np.ascontiguousarray(f[:, 0])), pa.array(np.ascontiguousarray(f[:, 1])), own.column(1)], ["vec_id", "f1", "f2", "v"])

    kind = vectors.schema["v"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id long, f1 long, f2 long, v {kind}")


def nearest(vectors: DataFrame, queries, k: int = 10, list_size: int = 64, replicas: int = 3, closure: float = 0.1, recall: float = 0.95, sample: int = SAMPLE, most_lists: int = MOST_LISTS, beam: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k nearest found of each query, its own row excepted.

    vectors (vec_id, embedding); queries is a condition on vec_id that picks
    the rows that ask.  Nearest first by Euclidean distance in double
    precision, ties to the smaller vec_id.  Vectors that are null, zero, hold
    null or non-finite components, or have a null vec_id take no part; those of another
    length are searched among their like.  Rows equal in vec_id and vector are
    one; rows that share a vec_id only are candidates each, and each asks (its
    result stands under the same query_id).

    recall is what the ratio is fitted to on the sample (``sample`` vectors at
    most).  Lists grow with the table beyond ``most_lists`` times ``list_size``;
    for more than a million vectors raise sample and most_lists together.
    """
    spark = vectors.sparkSession
    stage = Stage(spark, "neighbours")
    usable = stage.write(_usable(vectors.select(F.col("vec_id").cast("long"), F.col("embedding").alias("v"))).withColumn("n", F.size("v")), "usable")
    shapes = [r["n"] for r in usable.select("n").distinct().orderBy("n").collect()]
    out = None
    for n in shapes:
        found = _nearest(usable.where(F.col("n") == n).drop("n"), stage, queries, k, list_size, replicas, closure, recall, sample, most_lists, beam)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double") if out is None else out


def _nearest(usable: DataFrame, stage: Stage, queries, k: int, list_size: int, replicas: int, closure: float, recall: float, sample: int, most_lists: int, beam: int) -> DataFrame:
    """``nearest`` for vectors of one length."""
    spark = usable.sparkSession
    members = stage.write(usable.select("vec_id", "f1", "f2").distinct(), "members")
    heads = members.groupBy("f1", "f2").agg(F.min("vec_id").alias("node"))
    nodes = usable.join(heads, [usable.vec_id == heads.node, usable.f1 == heads.f1, usable.f2 == heads.f2]).select("node", usable.f1, usable.f2, "v")
    # a node is a vector, known by its smallest vec_id and, as rows may share one, half of its digest
    nodes = stage.write(nodes.dropDuplicates(["node", "f1", "f2"]), "nodes")

    count = nodes.count()
    few = nodes.where(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < int(1.2 * sample / count * (1 << 20)) + 1) if count > sample else nodes
    fitted = few.orderBy(F.xxhash64("node")).limit(sample).select("v").toArrow().column(0).combine_chunks()
    x = _matrix(fitted)
    graph = CentroidGraph(centroids(x, max(2, list_size * len(x) // max(count, 1)) if count > sample else list_size, most_lists))
    ratio = FittedRatio(graph, x, k, recall, replicas, closure)
    sent = spark.sparkContext.broadcast(graph)
    # a vector stands in ``replicas`` lists at most, so that many postings hold k + 1 vectors
    sizes_of, need = np.zeros(len(graph.c), np.int64), 2 * replicas * (k + 1)

    def assign(batches):
        for big in batches:
            for at in range(0, big.num_rows, 512):
                b = big.slice(at, 512)
                rows, lists = replicate(sent.value, _matrix(b.column(2)), replicas, closure)
                own = b.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(lists), own.column(2)], ["node", "f1", "list", "v"])

    def choose(batches):
        g = sent.value
        for big in batches:
            for at in range(0, big.num_rows, 512):
                b = big.slice(at, 512)
                q = _matrix(b.column(2))
                rows, lists = g.enough(q, *g.within(q, ratio, beam), sizes_of, need)
                for k0 in range(0, len(rows), 16_384):
                    own = b.take(pa.array(rows[k0 : k0 + 16_384]))
                    yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(lists[k0 : k0 + 16_384].astype(np.int32)), own.column(2)], ["node", "f1", "list", "v"])

    kind = nodes.schema["v"].dataType.simpleString()
    posting = f"node long, f1 long, list int, v {kind}"
    postings = stage.write(nodes.select("node", "f1", "v").mapInArrow(assign, posting), "postings")
    for j, n in postings.groupBy("list").count().collect():  # most_lists rows
        sizes_of[j] = n
    named = members.withColumnRenamed("vec_id", "own").join(nodes.select("f1", "f2", "node"), ["f1", "f2"])
    asking = stage.write(named.withColumnRenamed("own", "vec_id").where(queries).select(F.col("vec_id").alias("query_id"), "node", "f1"), "asking")
    probing = stage.write(nodes.join(asking.select("node", "f1").distinct(), ["node", "f1"], "left_semi").select("node", "f1", "v").mapInArrow(choose, posting), "probing")

    # blocks of lists and of their queries: groups of bounded size
    blocks = lambda df, name, size: df.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))  # noqa: E731  most_lists rows
    groups = -(-asking.count() // GROUP) or 1
    deal = lambda n: F.pmod(F.xxhash64("node", "f1"), n).cast("int")
    grouped = probing.withColumn("q", deal(F.lit(groups)))
    own = grouped.groupBy("list").agg(F.collect_set("q").alias("own"))
    sizes = F.broadcast(blocks(postings, "nb", BLOCK).join(own, "list"))
    held = postings.join(sizes, "list").withColumn("b", deal(F.col("nb"))).withColumn("q", F.explode("own"))
    asks = grouped.join(sizes, "list").withColumn("b", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    block = ["q", "list", "b"]
    both = asks.select(*block, F.lit(False).alias("its"), "node", "f1", "v").unionByName(held.select(*block, F.lit(True).alias("its"), "node", "f1", "v"))
    # a task tells k + 1 of each query at most, however many lists it meets there
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = both.repartition(tasks, *block).sortWithinPartitions(*block, "its").mapInArrow(lambda batches: nearest_of_task(batches, k + 1), "query long, query_f long, node long, f1 long, score double")
    asker = Window.partitionBy("query", "query_f")
    found = near.distinct().withColumn("r", F.row_number().over(asker.orderBy("score", "node", "f1"))).where(F.col("r") <= k + 1)
    # a node's smallest ids; the k + 1 best ids of each asking vector; then each query without its own row
    ids = named.withColumn("r", F.row_number().over(Window.partitionBy("node", "f1").orderBy("own"))).where(F.col("r") <= k + 1).select("node", "f1", F.col("own").alias("vec_id"))
    listed = found.drop("r").join(ids, ["node", "f1"]).withColumn("r", F.row_number().over(asker.orderBy("score", "vec_id", "f1"))).where(F.col("r") <= k + 1)
    other = asking.join(listed.select(F.col("query").alias("node"), F.col("query_f").alias("f1"), "vec_id", "score", F.col("f1").alias("its")), ["node", "f1"]).where((F.col("vec_id") != F.col("query_id")) | (F.col("its") != F.col("f1")))
    ranked = other.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "node", "f1").orderBy("score", "vec_id", "its")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
