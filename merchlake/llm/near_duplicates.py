"""Near-duplicate classes by ProbMinHash, banding and verification.

A document is its five-word shingles, each with the weight 1 + ln(count): a
shingle repeated a hundred times weighs more than one that occurs once, but
does not drown the others.  Two documents are near-duplicates if their
probability Jaccard similarity

    J_P(a, b) = sum over d in both of 1 / sum over all e of max(a_e / a_d, b_e / b_d)

is 0.8 or more; for shingles that occur once this is the plain Jaccard
similarity, and like that one it makes 1 - J_P a metric.

ProbMinHash: each shingle has a Poisson process of its own, seeded by its
hash, with its weight as the rate; every arrival falls on a register at
random and each register keeps its earliest arrival.  A shingle is done as
soon as its next arrival comes after the latest of all registers.  Two
registers agree with probability J_P.  All documents of a batch advance
together, so each round is a few array operations.

Bands of registers put documents into buckets.  A bucket is not turned into
pairs.  Each member is compared with one first member of its buckets, then, where
a bucket still holds several classes, with one most central member (that with
the least weight of shingles of its own).  What then still lies in several classes
meets by its rarest shingles only, and only where the weights before them
leave the similarity possible.  No link between candidates is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Grams, Stage, map_batches, mix, word_hashes, word_list
from .line_runs import join_counted
from .substrings import small_side

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 5
#: Comparisons of one member that a task makes, about; a member with more is dealt over as many tasks as that takes.
DEALT = 500
#: Nodes that share a shingle, a task's share of them.
BLOCK = 2000
#: Longs of the bitmap that bounds by how many shingles two texts differ.
BITMAP = 8

_grams = Grams(0)


def shingles(text: str | None, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a text's shingles in ascending order, and their counts; a text of fewer words is one shingle, one without words none."""
    words = word_list(text)
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.unique(_grams.windows(word_hashes(words), min(width, len(words))), return_counts=True)


def weigh(counts: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(counts)


def prob_minhash(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, documents: int, registers: int) -> np.ndarray:
    """Registers (documents x registers) of the elements that arrive first; every document has an element."""
    times = np.full(documents * registers, np.inf)
    first = np.zeros(documents * registers, np.uint64)
    e, w, d = elements, weights, owner
    t = np.zeros(len(e))
    step = 0
    while len(e):
        with np.errstate(over="ignore"):
            r = mix(e ^ mix(np.full(1, step, np.uint64)))
        t = t - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / w
        at = d * registers + (mix(r) % np.uint64(registers)).astype(np.int64)
        early = t < times[at]
        np.minimum.at(times, at[early], t[early])
        won = t == times[at]
        first[at[won]] = e[won]
        going = t < times.reshape(documents, registers).max(axis=1)[d]
        e, w, d, t = e[going], w[going], d[going], t[going]
        step += 1
    return first.reshape(documents, registers)


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, width: int = SHINGLE) -> DataFrame:
    """doc_id, f1, f2 (a digest of the weighted shingles) and bands (bucket hashes) of every row; nulls for texts without words."""

    def run(c: dict) -> pa.RecordBatch:
        sets = [shingles(t, width) for t in c["text"].to_pylist()]
        full = [i for i, s in enumerate(sets) if len(s[0])]
        f1: list = [None] * len(sets)
        f2: list = [None] * len(sets)
        found: list = [None] * len(sets)
        if full:
            owner = np.repeat(np.arange(len(full)), [len(sets[i][0]) for i in full])
            sig = prob_minhash(np.concatenate([sets[i][0] for i in full]), weigh(np.concatenate([sets[i][1] for i in full])), owner, len(full), bands * rows)
            with np.errstate(over="ignore"):
                key = np.zeros((len(full), bands), np.uint64) + np.arange(bands, dtype=np.uint64)
                for k in range(rows):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sig.reshape(len(full), bands, rows)[:, :, k])
            for i, k in zip(full, key.view(np.int64), strict=True):
                raw = sets[i][0].tobytes() + sets[i][1].tobytes()
                f1[i], f2[i] = np.frombuffer(xxhash.xxh3_128_digest(raw), np.int64).tolist()
                found[i] = k
        return pa.RecordBatch.from_arrays([c["doc_id"].cast(pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "f1", "f2", "bands"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, f1 long, f2 long, bands array<long>")


def bitmap(elements: np.ndarray) -> np.ndarray:
    """Parities of how many elements fall on each bit: two sets' bitmaps differ in no more bits than the sets in elements."""
    bit = (mix(elements ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)) % np.uint64(64 * BITMAP)
    return np.packbits(np.bincount(bit.astype(np.int64), minlength=64 * BITMAP).astype(np.uint8) & 1).view(np.int64)


def prob_jaccard(ea: np.ndarray, ca: np.ndarray, eb: np.ndarray, cb: np.ndarray) -> float:
    """J_P of two weighted sets, given as ascending hashes and counts."""
    _, ia, ib = np.intersect1d(ea, eb, assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    wa, wb = weigh(ca), weigh(cb)
    sa, sb = wa.sum(), wb.sum()
    a, b = wa[ia] / sa, wb[ib] / sb
    ratio = a / b
    order = np.argsort(ratio, kind="stable")
    a, b, ratio = a[order], b[order], ratio[order]
    low = np.searchsorted(ratio, ratio, "left")
    below_b = np.r_[0.0, np.cumsum(b)][low] + (sb - wb[ib].sum()) / sb
    above_a = a.sum() - np.r_[0.0, np.cumsum(a)][low] + (sa - wa[ia].sum()) / sa
    return float((1.0 / (above_a / a + below_b / b)).sum())


def _compare(pairs: DataFrame, sets: DataFrame, stage: Stage) -> DataFrame:
    """a, b, similarity of pairs (a, b). b may be hot: its set is dealt over salts, by how many pairs it has."""
    pairs = stage.write(pairs.select("a", "b"), "to-compare")
    hot_ones = stage.write(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > DEALT).select("b", F.ceil(F.col("n") / DEALT).alias("salts")), "hot")
    salted = pairs.join(small_side(hot_ones), "b", "left").select("a", "b", F.pmod(F.xxhash64("a"), F.coalesce("salts", F.lit(1))).alias("salt"))
    hot = salted.select("b", "salt").distinct().join(sets.select(F.col("node").alias("b"), F.col("e").alias("eb"), F.col("n").alias("nb")), "b")
    both = salted.join(sets.select(F.col("node").alias("a"), F.col("e").alias("ea"), F.col("n").alias("na")), "a").join(hot, ["b", "salt"]).select("a", "b", "ea", "na", "eb", "nb")

    def run(c: dict) -> pa.RecordBatch:
        sims = [prob_jaccard(*x, *y) for x, y in zip(_sets_of(c["ea"], c["na"]), _sets_of(c["eb"], c["nb"]), strict=True)]
        return pa.RecordBatch.from_arrays([c["a"], c["b"], pa.array(sims, pa.float64())], ["a", "b", "similarity"])

    out = stage.write(map_batches(both, run, "a long, b long, similarity double"), "compared")
    stage.drop(pairs, hot_ones)
    return out


def _sets_of(es, ns):
    """Hashes and counts of each row; absent counts are all one."""
    for i in range(len(es)):
        x = es[i].values.to_numpy(zero_copy_only=False)
        yield x.view(np.uint64), ns[i].values.to_numpy(zero_copy_only=False).astype(np.int64) if ns[i].is_valid else np.ones(len(x), np.int64)


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """node, class (the smallest node that it is linked to) of every node of the edges (a, b): large and small stars by turns."""
    e = stage.write(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        new = stage.write(small.where("u <> v").distinct(), "stars")
        now = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        stage.drop(e)
        e = new
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("class"))


def _joined(label: DataFrame | None, links: DataFrame, stage: Stage) -> DataFrame:
    """The classes (node, class) after more links (a, b) between nodes: only the links between classes are followed."""
    if label is None:
        return stage.write(components(links, stage), "classes")
    if links.isEmpty():
        return label
    of = lambda x: label.select(F.col("node").alias(x), F.col("class").alias(f"class_{x}"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("class_a", "a").alias("a"), F.coalesce("class_b", "b").alias("b"))
    top = stage.write(components(between, stage), "tops").select(F.col("node").alias("class"), F.col("class").alias("top"))
    below = label.join(top, "class", "left").select("node", F.coalesce("top", "class").alias("class"))
    new = top.join(label.select(F.col("node").alias("class")), "class", "left_anti").select(F.col("class").alias("node"), F.col("top").alias("class"))
    return stage.write(below.unionByName(new), "classes")


def _open(held: DataFrame, label: DataFrame, stage: Stage) -> DataFrame:
    """bucket, node, class of the buckets that hold several classes."""
    now = held.join(label, "node", "left").select("bucket", "node", F.coalesce("class", "node").alias("class"))
    split = now.groupBy("bucket").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x < y").select("bucket")
    return stage.write(now.join(split, "bucket", "left_semi"), "open")


def _rarities(nodes: DataFrame, sets: DataFrame, stage: Stage) -> DataFrame:
    """node, shingle, weight (of the node's whole), df (nodes that hold it) of every shingle of the nodes."""

    def run(c: dict) -> pa.RecordBatch:
        found = list(_sets_of(c["e"], c["n"]))
        weights = [weigh(n) for _, n in found]
        sizes = [len(e) for e, _ in found]
        node = np.repeat(c["node"].to_numpy(), sizes)
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.concatenate([e.view(np.int64) for e, _ in found])), pa.array(np.concatenate([w / w.sum() for w in weights]))], ["node", "shingle", "weight"])

    own = stage.write(map_batches(sets.join(nodes, "node", "left_semi").select("node", "e", "n"), run, "node long, shingle long, weight double"), "shingles")
    per = stage.write(own.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).withColumn("n", F.col("df")), "df")
    out = stage.write(join_counted(own, per, ["shingle"]).select("node", "shingle", "weight", "df"), "rarities")
    stage.drop(own, per)
    return out


def possible(u, v, similarity: float):
    """Whether two sets can be similar if weights u and v of theirs are not in the other.

    J_P sums a b / (b + v a) at most over what is shared, a and b being its
    weights; this is concave, so that the sum is (1-u)(1-v) / (1-uv) at most.
    """
    return (1 - u) * (1 - v) >= similarity * (1 - u * v) - 1e-9


def prefix_pairs(open_: DataFrame, rarities: DataFrame, sets: DataFrame, similarity: float, stage: Stage, levels: int = 4) -> DataFrame:
    """Pairs (a, b) of open nodes of different classes; all that are similar are among them.

    Each node's shingles stand in one order, the rarest first.  Up to the
    first one that two nodes share, all weight before it, u and v, is not
    shared, so ``possible(u, v)`` must hold.  Then the smaller of u and v is at
    most (1 - s) / (1 + s), and the other at most the bound that belongs to
    it; levels of u keep apart what cannot meet.  As a shingle weighs 1 at least,
    of a total S, u + v is no less than the shingles that differ, and so the bits that
    differ, by the larger S: pairs beyond 2 (1 - s) / (1 + s) never leave the
    join.  A shingle's largest class is not compared with itself: one of each
    pair is of another class.  Shingles that many nodes share are dealt over salts.
    """
    s = similarity
    before = F.coalesce(F.sum("weight").over(Window.partitionBy("node").orderBy("df", "shingle").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    mine = rarities.join(open_.select("node", "class").distinct(), "node").withColumn("u", before).where((F.col("u") <= 1 - s + 1e-9) & (F.col("df") > 1))
    about = sets.select("node", "total", "bits")
    prefix = stage.write(mine.select("node", "class", "shingle", "u").join(about, "node"), "prefixes")
    per = prefix.groupBy("shingle", "class").agg(F.count(F.lit(1)).alias("n")).groupBy("shingle").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.max_by("class", F.struct("n", "class")).alias("main"))
    met = stage.write(per.where("k > 1").select("shingle", "main", F.ceil(F.col("n") / BLOCK).cast("int").alias("salts")), "met")
    rows = prefix.join(small_side(met), "shingle")
    most = (1 - s) / (1 + s)
    low = [most * i / levels for i in range(levels)]
    reach = [((1 - s) - x) / (1 - (1 + s) * x) + 1e-9 for x in low]  # the most that v can be
    level = F.least(F.floor(F.col("u") / most * levels), F.lit(levels - 1)).cast("int")
    first = rows.where(F.col("u") <= most + 1e-9).withColumn("level", level)
    second = rows.withColumn("level", F.explode(F.filter(F.array(*(F.when(F.col("u") <= r, F.lit(i)) for i, r in enumerate(reach))), lambda x: x.isNotNull())))
    key, out = ["shingle", "level", "salt"], None
    differ = sum((F.bit_count(F.get(F.col("bits"), F.lit(i)).bitwiseXOR(F.get(F.col("bits_b"), F.lit(i)))) for i in range(BITMAP)), F.lit(0))
    fits = (F.col("ca") != F.col("cb")) & possible(F.col("u"), F.col("v"), s) & (differ <= 2 * most * F.greatest("total", "total_b") + 1e-6)
    for x, y in ((first, second), (second, first)):
        few = x.where("class <> main").select("shingle", "level", F.col("node").alias("a"), F.col("class").alias("ca"), "u", "total", "bits", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        all_ = y.select("shingle", "level", F.col("node").alias("b"), F.col("class").alias("cb"), F.col("u").alias("v"), F.col("total").alias("total_b"), F.col("bits").alias("bits_b"), F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"))
        some = few.join(all_, key).where(fits).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        out = some if out is None else out.unionByName(some)
    pairs = stage.write(out.distinct(), "pairs")
    stage.drop(prefix, met)
    return pairs


def classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, width: int = SHINGLE) -> DataFrame:
    """doc_id, class_id and n_links of every document.

    class_id is the smallest doc_id among the documents that links of the given
    similarity join to it; n_links counts the links between its text and other
    texts that were verified on the way (enough to span the class; exact copies are no links).
    A text without words (or null) is a class of its own, as is a row with a
    null doc_id (its class is null; each such row gives a row).  Rows that share a
    doc_id are one document and give one row, with the smallest of their classes.  An empty table gives no rows; other columns are not read.
    """
    stage = Stage(docs.sparkSession, "near")
    found = stage.write(sketches(docs, bands, rows, width), "sketches")
    usable = found.where("doc_id IS NOT NULL AND f1 IS NOT NULL")
    # equal weighted shingles: one node, the smallest doc_id
    nodes = stage.write(usable.groupBy("f1", "f2").agg(F.min("doc_id").alias("node")), "nodes")
    members = stage.write(usable.join(nodes, [usable.doc_id == nodes.node, usable.f1 == nodes.f1, usable.f2 == nodes.f2]).select("node", F.explode("bands").alias("bucket")).distinct(), "members")
    buckets = stage.write(members.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most"), F.count(F.lit(1)).alias("n")).where("least < most").drop("most"), "shared")
    held = stage.write(join_counted(members, buckets, ["bucket"]), "buckets")
    stage.drop(members, buckets)
    candidates = stage.write(held.select("node").distinct(), "candidates")
    texts = docs.select(F.col("doc_id").alias("node"), "text").join(small_side(candidates), "node")

    def build(c: dict) -> pa.RecordBatch:
        sets = [shingles(t, width) for t in c["text"].to_pylist()]
        total = [float(weigh(n).sum()) for _, n in sets]
        return pa.RecordBatch.from_arrays([c["node"].cast(pa.int64()), pa.array([s[0].view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array([s[1].astype(np.int32) if (s[1] > 1).any() else None for s in sets], pa.list_(pa.int32())), pa.array(total), pa.array([bitmap(s[0]) for s in sets], pa.list_(pa.int64()))], ["node", "e", "n", "total", "bits"])

    sets = stage.write(map_batches(texts, build, "node long, e array<long>, n array<int>, total double, bits array<long>"), "sets")
    similar = F.col("similarity") >= similarity
    # 1. each node with one node: the smallest of its buckets' first ones
    compared = [_compare(held.groupBy(F.col("node").alias("a")).agg(F.min("least").alias("b")).where("a <> b"), sets, stage)]
    label = _joined(None, compared[0].where(similar), stage)
    open_ = _open(held, label, stage)
    stage.drop(held, candidates)
    if not open_.isEmpty():
        # 2. with one more: of its buckets' most central members, which have the least of their own, the most central
        rarities = _rarities(open_.select("node").distinct(), sets, stage)
        own = rarities.groupBy("node").agg(F.sum(F.when(F.col("df") == 1, F.col("weight")).otherwise(0.0)).alias("own"))
        placed = stage.write(open_.join(own, "node").select("bucket", "node", "class", "own"), "placed")
        centres = placed.groupBy("bucket").agg(F.min(F.struct("own", "node", "class")).alias("c"))
        best = placed.join(centres, "bucket").groupBy("node", "class").agg(F.min("c").alias("c")).where(F.col("c.class") != F.col("class"))
        pairs = best.select(F.greatest("node", "c.node").alias("a"), F.least("node", "c.node").alias("b")).distinct()
        compared.append(_compare(pairs.join(compared[0], ["a", "b"], "left_anti"), sets, stage))
        before, label = label, _joined(label, compared[1].where(similar), stage)
        still = _open(open_.select("bucket", "node"), label, stage)
        stage.drop(open_, placed, *([before] if before is not label else []))
        # 3. whatever can still be similar across classes, by the rarest shingles
        pairs = prefix_pairs(still, rarities, sets, similarity, stage)
        stage.drop(rarities, still)
        compared.append(_compare(pairs.join(compared[0].unionByName(compared[1]), ["a", "b"], "left_anti"), sets, stage))
        before, label = label, _joined(label, compared[2].where(similar), stage)
        stage.drop(pairs, *([before] if before is not label else []))
    stage.drop(sets)
    links = compared[0]
    for c in compared[1:]:
        links = links.unionByName(c)
    links = links.where(similar)
    counted = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    named = nodes.join(label, "node", "left").join(counted, "node", "left").select("f1", "f2", F.coalesce("class", "node").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    own = found.drop("bands").join(named, ["f1", "f2"], "left").select("doc_id", F.coalesce("class", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    alone = own.where("doc_id IS NULL").select("doc_id", F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return own.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.max("n_links").alias("n_links")).unionByName(alone)
