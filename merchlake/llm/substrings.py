"""Substring deduplication with a log-structured fingerprint index.

A word is removed if it lies in a window of 50 words whose word sequence also
starts in a document with a smaller doc_id.  Hashes of all windows would be
several times the text, so windows are indexed by what they share:

* A window's *anchor* is the least of the hashes of its 25-word grams (the
  first of equals).  Equal windows have equal anchors at the same place.
  Neighbouring windows mostly share one: about one word in thirteen is an
  anchor.
* A *segment* is a maximal run of windows with one anchor; its *context* are
  the words these windows cover, known by a fingerprint of the word hashes and
  a check digest of the words' bytes.

The index maps (anchor, context, check) to the first document that holds it,
as sorted immutable runs.  Documents come in batches by ascending doc_id.
Each batch is merge-joined with the runs:

1. A segment whose context an earlier document holds is removed whole.
2. Where an anchor occurs with several contexts (a passage's edge), windows
   decide: the contexts' first holders are read again, their windows' digests
   made from the words, and a window is removed if an earlier document has it.

The batch's contexts become a new run; runs of a size are compacted into one.
A run is a folder of files bucketed and sorted by anchor, so a batch is
shuffled to it and merge-joined with it where it lies, and the run is not.
The index outlives a call: ``dedup_batch`` opens it, removes from a new batch what earlier
batches hold, and adds the batch.
"""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LAST_ID, Grams, Stage, hadoop_path, join_counted, let_go, map_batches, table_bytes, word_hashes, word_list

CONTEXT = ["anchor", "context", "check"]
#: Tables up to this many bytes on disk are broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 8 << 20


def _numbered(docs: DataFrame) -> DataFrame:
    """doc (order; null ids last), key (tells rows apart that share a doc_id) and text."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"), F.xxhash64("text").alias("key"), "text")


def anchors(h: np.ndarray, grams: Grams, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each segment: its first and last window, and the anchor's hash."""
    g = grams.windows(h, gram)
    span = window - gram + 1
    at = np.lib.stride_tricks.sliding_window_view(g, span).argmin(axis=1) + np.arange(len(g) - span + 1)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    last = np.r_[first[1:], len(at)] - 1
    return first, last, g[at[first]]


def segments(docs: DataFrame, window: int, gram: int, digests: bool = False) -> DataFrame:
    """anchor, context, check, doc, key, lo, hi (first and last window) of every segment of every row; with digests also those of its windows."""

    def run(c: dict) -> pa.RecordBatch | None:
        parts, held = [], []
        for doc, key, text in zip(c["doc"].to_pylist(), c["key"].to_pylist(), c["text"].to_pylist(), strict=True):
            words = word_list(text)
            if len(words) < window:
                continue
            h = word_hashes(words)
            lo, hi, anchor = anchors(h, _grams, window, gram)
            context = _grams.spans(_grams.sums(h), lo, hi + window)
            raw = memoryview(b" ".join(words))
            edge = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            begin, end = np.r_[0, edge][lo].tolist(), (edge[hi + window - 1] - 1).tolist()
            digest = xxhash.xxh3_64_intdigest
            check = np.fromiter((digest(raw[b:e]) for b, e in zip(begin, end, strict=True)), np.uint64, len(lo))
            n = len(lo)
            parts.append((anchor, context, check, np.full(n, doc), np.full(n, key), lo.astype(np.int32), hi.astype(np.int32)))
            if digests:
                at = np.arange(len(h) - window + 1)
                both = np.stack([g.spans(g.sums(h), at, at + window) for g in (_grams, _other)], axis=1)
                held.extend(both[a : b + 1].tobytes() for a, b in zip(lo.tolist(), hi.tolist(), strict=True))
        if not parts:
            return None
        cols = [np.concatenate(x) for x in zip(*parts, strict=True)]
        arrays = [pa.array(x.view(np.int64) if x.dtype == np.uint64 else x) for x in cols]
        return pa.RecordBatch.from_arrays([*arrays, *([pa.array(held, pa.binary())] if digests else [])], [*CONTEXT, "doc", "key", "lo", "hi", *(["windows"] if digests else [])])

    return map_batches(_numbered(docs), run, "anchor long, context long, check long, doc long, key long, lo int, hi int" + (", windows binary" if digests else ""))


_grams = Grams(0)
_other = Grams(1)


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """Digests w1, w2 of the windows lo..hi of each row (doc, key, text, spans, new)."""

    def run(c: dict) -> pa.RecordBatch | None:
        parts = []
        for doc, key, text, spans, new in zip(*(c[x].to_pylist() for x in ("doc", "key", "text", "spans", "new")), strict=True):
            h = word_hashes(word_list(text))
            at = np.unique(np.concatenate([np.arange(s["lo"], s["hi"] + 1) for s in spans]))
            w1, w2 = (g.spans(g.sums(h), at, at + window) for g in (_grams, _other))
            parts.append((w1, w2, np.full(len(at), doc), np.full(len(at), key), at.astype(np.int32), np.full(len(at), new)))
        if not parts:
            return None
        cols = [np.concatenate(x) for x in zip(*parts, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64) if x.dtype == np.uint64 else x) for x in cols], ["w1", "w2", "doc", "key", "lo", "new"])

    return map_batches(texts.select("doc", "key", "text", "spans", "new"), run, "w1 long, w2 long, doc long, key long, lo int, new boolean")


def _stored_windows(held: DataFrame) -> DataFrame:
    """As _windows, of rows of an index: first (with doc, key, lo) and windows."""

    def run(c: dict) -> pa.RecordBatch | None:
        firsts, raw = c["first"].to_pylist(), c["windows"].to_pylist()
        n = [len(x) // 16 for x in raw]
        if not n:
            return None
        both = np.frombuffer(b"".join(raw), np.int64).reshape(-1, 2)
        doc, key = (np.repeat(np.array([f[k] for f in firsts], np.int64), n) for k in ("doc", "key"))
        lo = np.concatenate([np.arange(f["lo"], f["lo"] + k, dtype=np.int32) for f, k in zip(firsts, n, strict=True)])
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1])), pa.array(doc), pa.array(key), pa.array(lo), pa.array(np.zeros(len(lo), bool))], ["w1", "w2", "doc", "key", "lo", "new"])

    return map_batches(held.select("first", "windows"), run, "w1 long, w2 long, doc long, key long, lo int, new boolean")


def small_side(table: DataFrame) -> DataFrame:
    """A staged table, for broadcast if its size on disk is within bounds."""
    return F.broadcast(table) if table_bytes(table) <= BROADCAST_BYTES else table


class FingerprintIndex:
    """Runs of (anchor, context, check) with their first holder: doc, key, lo, hi.

    With windows a segment's window digests (16 bytes each) are kept too, so
    that later batches need no text of earlier ones.

    A run is a folder below root, bucketed and sorted by fingerprint, and never
    changed; one is valid once its write has succeeded.  An index that exists
    at root is opened, with windows or without as it was made; a run that was cut
    off is left aside, and its number is not used again.  When ``fan`` runs have gathered they are merged into
    one, the smallest doc_id of a fingerprint staying; after a crash in
    between both the merged run and its parts are read, which changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str, fan: int = 3, buckets: int | None = None, windows: bool = True):
        self.spark, self.root, self.fan = spark, root.rstrip("/"), fan
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[tuple[int, DataFrame, str, str]] = []
        self.windows, self.next = windows, 0
        path, files = hadoop_path(spark, self.root)
        folders = sorted(f.getPath().getName() for f in files.listStatus(path)) if files.exists(path) else []
        whole = [f for f in folders if files.exists(hadoop_path(spark, f"{self.root}/{f}/_SUCCESS")[0])]
        if whole:
            self.windows = "windows" in spark.read.parquet(f"{self.root}/{whole[0]}").columns
        for folder in folders:
            _, number, buckets_of = folder.split("-")
            self.next = max(self.next, int(number) + 1)
            if folder in whole:
                self.runs.append((int(number), *self._table(f"{self.root}/{folder}", int(buckets_of))))

    @property
    def columns(self) -> list[str]:
        return [*CONTEXT, "first", *(["windows"] if self.windows else [])]

    @property
    def schema(self) -> str:
        return RUN + (", windows BINARY" if self.windows else "")

    def _table(self, folder: str, buckets: int) -> tuple[DataFrame, str, str]:
        name = f"fingerprints_{uuid.uuid4().hex[:12]}"
        self.spark.sql(f"CREATE TABLE {name} ({self.schema}) USING parquet CLUSTERED BY (anchor) SORTED BY (anchor, context, check) INTO {buckets} BUCKETS LOCATION '{folder}'")
        return self.spark.table(name), name, folder

    def add(self, contexts: DataFrame, stage: Stage | None = None) -> None:
        """stage: where contexts are staged; they go as soon as they are a run, before runs are compacted."""
        self._write(self._dealt(contexts))
        if stage is not None:
            stage.drop(contexts)
        if len(self.runs) >= self.fan:
            self.compact()

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.columns).repartition(self.buckets, "anchor")

    def _write(self, rows: DataFrame) -> None:
        """rows: dealt by anchor."""
        number, self.next = self.next, self.next + 1
        folder, name = f"{self.root}/run-{number:06d}-{self.buckets}", f"fingerprints_{uuid.uuid4().hex[:12]}"
        rows.write.format("parquet").bucketBy(self.buckets, "anchor").sortBy(*CONTEXT).option("path", folder).saveAsTable(name)
        let_go(self.spark)
        self.runs.append((number, self.spark.table(name), name, folder))

    def merged(self) -> DataFrame:
        """All runs as one: the shuffle by anchor serves the grouping and the buckets."""
        return first_holders(self._dealt(self.read()), self.windows)

    def compact(self) -> None:
        old = list(self.runs)
        self._write(self.merged())
        self.runs = self.runs[len(old) :]
        for *_, name, folder in old:
            self.spark.sql(f"DROP TABLE {name}")
            path, files = hadoop_path(self.spark, folder)
            files.delete(path, True)

    def read(self) -> DataFrame:
        """All runs' rows, as plain files: Spark takes a union of bucketed tables for bucketed, which it is not."""
        return self.spark.read.schema(self.schema).parquet(*(folder for *_, folder in self.runs))

    def held(self, anchors: DataFrame) -> DataFrame:
        """The runs' rows of some anchors, to be written: each run is merge-joined with them."""
        out = None
        for _, run, *_ in self.runs:
            own = run.join(anchors, "anchor", "left_semi")
            out = own if out is None else out.unionByName(own)
        return out

    def close(self) -> None:
        """Forget the runs' names; their files stay."""
        for _, _, name, _ in self.runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


RUN = "anchor BIGINT, context BIGINT, check BIGINT, first STRUCT<doc: BIGINT, key: BIGINT, lo: INT, hi: INT>"


def first_holders(df: DataFrame, windows: bool = False) -> DataFrame:
    """Of each context the first holder; its windows are the same in all."""
    return df.groupBy(*CONTEXT).agg(F.min("first").alias("first"), *([F.min("windows").alias("windows")] if windows else []))


def _found_in_batch(stage: Stage, index: FingerprintIndex, own: DataFrame, texts: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """doc, key, lo, end of what earlier documents hold of a batch's segments; and the batch's contexts, for the index.

    texts (doc, key, text, new) has the batch (new) and, unless the index keeps windows, all that is indexed.
    The shuffle files of a step go when it is done, so that those of a batch do not add up.
    """

    def write(df: DataFrame, label: str) -> DataFrame:
        out = stage.write(df, label)
        let_go(stage.spark)
        return out

    first, kept = F.struct("doc", "key", "lo", "hi"), [F.min("windows").alias("windows")] if index.windows else []
    new = write(own.groupBy(*CONTEXT).agg(F.min(first).alias("first"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("n"), *kept), "contexts")
    fresh = new.select(*CONTEXT, "first", "n", F.lit(True).alias("fresh"), (F.col("last") > F.col("first.doc")).alias("again"))
    known, old = fresh, None
    if index.runs:  # the merge-join of the batch with the runs
        old = write(index.held(new.select("anchor").distinct()), "old")
        known = fresh.unionByName(old.select(*CONTEXT, "first", F.lit(0).cast("long").alias("n"), F.lit(False).alias("fresh"), F.lit(True).alias("again")))
    # 1. whole segments that an earlier document holds; n: how many segments of the batch have the context
    holders = known.groupBy(*CONTEXT).agg(F.min("first.doc").alias("holder"), F.max("n").alias("n"), F.max("again").alias("again")).where("again AND n > 0").drop("again")
    holders = write(holders, "holders")
    whole = join_counted(own, holders, CONTEXT).where(F.col("holder") < F.col("doc")).select("doc", "key", "lo", (F.col("hi") + window).alias("end"))
    # 2. windows, where an anchor has several contexts in several documents
    open_anchors = (
        known.groupBy("anchor")
        .agg(F.min("context").alias("a"), F.max("context").alias("b"), F.min("first.doc").alias("d"), F.max("first.doc").alias("e"), F.max("fresh").alias("fresh"))
        .where("fresh AND a <> b AND d < e")
        .select("anchor")
    )
    lists = write(first_holders(known.join(open_anchors, "anchor", "left_semi")).groupBy("first.doc", "first.key").agg(F.collect_list(F.struct("first.lo", "first.hi")).alias("spans")), "open")
    found = _windows(texts.join(small_side(lists), ["doc", "key"]), window)
    if index.windows and old is not None:
        found = found.unionByName(_stored_windows(first_holders(old, True).join(open_anchors, "anchor", "left_semi")))
    windows = write(found, "windows")
    twice = write(windows.groupBy("w1", "w2").agg(F.min("doc").alias("holder"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("n")).where("holder < last").drop("last"), "twice")
    single = join_counted(windows.where("new"), twice, ["w1", "w2"]).where(F.col("holder") < F.col("doc")).select("doc", "key", "lo", (F.col("lo") + window).alias("end"))
    spans = write(whole.unionByName(single), "spans")
    stage.drop(lists, windows, twice, holders, *([old] if old is not None else []))
    return spans, new


def _by_row(spans: DataFrame, stage: Stage) -> DataFrame:
    """The different spans of each row: rows alike in doc_id and text have the same ones, however many they are."""
    return stage.write(spans.groupBy("doc", "key").agg(F.collect_set(F.struct("lo", "end")).alias("spans")), "removed")


def removed_spans(docs: DataFrame, window: int = 50, gram: int = 25, batches: int = 3, fan: int = 2) -> DataFrame:
    """doc, key, spans: the spans of words to remove from each row that has any; spans may overlap."""
    stage = Stage(docs.sparkSession, "substrings")
    root = f"{stage.root}/index"
    index = FingerprintIndex(docs.sparkSession, root, fan, windows=False)  # all texts are at hand
    edges = docs.select(F.percentile_approx(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), [i / batches for i in range(1, batches)], 1000)).first()[0] or [] if batches > 1 else []
    edges = sorted(set(edges))
    batch_of = F.aggregate(F.array(*map(F.lit, edges)), F.lit(0), lambda acc, e: acc + F.when(F.col("doc") > e, 1).otherwise(0)) if edges else F.lit(0)
    found = stage.write_by(segments(docs, window, gram).withColumn("batch", batch_of), "segments", "batch")
    parts = []
    for b in range(len(edges) + 1):
        texts = _numbered(docs).withColumn("new", F.col("doc") > edges[b - 1] if b else F.lit(True))
        spans, new = _found_in_batch(stage, index, found.where(F.col("batch") == b).drop("batch"), texts, window)
        parts.append(spans)
        stage.drop_part(found, f"batch={b}")
        if b < len(edges):
            index.add(new, stage)
        else:  # the index goes with the call: nothing looks for the last batch in it
            stage.drop(new)
    index.close()
    path, files = hadoop_path(docs.sparkSession, root)
    files.delete(path, True)
    out = _by_row(reduce(DataFrame.unionByName, parts), stage)
    stage.drop(found, *parts)
    return out


def dedup_batch(docs: DataFrame, index: FingerprintIndex, history: DataFrame | None = None, window: int = 50, gram: int = 25) -> DataFrame:
    """``dedup`` of a new batch against an index of earlier ones, to which the batch is added.

    Documents of the batch have larger doc_ids than the indexed ones; only the
    batch is changed.  An index that keeps windows (the default) needs no
    earlier text.  One without them needs history (doc_id, text), all rows of the
    earlier batches, once it has runs: without it this is an error.
    """
    if index.runs and not index.windows and history is None:
        raise ValueError("the index keeps no windows: the texts of the earlier batches are needed as history")
    stage = Stage(docs.sparkSession, "batch")
    texts = _numbered(docs).withColumn("new", F.lit(True))
    if history is not None and not index.windows:
        texts = texts.unionByName(_numbered(history).withColumn("new", F.lit(False)))
    own = stage.write(segments(docs, window, gram, index.windows), "segments")
    spans, new = _found_in_batch(stage, index, own, texts, window)
    stage.drop(own)
    index.add(new, stage)
    out = _by_row(spans, stage)
    stage.drop(spans)
    return _without(docs, out)


def dedup(docs: DataFrame, window: int = 50, gram: int = 25, batches: int = 3) -> DataFrame:
    """Every row of docs with n_words, n_removed and kept, the words left joined by one space.

    Words are ``[^\\x20\\x09-\\x0D]+``; a null text has none and keeps the empty
    string.  Windows are judged on the input, not on what is left.  Rows with
    a null doc_id come after all others and do not remove from one another,
    nor do rows that share a doc_id.  An empty table gives no rows.  Other
    columns are passed on, but for the names doc, key, spans, n_words,
    n_removed and kept, which this operator takes.
    """
    if not 0 < gram <= window:
        raise ValueError("a gram is within the window")
    return _without(docs, removed_spans(docs.select("doc_id", "text"), window, gram, batches))


def _without(docs: DataFrame, spans: DataFrame) -> DataFrame:
    taken = {"doc", "key", "spans", "n_words", "n_removed", "kept"}
    own = docs.drop(*taken).withColumns({"doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), "key": F.xxhash64("text")})
    joined = own.join(small_side(spans), ["doc", "key"], "left").drop("doc", "key")
    names = [c for c in joined.columns if c not in ("spans", "text")]

    def run(c: dict) -> pa.RecordBatch:
        total, gone, kept = [], [], []
        for text, spans in zip(c["text"].to_pylist(), c["spans"].to_pylist(), strict=True):
            words = word_list(text)
            total.append(len(words))
            if spans:
                hit = np.zeros(len(words) + 1, np.int32)
                np.add.at(hit, [s["lo"] for s in spans], 1)
                np.add.at(hit, [s["end"] for s in spans], -1)
                left = np.flatnonzero(np.cumsum(hit)[:-1] == 0)
                words = [words[i] for i in left]
            gone.append(total[-1] - len(words))
            kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        return pa.RecordBatch.from_arrays([*(c[n] for n in names), c["text"], pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], [*names, "text", "n_words", "n_removed", "kept"])

    schema = joined.select(*(f"`{n}`" for n in names), "text").withColumns({"n_words": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "kept": F.lit("")}).schema
    return map_batches(joined.select(*(f"`{n}`" for n in names), "text", "spans"), run, schema)
