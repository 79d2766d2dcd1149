"""The corpus operators against brute force, on the smallest documents and on awkward rows."""

import collections
import functools
import hashlib
import math
import os
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from merchlake.llm import graded_quality, languages, line_runs, near_duplicates, neighbours, packing, piece_tokens, quality_rules, substrings, token_counts
from merchlake.llm.byte_tokens import ByteTokens
from merchlake.llm.common import Stage
from merchlake.llm.queries import tokenizer_file

DATA = "/root/testdata/sf0.001"
BYTES, PIECES = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc string, key int, spans int, kept string, rank int"

LONG = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
AWKWARD = [
    (1, None, "en"), (2, "", "en"), (3, "   \n\t ", None), (4, "one two", "en"), (5, "one two", "en"), (6, LONG, "en"), (7, LONG + " tail", None),
    (8, "a b c\na b c\na b c", "fr"), (None, "null id", "en"), (9, "漢字 é 😀 \x00 ▁x", "xx"), (9, "漢字 é 😀 \x00 ▁x", "xx"), (10, "  lead and  double ", "en"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, la, "s", 0, "x", 1, 2, "y", 3) for i, t, la in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def awkward(spark):
    return frame(spark, AWKWARD)


@pytest.fixture(scope="module")
def nothing(spark):
    return frame(spark, [])


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


# --- near-duplicates -----------------------------------------------------------


def weighted(t):
    w = words(t)
    c = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])
    c = {k: 1 + math.log(v) for k, v in c.items()}
    s = sum(c.values())
    return {k: v / s for k, v in c.items()}


def prob_jaccard(a, b):
    return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in a.keys() | b.keys()) for d in a.keys() & b.keys())


def test_exact_similarity_equals_its_definition():
    rng = random.Random(5)
    for _ in range(30):
        a, b = (" ".join(rng.choice("abcd") for _ in range(rng.randint(5, 60))) for _ in range(2))
        got = near_duplicates.prob_jaccard(*near_duplicates.shingles(a), *near_duplicates.shingles(b))
        assert got == pytest.approx(prob_jaccard(weighted(a), weighted(b)), abs=1e-9)


def test_registers_estimate_the_similarity():
    rng = random.Random(6)
    base = [f"w{i}" for i in range(300)]
    other = [x if rng.random() > 0.03 else x + "!" for x in base]
    sets = [near_duplicates.shingles(" ".join(x)) for x in (base, other)]
    owner = np.repeat([0, 1], [len(s[0]) for s in sets])
    sig = near_duplicates.prob_minhash(np.concatenate([s[0] for s in sets]), near_duplicates.weigh(np.concatenate([s[1] for s in sets])), owner, 2, 2000)
    assert (sig[0] == sig[1]).mean() == pytest.approx(near_duplicates.prob_jaccard(*sets[0], *sets[1]), abs=0.04)


def test_classes(docs, texts):
    sets = {i: weighted(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    held = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            held[g].append(i)
    near = {(a, b) for v in held.values() for a in v for b in v if a < b}
    for a, b in near:
        if len(sets[a].keys() & sets[b].keys()) * 2 > min(len(sets[a]), len(sets[b])) and prob_jaccard(sets[a], sets[b]) >= 0.8:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.doc_id: r.class_id for r in near_duplicates.classes(docs).collect()}
    assert got == {i: find(i) for i in texts}


def test_classes_of_a_chain_and_a_crowd(spark):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(120):  # one crowd around one text, and texts that drift away from it step by step
        t = list(base)
        for _ in range(2):
            t[rng.randrange(200)] = f"e{i}{rng.random()}"
        rows.append((i, " ".join(t), "en"))
    for i in range(120, 140):
        base[(i - 120) * 4] = f"d{i}"
        rows.append((i, " ".join(base), "en"))
    got = near_duplicates.classes(frame(spark, rows)).collect()
    assert {r.class_id for r in got} == {0} and len(got) == 140


def test_classes_of_one_crowd_of_many_classes(spark, monkeypatch):
    rng = random.Random(10)
    base = [f"w{i}" for i in range(100)]
    words_of = []
    for _ in range(20):  # templates that differ in some words, some of them shared by several templates
        own = list(base)
        for at in rng.sample(range(100), 7):
            own[at] = f"t{at}x{rng.randrange(4)}"
        for _ in range(40):
            t = list(own)
            for at in rng.sample(range(100), rng.randint(0, 3)):
                t[at] = f"e{rng.randrange(10**6)}"
            words_of.append(t)
    order = rng.sample(range(len(words_of)), len(words_of))
    rows = [(i, " ".join(words_of[j]), "en") for i, j in enumerate(order)]
    sets = [{tuple(words(t)[k : k + 5]) for k in range(96)} for _, t, _ in rows]
    vocabulary = {g: i for i, g in enumerate({g for s in sets for g in s})}
    m = np.zeros((len(rows), len(vocabulary)), np.float32)
    for i, s in enumerate(sets):
        m[i, [vocabulary[g] for g in s]] = 1
    both = m @ m.T
    linked = both / (m.sum(1)[:, None] + m.sum(1) - both) >= 0.8
    want = np.arange(len(rows))
    for _ in range(len(rows)):
        new = np.where(linked, want, len(rows)).min(1)
        if (new == want).all():
            break
        want = new
    compared = []
    compare = near_duplicates._compare

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return compare(pairs, *rest)

    monkeypatch.setattr(near_duplicates, "_compare", counted)
    got = {r.doc_id: r.class_id for r in near_duplicates.classes(frame(spark, rows)).collect()}
    assert got == dict(enumerate(want.tolist())) and len(set(got.values())) > 10
    assert sum(compared) < len(rows) * len(rows) / 10, compared


def test_differing_bits_never_exceed_differing_shingles():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 800)).astype(np.uint64))
        b = np.r_[a[: rng.integers(0, len(a) + 1)], rng.integers(0, 2**63, rng.integers(0, 300)).astype(np.uint64)]
        bits = int(np.bitwise_count((near_duplicates.bitmap(a) ^ near_duplicates.bitmap(b)).view(np.uint64)).sum())
        assert bits <= len(np.setxor1d(a, b))


def test_classes_of_awkward_rows(awkward, nothing):
    got = {r.doc_id: r.class_id for r in near_duplicates.classes(awkward).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 6, 8: 8, 9: 9, 10: 10, None: None}
    assert near_duplicates.classes(nothing).count() == 0


def test_a_hot_member_is_dealt_by_how_many_pairs_it_has(spark, monkeypatch):
    """1200 near-copies of one text are compared with its first member in several groups, and form one class."""
    from merchlake.llm.common import Stage

    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(1200):
        own = list(base)
        own[i % 300] = f"x{i}"
        rows.append((i, " ".join(own), "en"))
    seen = []
    write = Stage.write

    def watch(self, df, label="t"):
        out = write(self, df, label)
        if label == "hot":
            seen.extend(r.salts for r in out.collect())
        return out

    monkeypatch.setattr(Stage, "write", watch)
    got = near_duplicates.classes(frame(spark, rows)).collect()
    assert {r.class_id for r in got} == {0} and max(seen) == 3



# --- substrings ------------------------------------------------------------------


def removed(texts, window):
    first, out = {}, {}
    for i in sorted(texts):
        w = words(texts[i])
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            if first.setdefault(k, i) < i:
                gone[s : s + window] = [True] * window
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


@pytest.mark.parametrize("batches,window,gram", [(1, 50, 25), (4, 50, 25), (3, 12, 5)])
def test_substrings(spark, docs, texts, batches, window, gram):
    own = {i: t for i, t in texts.items() if len(t) < 20_000}
    # a passage on the edge of others, repeated words, and a document within another
    own |= {1000: "x y " + " ".join(words(own[max(own)])[:70]), 1001: "p q " * 60, 1002: "z " + "p q " * 60, 1003: " ".join(words(own[max(own)])[3:68])}
    df = spark.createDataFrame([*own.items()], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.dedup(df, window, gram, batches).collect()}
    assert got == removed(own, window)


def test_an_index_that_is_opened_again(spark, texts, tmp_path):
    own = {i: t for i, t in texts.items() if len(t) < 20_000}
    own |= {1000: "x y " + " ".join(words(own[max(own)])[:70]), 1001: "p q " * 60, 1002: "z " + "p q " * 60, 1003: " ".join(words(own[max(own)])[3:68])}
    df = spark.createDataFrame([*own.items()], "doc_id long, text string")
    parts = [df.where("doc_id < 60"), df.where("doc_id BETWEEN 60 AND 120"), df.where("doc_id BETWEEN 121 AND 1001"), df.where("doc_id > 1001")]
    got, history = {}, None
    for part in parts:  # each call opens what the last one left
        index = substrings.FingerprintIndex(spark, f"file://{tmp_path}/index", fan=3, windows=False)
        assert len(index.runs) < 3
        got |= {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.dedup_batch(part, index, history).collect()}
        index.close()
        history = part if history is None else history.unionByName(part)
    assert got == removed(own, 50)


def words_of(n, start=0):
    return " ".join(f"v{i}" for i in range(start, start + n))


def test_an_index_with_windows_needs_no_earlier_text(spark, texts, tmp_path):
    first = spark.createDataFrame([(1, "a b c " + words_of(70) + " d e f")], "doc_id long, text string")
    later = spark.createDataFrame([(2, words_of(70) + " x y z")], "doc_id long, text string")
    found = {}
    for windows in (True, False):
        index = substrings.FingerprintIndex(spark, f"file://{tmp_path}/{windows}", windows=windows)
        substrings.dedup_batch(first, index).count()
        if not windows:
            with pytest.raises(ValueError, match="history"):
                substrings.dedup_batch(later, index)
        found[windows] = substrings.dedup_batch(later, index, None if windows else first).first().n_removed
        index.close()
    assert found == {True: 70, False: 70}
    # and over several batches, opened again and compacted, without any history
    own = {i: t for i, t in texts.items() if len(t) < 20_000}
    own |= {1000: "x y " + " ".join(words(own[max(own)])[:70]), 1001: "p q " * 60, 1002: "z " + "p q " * 60, 1003: " ".join(words(own[max(own)])[3:68])}
    df, got = spark.createDataFrame([*own.items()], "doc_id long, text string"), {}
    for where in ("doc_id < 60", "doc_id BETWEEN 60 AND 120", "doc_id BETWEEN 121 AND 1001", "doc_id > 1001"):
        index = substrings.FingerprintIndex(spark, f"file://{tmp_path}/many", fan=3)
        assert index.windows
        got |= {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.dedup_batch(df.where(where), index).collect()}
        index.close()
    assert got == removed(own, 50)


def test_rows_that_repeat_cost_what_they_are(spark):
    rows = [(1, words_of(400))] + [(2, "q " + words_of(300, 50))] * 5000 + [(None, words_of(60))] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    spans = substrings.removed_spans(df).collect()
    assert max(len(r.spans) for r in spans) < 60  # those of one row
    got = collections.Counter((r.doc_id, r.n_words, r.n_removed) for r in substrings.dedup(df).collect())
    assert got == {(1, 400, 0): 1, (2, 301, 300): 5000, (None, 60, 60): 3}


def test_a_run_that_was_cut_off_is_left_aside(spark, tmp_path):
    docs_of = lambda i, start: spark.createDataFrame([(i, words_of(80, start))], "doc_id long, text string")
    open_ = lambda: substrings.FingerprintIndex(spark, f"file://{tmp_path}/i", fan=9, buckets=3)
    index = open_()
    substrings.dedup_batch(docs_of(1, 0), index).count()
    index.close()
    cut = tmp_path / "i" / "run-000001-3"
    cut.mkdir()
    (cut / "part-00000.parquet").write_bytes(b"half")
    for i, start, gone in ((2, 500, 0), (3, 0, 80), (4, 500, 80)):
        index = open_()
        assert substrings.dedup_batch(docs_of(i, start), index).first().n_removed == gone
        index.close()
    assert [r[0] for r in open_().runs] == [0, 2, 3, 4]


def test_runs_are_joined_where_they_lie(spark, tmp_path):
    index = substrings.FingerprintIndex(spark, f"file://{tmp_path}/index", fan=9, buckets=3, windows=False)
    rows = spark.range(1000).selectExpr("id AS anchor", "id AS context", "id AS check", "named_struct('doc', id, 'key', id, 'lo', 1, 'hi', 2) AS first")
    index.add(rows)
    index.add(rows)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = index.held(rows.where("anchor % 7 = 0").select("anchor"))
        assert found.count() == 2 * 143
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "Bucketed: true" in plan and plan.split("Initial Plan")[0].count("SortMergeJoin") == 2
    index.compact()
    assert [r[0] for r in index.runs] == [2] and index.read().count() == 1000
    index.close()


def test_steps_of_substrings_leave_no_disk_behind(spark, monkeypatch):
    rows = [(i, f"a{i} " + words_of(90, 20 * i) + f" z{i}") for i in range(30)]
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {f for f in manager.getAllFiles().mkString(" ").split() if "/shuffle_" in f}
    staged = lambda root: sorted(f.split("-", 1)[-1] for f in os.listdir(root.removeprefix("file://")))
    before, held, merging, roots = shuffles(), {}, [], set()
    write, compact = Stage.write_by, substrings.FingerprintIndex.compact

    def watch(self, df, label, *folders):
        end = time.time() + 5  # Spark removes them in the background
        while label in ("contexts", "old", "holders", "windows", "twice", "removed") and (left := shuffles() - before):
            if time.time() > end:
                held[label] = len(left)
                break
            time.sleep(0.05)
        roots.add(self.root)
        return write(self, df, label, *folders)

    def watch_index(self):
        merging.append(staged(self.root + "/.."))
        compact(self)

    monkeypatch.setattr(Stage, "write_by", watch)
    monkeypatch.setattr(substrings.FingerprintIndex, "compact", watch_index)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == removed(dict(rows), 50)
    assert not held  # shuffle files of the steps before; open and spans come after a count of rows, which is small
    assert merging == [["index", "segments", "spans", "spans"]]  # and the last batch's run is for nobody
    assert [staged(r) for r in roots] == [["removed"]]


def test_runs_are_merged_in_one_shuffle(spark, tmp_path):
    index = substrings.FingerprintIndex(spark, f"file://{tmp_path}/index", fan=9, buckets=3, windows=False)
    for last in (300, 200):
        index.add(spark.range(last).selectExpr("id AS anchor", "id AS context", "id AS check", f"named_struct('doc', id - {last}, 'key', id, 'lo', 1, 'hi', 2) AS first"))
    plan = index.merged()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    index.compact()
    assert {r.anchor: r.first.doc for r in index.read().collect()} == {i: i - 300 for i in range(300)}
    index.close()


def test_substrings_of_awkward_rows(awkward, nothing):
    rows = substrings.dedup(awkward).collect()
    assert len(rows) == len(AWKWARD)
    got = {r.doc_id: (r.n_words, r.n_removed) for r in rows}
    assert got[1] == (0, 0) and got[6] == (30_000, 0) and got[7] == (30_001, 30_000) and got[9][1] == 0
    assert {"lang", "source", "rank"} <= set(rows[0].asDict())
    assert substrings.dedup(nothing).count() == 0


# --- quality rules ------------------------------------------------------------------


def counts(t):
    w, t = words(t), t or ""
    tri = collections.Counter(zip(w, w[1:], w[2:]))
    cover = set()
    for i in range(len(w) - 2):
        if tri[w[i], w[i + 1], w[i + 2]] > 1:
            cover |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(cover))


def test_quality_counts(spark, docs, texts, awkward, nothing):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    for df, own in ((docs, texts), (awkward, None)):
        for r in quality_rules.judge(df, labels).collect():
            text = own[r.doc_id] if own else next(t for i, t, _ in AWKWARD if i == r.doc_id)
            c = counts(text)
            assert tuple(r[1:6]) == c
            assert r.base_failed == (c[0] < 50 or 100 * c[4] > 50 * c[0])
            assert not (r.base_failed and r.kept)
    assert quality_rules.judge(nothing, labels).count() == 0


def test_a_document_is_one_trial(spark):
    """Labels that repeat, and rows that repeat, change nothing; labels that disagree and rows that differ teach nothing."""
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(60)) + " #" * (i % 2) * 40, "en") for i in range(600)]
    labels = [(i, int(i % 2 == 0)) for i in range(600)]
    judged = lambda rs, ls: sorted((r.doc_id, r.kept) for r in quality_rules.judge(frame(spark, rs), spark.createDataFrame(ls, "doc_id long, quality int")).distinct().collect())
    once = judged(rows, labels)
    assert judged(rows, labels * 10) == once and judged(rows * 3, labels) == once
    few = labels[:120]
    assert all(k for _, k in judged(rows, few * 30))  # too few to reject anything, however often they are told
    assert all(k for _, k in judged(rows, labels + [(i, 1 - q) for i, q in labels]))
    assert [x for x in judged(rows + [(i, t + " more", la) for i, t, la in rows], labels) if not x[1]] == []


def test_binomial_tail():
    assert quality_rules.binomial_tail(2, 10, 0.3) == pytest.approx(sum(math.comb(10, i) * 0.3**i * 0.7 ** (10 - i) for i in range(3)))


def test_cutoffs_limit_false_rejection(spark):
    rng = np.random.default_rng(1)
    rows = [("s", bool(g), *(float(x) if r == 0 else 0.0 for r, x in enumerate([v] * 5))) for g, v in zip(rng.random(6000) < 0.8, rng.beta(2, 8, 6000))]
    rows = [(s, g, x if g else min(1.0, x + 0.5), *rest) for s, g, x, *rest in rows]
    cal = spark.createDataFrame(rows, "stratum string, good boolean, " + ", ".join(f"{r} double" for r in quality_rules.RULES))
    (found,) = quality_rules.thresholds(cal, alpha=0.1, delta=0.05).collect()
    assert found.rule == "symbol_share"
    assert np.mean([r[2] > found.cutoff for r in rows if r[1]]) <= 0.02
    assert np.mean([r[2] > found.cutoff for r in rows if not r[1]]) > 0.5
    few = cal.limit(50)
    assert quality_rules.thresholds(few).count() == 0


# --- neighbours -------------------------------------------------------------------


def test_neighbours(spark):
    v = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = v.collect()
    got = collections.defaultdict(list)
    for r in neighbours.nearest(v, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    x = {r.vec_id: np.array(r.embedding, np.float64) for r in rows}
    hit = 0
    for q in [i for i in x if i % 20 == 0]:
        want = sorted((float(np.sqrt(((x[q] - x[i]) ** 2).sum())), i) for i in x if i != q)[:10]
        hit += len({i for _, i in want} & {i for i, _ in got[q]}) / 10
        assert all(s == pytest.approx(float(np.sqrt(((x[q] - x[i]) ** 2).sum())), rel=1e-12) for i, s in got[q])
    assert hit / len(got) >= 0.9


def test_a_task_tells_the_best_of_all_its_lists_once():
    rng = np.random.default_rng(3)
    p = rng.integers(0, 4, (300, 3)).astype(float)  # many ties
    rows = [(g, n, 0, False, 1000 + q, q % 2, [float(q % 4), 1.0, 2.0]) for g in range(2) for n in range(6) for q in range(g * 5, g * 5 + 5)]
    rows += [(g, n, 0, True, i, i % 3, p[i].tolist()) for g in range(2) for n in range(6) for i in range(300) if i % 6 == n or i % 5 == n]  # some in two lists
    rows.sort(key=lambda r: r[:4])
    table = pa.table(dict(zip(("q", "list", "b", "its", "node", "f1", "v"), map(list, zip(*rows, strict=True)), strict=True)))
    got = [tuple(r.values()) for b in neighbours.nearest_of_task(iter(table.to_batches(max_chunksize=37)), 4) for r in b.to_pylist()]
    want = []
    for q in range(10):
        d = np.sqrt(((p - np.array([q % 4, 1, 2])) ** 2).sum(axis=1))
        want += [(1000 + q, q % 2, i, i % 3, d[i]) for i in sorted(range(300), key=lambda i: (d[i], i))[:4]]
    assert got == want


def test_neighbours_of_awkward_vectors(spark):
    rows = [(0, [1.0, 0.0])] + [(i, [1.0, 1.0]) for i in range(1, 40)] + [(100, [0.0, 0.0]), (101, None), (102, [1.0, float("nan")]), (103, [1.0, None]), (None, [1.0, 2.0]), (104, [1.0, 2.0, 3.0]), (0, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.nearest(df, F.col("vec_id").isin(0, 5)).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(0, i) for i in range(1, 11)] + [(5, i) for i in (1, 2, 3, 4, 6, 7, 8, 9, 10, 11)]
    assert [r["rank"] for r in got] == [*range(1, 11)] * 2
    few = neighbours.nearest(df.where("vec_id IN (0, 7)"), F.col("vec_id") == 0).collect()
    assert [(r.vec_id, r.score) for r in few] == [(7, 1.0)]
    assert neighbours.nearest(df.where("vec_id = 100"), F.col("vec_id") == 100).count() == 0
    # rows that share a vec_id are candidates each; a vector of another length has its like only
    shared = spark.createDataFrame([(1, [1.0, 0.0]), (1, [5.0, 5.0]), (2, [1.0, 1.0]), (3, [5.0, 6.0]), (4, [1.0, 2.0, 3.0]), (5, [1.0, 2.0, 4.0])], df.schema)
    near = lambda q: sorted((r["rank"], r.vec_id, round(r.score, 6)) for r in neighbours.nearest(shared, F.col("vec_id") == q, 2).collect())
    assert near(2) == [(1, 1, 1.0), (2, 1, 5.656854)] and near(3) == [(1, 1, 1.0), (2, 2, 6.403124)] and near(4) == [(1, 5, 1.0)]
    assert near(1) == [(1, 2, 1.0), (1, 3, 1.0), (2, 1, 6.403124), (2, 2, 5.656854)]


def test_blocks_of_hot_lists(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 7)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("vec_id") % 2 == 0, k=5, list_size=64).collect()
    for r in got:
        d = np.sqrt(((x - x[r.query_id]) ** 2).sum(1))
        d[r.query_id] = np.inf
        assert np.argsort(d)[r["rank"] - 1] == r.vec_id


def test_every_list_within_the_ratio_is_probed():
    x = np.random.default_rng(7).normal(size=(8000, 64))
    c = neighbours.centroids(x, 12)
    q = x[::400]
    d = np.sqrt(((q[:, None] - c) ** 2).sum(2))
    want = d <= 1.42 * d.min(1, keepdims=True)
    found = np.zeros_like(want)
    found[neighbours.CentroidGraph(c).within(q, 0.42, 64)] = True
    assert (want.sum(1) > 64).sum() >= 10 and (found == want).mean() > 0.9999


@pytest.mark.parametrize("clustered", [True, False])
def test_recall_and_share_read(spark, clustered, monkeypatch):
    rng = np.random.default_rng(7)
    n, many = 20_000, 400
    x = rng.normal(size=(n, 32))
    if clustered:
        x = 4 * rng.normal(size=(many, 32))[rng.integers(0, many, n)] + x
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    probed, lists = [], []
    within, init = neighbours.CentroidGraph.within, neighbours.CentroidGraph.__init__
    monkeypatch.setattr(neighbours.CentroidGraph, "__init__", lambda self, c, degree=24: (init(self, c, degree), lists.append(self))[0])
    fitted = neighbours.FittedRatio
    monkeypatch.setattr(neighbours, "FittedRatio", lambda *a: probed.append(fitted(*a)) or probed[-1])
    got = collections.defaultdict(set)
    for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0).collect():
        got[r.query_id].add(r.vec_id)
    hits, read = [], []
    g, (ratio,) = lists[0], probed
    rows, own = neighbours.replicate(g, x, 3, 0.1)
    sizes = np.bincount(own, minlength=len(g.c))
    for i in range(0, n, 100):
        d = ((x - x[i]) ** 2).sum(1)
        d[i] = np.inf
        hits.append(len(got[i] & set(np.argsort(d)[:10].tolist())) / 10)
        _, found = within(g, x[i : i + 1], ratio, 64)
        read.append(sizes[found].sum() / n)
    print(f"clustered {clustered}: {len(g.c)} lists, copies {len(rows) / n:.2f}, ratios {ratio.ratios.round(2)}, recall {np.mean(hits):.3f}, share read {np.mean(read):.3f}")
    assert np.mean(hits) >= 0.9 and {len(v) for v in got.values()} == {10} and len(got) == n // 100
    assert np.mean(read) < (0.2 if clustered else 1.0)


# --- languages ---------------------------------------------------------------------


def test_languages(docs, awkward, nothing):
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    out = languages.identify(docs, docs.where(~held)).join(docs.where(held).select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in out]) >= 0.97
    assert all(0 <= r.score <= 1 for r in out)
    got = {r.doc_id: (r.lang_pred, r.score) for r in languages.identify(awkward, docs).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] in {"en", "fr", "de", "es"}
    assert {r.lang_pred for r in languages.identify(awkward, nothing).collect()} == {"und"}
    assert languages.identify(nothing, docs).count() == 0


def test_mixture_of_two_languages(spark, docs, texts):
    by = {r.lang: r.text for r in docs.where("n_chars BETWEEN 1500 AND 4000").select("lang", "text").collect()}
    both = by["de"][:1200] + "\n" + by["en"][:1200]
    (r,) = languages.identify(frame(spark, [(1, both, None)]), docs).collect()
    shares = {m.lang: m.share for m in r.mixture}
    assert set(shares) >= {"de", "en"} and abs(shares["de"] - 0.5) < 0.15


def test_mixture_of_six_languages(spark):
    rng = random.Random(12)
    tongues = {f"l{i}": ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8))) for _ in range(80)] for i in range(8)}
    said = lambda x, n: " ".join(rng.choice(tongues[x]) for _ in range(n))
    training = frame(spark, [(i, said(x, 2000), x) for i, x in enumerate(tongues)])
    six = [f"l{i}" for i in (0, 2, 3, 5, 6, 7)]
    rows = [(1, "\n".join(said(x, 300) for x in six), None), (2, said("l4", 300), None), (3, said("l1", 200) + " " + said("l2", 200), None)]
    got = {r.doc_id: {m.lang: m.share for m in r.mixture} for r in languages.identify(frame(spark, rows), training).collect()}
    assert set(got[1]) == set(six) and all(abs(v - 1 / 6) < 0.05 for v in got[1].values())
    assert set(got[2]) == {"l4"} and set(got[3]) == {"l1", "l2"}


def test_mixtures_against_all_sets_of_languages(docs, texts):
    """Short texts of three languages against EM to the end over every set: the chosen set is as likely, or as good as, the best."""
    rng = random.Random(21)
    by = collections.defaultdict(list)
    for r in docs.collect():
        if r.text and len(r.text) < 20_000:
            by[r.lang] += re.findall(r"\w+", r.text)
    names = sorted(x for x in by if x)[:3]
    counts = np.stack([np.bincount(languages.trigrams(" ".join(by[x])), minlength=languages.BINS) for x in names])
    model = languages.Mixture(names, counts)
    rate = (counts + languages.SMOOTHING) / (counts + languages.SMOOTHING).sum(axis=1, keepdims=True)
    said = []
    for _ in range(120):
        own = rng.sample(names, rng.randint(1, 3))
        said.append(" ".join(" ".join(rng.choices(by[x], k=rng.randint(8, 40))) for x in own))
    same, worse = 0, 0
    for text, (lang, share, mixture) in zip(said, model.predict(said), strict=True):
        p = rate[:, languages.trigrams(text)].T * languages.BINS
        cost = languages.PENALTY * 0.5 * math.log(len(p))
        found = {}
        for bits in range(1, 8):
            own = [j for j in range(3) if bits >> j & 1]
            pi = np.full(len(own), 1 / len(own))
            for _ in range(300):
                r = p[:, own] * pi
                pi = (r / r.sum(axis=1, keepdims=True)).mean(axis=0)
            found[frozenset(own)] = (float(np.log(p[:, own] @ pi).sum()) - cost * (len(own) - 1), dict(zip(own, pi, strict=True)))
        best_set = max(found, key=lambda s: found[s][0])
        chosen = frozenset(names.index(x) for x, _ in mixture)
        worse += found[best_set][0] - found[chosen][0] > 0.5
        same += chosen == best_set
        if chosen == best_set:
            assert all(abs(v - found[chosen][1][names.index(x)]) < 0.05 for x, v in mixture) and share == pytest.approx(max(v for _, v in mixture), abs=1e-6) and lang == mixture[0][0]
    assert worse == 0 and same >= 115, (same, worse)


# --- lines -----------------------------------------------------------------------


@functools.cache
def _runs(items, least):
    texts = dict(items)
    lines = {i: t.split("\n") for i, t in texts.items()}
    src, k = {}, 0
    while True:
        first, found = {}, False
        for i in sorted(texts):
            for p in range(len(lines[i]) - (1 << k) + 1):
                block = tuple(lines[i][p : p + (1 << k)])
                if all(words(x) for x in block):
                    if block in first:
                        src[i, p], found = first[block], True
                    else:
                        first[block] = (i, p)
        if not found:
            break
        k += 1
    out = {}
    for i in texts:
        own = []
        for p in range(len(lines[i])):
            if (i, p) in src and ((i, p - 1) not in src or (src[i, p - 1][0], src[i, p - 1][1] + 1) != src[i, p]):
                j, q = src[i, p]
                n = 0
                while p + n < len(lines[i]) and q + n < len(lines[j]) and lines[i][p + n] == lines[j][q + n] and words(lines[i][p + n]):
                    n += 1
                own += [(p, n)] if n >= least else []
        gone = {x for p, n in own for x in range(p, p + n)}
        kept = "\n".join(x for p, x in enumerate(lines[i]) if p not in gone)
        out[i] = (len(lines[i]), len(gone), len(own), max((n for _, n in own), default=0), kept if not gone or words(kept) else None)
    return out


def runs(texts, least=1):
    return _runs(tuple(texts.items()), least)


def test_line_runs(spark, docs, texts):
    own = texts | {1000: "a\nb\nc\nd\ne", 1001: "x\nb\nc\nd\ny\na\nb", 1002: "r\n" * 9 + "s", 1003: "\n\nb\n\nc\n"}
    df = spark.createDataFrame([*own.items()], "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_removed, r.n_runs, r.longest_run, r.kept) for r in line_runs.dedup(df, 1).collect()}
    assert got == runs(own)
    for r in line_runs.dedup(df).collect():  # runs of two lines or more
        assert (r.n_lines, r.n_removed, r.n_runs, r.longest_run, r.kept) == runs(own, 2)[r.doc_id]


def test_frequent_and_rare_keys_join_alike(spark, tmp_path):
    rows = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN -1 ELSE id DIV 4 END AS k")
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    keyed = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1")
    assert keyed.where(F.col("n") * line_runs.HOT < 5000).count() and keyed.where(F.col("n") * line_runs.HOT >= 5000).count()
    got = sorted(map(tuple, line_runs.join_counted(rows, keyed, ["k"]).collect()))
    assert got == sorted(map(tuple, rows.join(keyed, "k").drop("n").collect()))


def test_lines_of_awkward_rows(awkward, nothing):
    rows = line_runs.dedup(awkward, 1).collect()
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in rows}
    assert len(rows) == len(AWKWARD)
    assert got[1] == (0, 0, None) and got[2] == (1, 0, "") and got[5] == (1, 1, None) and got[8] == (3, 2, "a b c") and got[9][1] == 0
    assert line_runs.dedup(nothing).count() == 0 and line_runs.dedup(awkward).count() == len(AWKWARD)


def test_a_line_of_a_no_break_space_is_text(spark):
    df = spark.createDataFrame([(1, "a\nb"), (2, "a\nb\n\xa0"), (3, "a\nb\n \t")], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in line_runs.dedup(df).collect()} == {1: "a\nb", 2: "\xa0", 3: None}


def test_runs_of_two_lines_or_more(spark):
    df = spark.createDataFrame([(1, "a\nb\nc"), (2, "c\nx\na\nb")], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in line_runs.dedup(df, 2).collect()} == {1: "a\nb\nc", 2: "c\nx"}


# --- packing ------------------------------------------------------------------------


def check_packing(rows, texts, capacity):
    tok = Tokenizer.from_file(BYTES)
    full = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts.items()}
    seen, bins = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        ids = np.array(full[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(ids) and 0 < r.length <= capacity
        seen[r.doc_id].append((r.piece, r.start, r.length))
        bins[r.sequence_id].append((r.offset, r.length))
    for i, ids in full.items():
        at = 0
        for n, (piece, start, length) in enumerate(sorted(seen[i])):
            assert (piece, start) == (n, at) and (length == capacity or n == 0)
            at += length
        assert at == len(ids)
        assert len(ids) > capacity or len(seen[i]) == 1
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(map(len, full.values()))


def test_packing(docs, texts):
    n, tokens = check_packing(packing.pack(docs, BYTES).collect(), texts, 1024)
    assert n <= 1.02 * -(-tokens // 1024) + 1


def test_packing_of_awkward_rows(spark, nothing):
    own = {i: t for i, t, _ in AWKWARD if i is not None}
    df = frame(spark, [(i, t, "en") for i, t in own.items()])
    check_packing(packing.pack(df, BYTES).collect(), own, 1024)
    assert packing.pack(nothing, BYTES).count() == 0


def test_reduction_and_best_fit_are_near_the_optimum():
    rng = random.Random(2)
    for _ in range(200):
        sizes = [rng.randint(1, 20) for _ in range(rng.randint(1, 8))]
        patterns, info = packing.reduce_and_pack(collections.Counter(sizes), 20)
        used = collections.Counter()
        for p, n in patterns:
            assert sum(p) <= 20
            used.update({s: c * n for s, c in collections.Counter(p).items()})
        assert used == collections.Counter(sizes)
        assert info["sequences"] <= best(sizes, 20) + 1
        if info["fixed"] == len(sizes):
            assert info["sequences"] == best(sizes, 20)


def test_the_reduction_loses_no_optimum():
    """What it fixes and an optimal packing of the rest are an optimal packing of all."""
    rng, fixed_some = random.Random(5), 0
    for _ in range(400):
        capacity = rng.choice([7, 12, 20])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        fixed, left = packing.reduce(collections.Counter(sizes), capacity)
        rest = [s for s, n in left.items() for _ in range(n)]
        assert sum(n for _, n in fixed) + (best(rest, capacity) if rest else 0) == best(sizes, capacity)
        assert collections.Counter(rest) + collections.Counter(s for p, n in fixed for s in p * n) == collections.Counter(sizes)
        fixed_some += 0 < len(rest) < len(sizes)
    assert fixed_some > 20


def best(sizes, capacity):
    sizes = sorted(sizes, reverse=True)

    def fits(bins, k):
        if k == len(sizes):
            return True
        tried = set()
        for i, room in enumerate(bins):
            if room >= sizes[k] and room not in tried:
                tried.add(room)
                bins[i] -= sizes[k]
                if fits(bins, k + 1):
                    return True
                bins[i] += sizes[k]
        return False

    n = -(-sum(sizes) // capacity)
    while not fits([capacity] * n, 0):
        n += 1
    return n


# --- tokens ------------------------------------------------------------------------


ALPHABET = [" ", "  ", "\n", "a", "b", "é", "漢", "😀", "the", "▁", "ing", "\t", "\x00", "1", "22", ".", "--", "▁▁", "Über", "\xa0", "ﬀ", "​", "'s", "\x1c", "\x85", "<|endoftext|>", "<s>"]


def random_texts(n):
    rng = random.Random(11)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_byte_tokens_of_single_spaces_are_made_in_one_call():
    own, whole = (ByteTokens(tokenizer_file("byte_bpe_50k.json")) for _ in range(2))
    own._whole, calls, units = None, [], own.units
    own.units = lambda text: calls.append(text) or units(text)
    texts = ["it's a\x00b\nwe'll 1 2three é ñ'd ٣ 😀 x😀", "a'lls ſ's x'S a\u200bb a \u0301b", " a\n'", "aa" * 5000]
    assert [own.ids(x) for x in texts] == [whole._whole(x) for x in texts]
    assert calls == texts



def test_byte_tokens_equal_the_library(texts):
    own = ByteTokens(BYTES)
    for t in [*random_texts(4000), *texts.values()]:
        assert own.ids(t) == np.array(own.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_added_tokens_are_recognised(spark):
    lib, own = Tokenizer.from_file(BYTES), ByteTokens(BYTES)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>\n<|endoftext|>y", "<|endoftext", *random_texts(500)]
    for t in texts:
        assert own.ids(t) == np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    assert lib.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    df = frame(spark, [(1, "a <|endoftext|> b\nc", "en")])
    assert [r.n_tokens for r in token_counts.token_counts(df, BYTES).orderBy("section").collect()] == [5, 1]
    (r,) = packing.pack(df, BYTES).collect()
    assert r.ids_crc32 == zlib.crc32(np.array([*lib.encode("a <|endoftext|> b\nc", add_special_tokens=False).ids, 2], "<u4").tobytes())


def test_piece_tokens_equal_the_library(texts):
    own = piece_tokens.PieceTokens(PIECES)
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for t in [*random_texts(4000), *texts.values()]:
        ids = lib.encode(t)
        assert own.encode(t) == ids
        assert own.decode(ids) == lib.decode(ids)
        assert own.digest(t) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest())


def test_piece_tokens_of_long_runs():
    own = piece_tokens.PieceTokens(PIECES)
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(4)
    letters, signs = ("".join(rng.choice(x) for _ in range(50_000)) for x in ("etaoinshr", [chr(c) for c in range(0x4E00, 0x4F00)]))
    for t in (" " * 100_000, "  " + letters, letters, "  " + signs, "=" * 20_000, "a" + " " * 5000 + "b", "-- " * 3000):
        ids = lib.encode(t)
        assert own.encode(t) == ids and own.decode(ids) == lib.decode(ids)
    assert all(len(k) <= 64 for cache in (own.words, own.told) for k in cache)


def test_piece_queries(docs, awkward, nothing):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in piece_tokens.encode(awkward, PIECES).collect():
        text = next(t for i, t, _ in AWKWARD if i == r.doc_id)
        assert r.ids == lib.encode(text or "") and r.decoded == lib.decode(r.ids)
    assert piece_tokens.digests(nothing, PIECES).count() == 0


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(docs, texts, awkward, nothing, rule):
    tok = Tokenizer.from_file(BYTES)
    got = collections.defaultdict(list)
    for r in token_counts.token_counts(docs, BYTES, rule).collect():
        got[r.doc_id].append(r)
    for i, t in texts.items():
        e = tok.encode(t, add_special_tokens=False)
        assert sum(r.n_tokens for r in got[i]) == pytest.approx(len(e.ids))
        own = sorted(got[i], key=lambda r: r.section)
        assert "".join(t[r.start : r.stop] for r in own) == t
        if rule == "first":
            want = collections.Counter(next(r.section for r in own if r.start <= a < r.stop) for a, _ in e.offsets)
            assert {r.section: r.n_tokens for r in own if r.n_tokens} == want
    rows = token_counts.token_counts(awkward, BYTES, rule).collect()
    assert {r.doc_id for r in rows} == {i for i, t, _ in AWKWARD if t is not None}
    assert token_counts.token_counts(nothing, BYTES, rule).count() == 0


def test_tokens_across_edges(spark):
    df = spark.createDataFrame([(1, "hello world")], "doc_id long, text string")  # "hello", " world"
    spans = spark.createDataFrame([(1, 7, 0, 7), (1, 8, 7, 11)], "doc_id long, section long, start long, stop long")
    got = {rule: {r.section: r.n_tokens for r in token_counts.token_counts(df, BYTES, rule, spans).collect()} for rule in token_counts.RULES}
    assert got == {"first": {7: 2.0, 8: 0.0}, "most": {7: 1.0, 8: 1.0}, "split": {7: pytest.approx(1 + 2 / 6), 8: pytest.approx(4 / 6)}}


# --- graded quality --------------------------------------------------------------------


def test_gradient_is_the_derivative():
    rng = np.random.default_rng(4)
    n = 1 << graded_quality.BITS
    params = np.r_[np.zeros(n), -0.5, 0.3]
    bins, row, grade = rng.integers(0, 5, 40).astype(np.int32), np.sort(rng.integers(0, 12, 40)), rng.integers(0, 3, 12)
    params[:5] = rng.normal(size=5)
    loss = lambda p: graded_quality.Ordinal(p, 3).loss(bins, row, grade)
    g = loss(params)[1]
    for i in (0, 3, n, n + 1):
        step = np.zeros_like(params)
        step[i] = 1e-6
        assert g[i] == pytest.approx((loss(params + step)[0] - loss(params - step)[0]) / 2e-6, rel=1e-4, abs=1e-6)


def test_grades(spark, nothing, awkward):
    rng = random.Random(9)
    plain = [f"w{i}" for i in range(60)]
    rows, grades = [], []
    for i in range(600):
        g = i % 3
        t = rng.sample(plain, 25) + (["junk"] if g == 0 else ["rude"] if g == 1 else [])
        rng.shuffle(t)
        rows.append((i, " ".join(t), "en"))
        grades.append((i, g))
    df = frame(spark, rows)
    ratings = spark.createDataFrame(grades, "doc_id long, grade long")
    out = graded_quality.grade_documents(df, ratings.where("doc_id < 400")).collect()
    assert np.mean([r.kept == (r.doc_id % 3 == 2) for r in out if r.doc_id >= 400]) > 0.97
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.tail_probability <= 1 for r in out)
    assert graded_quality.grade_documents(nothing, ratings).count() == 0
    assert all(r.kept for r in graded_quality.grade_documents(awkward, ratings.limit(0)).collect())
    assert len(graded_quality.grade_documents(awkward, ratings).collect()) == len(AWKWARD)
    # grades out of range, null grades and those of a doc_id that several rows share teach nothing
    odd = ratings.unionByName(spark.createDataFrame([(1, -1), (2, None), (3, 10**6), (None, 1)], ratings.schema))
    key = lambda x: sorted((r.doc_id, round(r.expected_grade, 9)) for r in x.collect())
    assert key(graded_quality.grade_documents(df, odd)) == key(graded_quality.grade_documents(df, ratings))
    twice = df.unionByName(df.where("doc_id < 300"))
    assert key(graded_quality.grade_documents(twice, ratings).distinct()) == key(graded_quality.grade_documents(df, ratings.where("doc_id >= 300")))


def test_the_sample_of_ratings_is_bounded(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, f"{'good' if i % 4 else 'bad'} " + " ".join(f"w{rng.randrange(50)}" for _ in range(12)), "en") for i in range(3000)]
    ratings = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(3000)], "doc_id long, grade long")
    taught = []
    count = graded_quality.grade_counts

    def counted(rated, grades):
        taught.append(rated.count())
        return count(rated, grades)

    monkeypatch.setattr(graded_quality, "grade_counts", counted)
    out = graded_quality.grade_documents(frame(spark, rows), ratings, sample=1000).collect()
    assert 900 < taught[0] <= 1000
    # the mark of the grade that holds most rows is learned too
    assert np.mean([r.kept == (r.doc_id % 4 > 0) for r in out]) > 0.99


def test_fit_equals_a_plain_newton_search(spark):
    rng = np.random.default_rng(6)
    x = rng.random((300, 4)) < 0.4
    grade = np.clip(np.round(x @ [1.2, -0.8, 0.5, 0.0] + rng.normal(size=300) + 0.7), 0, 2).astype(int)
    df = spark.createDataFrame([(int(g), np.flatnonzero(r).tolist()) for g, r in zip(grade, x, strict=True)], "grade long, bins array<int>").repartition(3)
    n, by = graded_quality.grade_counts(df, 3)
    assert n.tolist() == np.bincount(grade, minlength=3).tolist() and by[:, :4].tolist() == [x[grade == g].sum(0).tolist() for g in range(3)]
    got = graded_quality.fit(df, n, by, l2=1.0, steps=200)

    def loss(p):  # weights, first threshold, second threshold
        s = x @ p[:4]
        low = 1 / (1 + np.exp(-(np.array([p[4], p[5]]) - s[:, None])))
        prob = np.column_stack([low[:, 0], low[:, 1] - low[:, 0], 1 - low[:, 1]])[np.arange(300), grade]
        return 0.5 * (p[:4] ** 2).sum() - np.log(prob).sum()

    p, e = np.array([0, 0, 0, 0, -0.5, 0.5]), 1e-4 * np.eye(6)
    for _ in range(30):
        g = np.array([(loss(p + d) - loss(p - d)) / 2e-4 for d in e])
        h = np.array([[(loss(p + a + b) - loss(p + a - b) - loss(p - a + b) + loss(p - a - b)) / 4e-8 for b in e] for a in e])
        p = p - np.linalg.solve(h, g)
    assert got.weights[:4] == pytest.approx(p[:4], abs=0.02) and got.thresholds == pytest.approx(p[4:], abs=0.02)
