"""Mixture packing, vector codes and resampling against plain versions, on the smallest tables and on awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from merchlake.llm import mixture_packing, resampling, vector_codes
from merchlake.llm.queries import tokenizer_file
from merchlake.llm.word_tokens import WordTokens

DATA = "/root/testdata/sf0.001"
WORDS = tokenizer_file("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, source string, bucket int, row string, queue int, words string, part string, rank int, label string"
LONG = " ".join(f"w{i % 997}X{i}" for i in range(20_000))
AWKWARD = [(1, None, "a"), (2, "", None), (3, " \n\t ", "a"), (4, "One two é漢字 É", "b"), (5, "One two é漢字 É", "b"), (5, "One two é漢字 É", "b"), (6, LONG, "a"), (7, LONG + " tail", None), (None, "null id " * 30, "c"), (8, "x " * 25, "a"), (9, "x " * 25, "a"), (9, "x " * 25, "a")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "r", 2, "w", "p", 3, "l") for i, t, s in rows], SCHEMA)


# --- resampling ------------------------------------------------------------------


def resampled(docs, target, longest=1, buckets=10_000, seed=2024, percent=10, least=20):
    def features(t):
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    own, aims = [features(t) for _, t in docs], [features(t) for t in target]
    s, t = (collections.Counter(b for _, f in x for b in f) for x in (own, aims))
    total_s, total_t = sum(s.values()), sum(t.values())
    out = []
    for (doc, _), (n_words, f) in zip(docs, own, strict=True):
        weight = sum(math.floor(1000 * math.log((t[b] + 1.0) * (total_s + buckets) / ((s[b] + 1.0) * (total_t + buckets)))) for b in f)
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    drawable = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(drawable[: percent * len(drawable) // 100]):
        r[4] = i + 1
    return sorted(map(repr, (tuple(r[:5]) for r in out)))


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_equals_a_plain_version(spark, longest):
    docs, target = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    got = resampling.resample(docs, target, longest=longest)
    assert sorted(repr(tuple(r)) for r in got.collect()) == resampled([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], longest)


@pytest.mark.parametrize("percent", [0, 50, 100])
def test_resampling_of_awkward_rows(spark, percent):
    target = spark.createDataFrame([("One two",), (None,), ("",), ("x y",)], "text string")
    got = resampling.resample(frame(spark, AWKWARD), target, longest=2, buckets=64, percent=percent)
    assert sorted(repr(tuple(r)) for r in got.collect()) == resampled([r[:2] for r in AWKWARD], ["One two", None, "", "x y"], 2, 64, percent=percent)


def test_resampling_of_nothing(spark):
    target = spark.createDataFrame([], "text string")
    assert resampling.resample(frame(spark, []), target).collect() == []
    assert sorted(repr(tuple(r)) for r in resampling.resample(frame(spark, AWKWARD), target).collect()) == resampled([r[:2] for r in AWKWARD], [])


def test_resampling_stays_in_the_jvm(spark):
    from merchlake.llm.common import Stage

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    own = docs.select(resampling.words(F.col("text")).alias("words")).select(resampling.buckets_of(F.col("words"), 2, 10_000).alias("buckets"))
    table = resampling.gains(Stage(spark, "t"), own, own, 10_000)
    plan = own.select(F.explode("buckets").alias("bucket")).join(F.broadcast(table), "bucket")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan


def test_a_hot_key_is_ranked_by_many_tasks(spark):
    """A third of all rows share doc_id, text and so score: they take neighbouring ranks, and the ranks are still dense."""
    rows = frame(spark, [(1, "x " * 25, "a")] * 300 + [(i, f"y{i} " * 25, "a") for i in range(2, 600)])
    got = resampling.resample(rows, spark.createDataFrame([("x x x",)], "text string"), percent=100)
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, 899))
    copies = sorted(r["rank"] for r in got.where("doc_id = 1").collect())
    assert copies == list(range(copies[0], copies[0] + 300))


# --- vector codes ------------------------------------------------------------------


def coded(rows, scale=1024, parts=4, entries=256, rounds=4):
    """As the contract says it, one pair at a time in whole numbers."""
    kept = [(i, v, la) for i, v, la in rows if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)]
    kept = sorted(((i, [math.floor(scale * float(np.float32(x))) for x in v], la) for i, v, la in kept), key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<i4").tobytes()))
    if not kept:
        return [], None
    d = len(kept[0][1])
    kept = [(i, v + [0] * (-d % parts), la) for i, v, la in kept if len(v) == d]
    w = len(kept[0][1]) // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        new = [list(b) for b in books]
        for p in range(parts):
            held = collections.defaultdict(list)
            for c in cut:
                held[near(c[p], books[p])[1]].append(c[p])
            for e, xs in held.items():
                new[p][e] = [sum(col) // len(xs) for col in zip(*xs, strict=True)]
        books = new
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(f[0] for f in fs) for fs in found]
    by_label = collections.Counter()
    for (_, _, la), e in zip(kept, errors, strict=True):
        by_label[la] += e
    digest = hashlib.sha256(",".join(str(y) for b in books for c in b for y in c).encode()).hexdigest()
    return sorted(repr((i, "".join(f"{f[1]:02x}" for f in fs), e, by_label[la], digest)) for (i, _, la), fs, e in zip(kept, found, errors, strict=True)), digest


VECTORS = "vec_id long, embedding array<float>, label int, v string, n int, dimension string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, la, "x", 1, "d") for i, v, la in rows], VECTORS)


def test_codes_equal_a_plain_version(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(0, 0.2, 8).astype(np.float32).tolist(), int(i) % 3 if i % 5 else None) for i in rng.permutation(400)]
    rows += [(400, rows[0][1], 7), (400, rows[1][1], 7), (None, rows[2][1], None), (401, rows[3][1], None)] + [(500 + i, [0.5] * 8, 1) for i in range(200)]
    got = vector_codes.codes(vectors(spark, rows).repartition(5), entries=32)
    assert sorted(repr(tuple(r)) for r in got.collect()) == coded(rows, entries=32)[0]


def test_codes_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [nan] * 6, 1), (4, [inf, 0.0, 0.0, 0.0, 0.0, 0.0], 1), (5, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (6, [0.1, -0.2, 0.3, -0.4, 0.5, -0.6], None), (7, [1.0] * 6, 2), (7, [1.0] * 6, 2), (8, [1.0] * 4, 2), (9, [0.0] * 6, None)]
    assert sorted(repr(tuple(r)) for r in vector_codes.codes(vectors(spark, rows)).collect()) == coded(rows)[0]
    assert vector_codes.codes(vectors(spark, [])).collect() == []
    assert vector_codes.codes(vectors(spark, rows[:5])).collect() == []
    far = [(10, [1e30] * 6, 1), (11, [3e5, 0.0, 0.0, 0.0, 0.0, 0.0], 1)]  # no exact distances
    assert vector_codes.codes(vectors(spark, rows + far[:1])).count() == 4


def test_nearest_is_exact(spark):
    rng = random.Random(3)
    for most in (2, 50, 5_000, 2**24 + 9, vector_codes.largest(16)):
        x = np.array([[rng.randint(-most, most) for _ in range(16)] for _ in range(300)], np.int64)
        book = np.concatenate([x[rng.randrange(300)][None] + rng.randint(0, 1) * (rng.randrange(16) == np.arange(16)) for _ in range(40)] + [x[:8], x[:8]])
        index, distance = vector_codes.nearest(x, book)
        for i in range(0, 300, 7):
            plain = [sum((int(a) - int(b)) ** 2 for a, b in zip(x[i], c, strict=True)) for c in book]
            assert (distance[i], index[i]) == (min(plain), plain.index(min(plain)))


def test_float32_alone_would_err():
    """Distances that differ by less than float32 can tell: the screening keeps both, the second look decides."""
    book = np.array([[2**24, 0, 0, 1], [2**24, 0, 0, 0]], np.int64)
    index, distance = vector_codes.nearest(np.array([[2**24, 0, 0, 0], [2**24, 0, 0, 2]], np.int64), book)
    assert index.tolist() == [1, 0] and distance.tolist() == [0, 1]


# --- mixture packing ------------------------------------------------------------------


def library_ids(texts, end=1):
    t = Tokenizer.from_file(WORDS)
    return [t.encode(x or "", add_special_tokens=False).ids + [end] for x in texts]


def test_word_ids_equal_the_library(spark):
    rng = random.Random(11)
    alphabet = ["a", "B", "é", "é", "İ", "ß", "Σ", "ς", "漢", "7", "42", "'s", "'LL", "don't", "...", "<|endoftext|>", "<|startoftext|>", "<|end", "\t", "\r\n", "\n", " ", "  ", " ", " ", "\u0085", "\x1c", "\x00", "​", "😀", "ﬁ", "K", "́", "▁", "_", "-"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()] + [LONG, "x" * 100_000, " " * 100_000, None, ""]
    enc, t = WordTokens(WORDS), Tokenizer.from_file(WORDS)
    for x in texts:
        assert np.frombuffer(enc.ids(x), enc.kind).tolist() == t.encode(x or "", add_special_tokens=False).ids


def check_pieces(pieces, docs, capacity):
    """Every id once, the right digests, no gaps, full sequences or powers of two."""
    ids = collections.defaultdict(list)
    for (doc, text, _), x in zip(docs, library_ids([t for _, t, _ in docs]), strict=True):
        ids[doc].append(x)
    places = collections.defaultdict(list)
    covered = collections.Counter()
    for p in pieces:
        own = [x for x in ids[p.doc_id] if len(x) == p.doc_tokens and zlib.crc32(np.array(x[p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32]
        assert own and p.length > 0
        covered.update((p.doc_id, p.doc_tokens, i) for i in range(p.start, p.start + p.length))
        places[p.sequence_id].append((p.offset, p.length))
    want = collections.Counter((doc, len(x), i) for doc, xs in ids.items() for x in xs for i in range(len(x)))
    assert covered == want
    sizes = []
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        sizes.append(at)
    odd = [s for s in sizes if s != capacity]
    assert max(sizes, default=0) <= capacity and all(s & (s - 1) == 0 for s in odd) and len(set(odd)) == len(odd) and sum(odd) < capacity


@pytest.mark.parametrize("capacity", [2048, 256])
def test_mixture_packing_of_documents(spark, capacity):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").repartition(5, "doc_id")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    pieces = mixture_packing.pack(docs, WORDS, capacity).collect()
    check_pieces(pieces, rows, capacity)
    # in every full window each source is off its share by less than twice the larger of 64 tokens and its share
    source = {d: s for d, _, s in rows}
    tokens, total = collections.Counter(), 0
    for p in pieces:
        tokens[p.sequence_id, source[p.doc_id]] += p.length
        total += p.length
    shares = collections.Counter()
    for (_, s), n in tokens.items():
        shares[s] += n
    for (w, s), n in tokens.items():
        if w < total // capacity:
            fair = capacity * shares[s] / total
            assert abs(n - fair) <= 2 * max(64, fair)
    main, n = shares.most_common(1)[0]
    if capacity * n / total > 64:  # served in every round: the largest source is in all windows alike
        held = [tokens[w, main] for w in range(total // capacity)]
        assert np.std(held) < 0.15 * np.mean(held)


def test_mixture_packing_of_awkward_rows(spark):
    pieces = mixture_packing.pack(frame(spark, AWKWARD).repartition(3), WORDS, 128).collect()
    check_pieces(pieces, AWKWARD, 128)
    assert mixture_packing.pack(frame(spark, []), WORDS).collect() == []
    one = mixture_packing.pack(frame(spark, [(1, None, None)]), WORDS).collect()
    assert [(p.doc_id, p.start, p.length, p.doc_tokens, p.offset) for p in one] == [(1, 0, 1, 1, 0)]
    check_pieces(mixture_packing.pack(frame(spark, AWKWARD), WORDS, 100).collect(), AWKWARD, 100)  # no power of two itself


def round_robin(queues, shares, capacity, least):
    """Deficit round-robin one round at a time: (source, tokens served so far, tokens served) in order."""
    deficit, at, out = dict.fromkeys(queues, Fraction(0)), dict.fromkeys(queues, 0), []
    run = {s: min(capacity, max(least, math.floor(shares[s] * capacity))) for s in queues}
    while any(at[s] < n for s, n in queues.items()):
        for s in sorted(queues):
            if at[s] == queues[s]:
                continue
            deficit[s] += shares[s] * capacity
            while at[s] < queues[s] and (n := min(run[s], queues[s] - at[s])) <= deficit[s]:
                out.append((s, at[s], n))
                at[s] += n
                deficit[s] -= n
    return out


@pytest.mark.parametrize("targets", [None, {"a": 1.0, "b": 2.0, None: 1.0}])
def test_service_equals_round_robin(spark, targets):
    rng = random.Random(2)
    rows = [(i, "one two three four five six seven " * rng.randint(0, 12), rng.choice(["a", "a", "a", "b", "b", None])) for i in range(300)]
    pieces = mixture_packing.pack(frame(spark, rows).coalesce(1), WORDS, 512, targets=targets).collect()
    check_pieces(pieces, rows, 512)
    source = {d: "n" if s is None else f"s{s}" for d, _, s in rows}
    stream = [(source[p.doc_id], p.length) for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset))]
    queues = collections.Counter()
    for s, n in stream:
        queues[s] += n
    total = sum(queues.values())
    shares = {s: Fraction(n, total) for s, n in queues.items()} if targets is None else {"sa": Fraction(1, 4), "sb": Fraction(1, 2), "n": Fraction(1, 4)}
    want = [s for s, _, n in round_robin(queues, shares, 512, 64) for _ in range(n)]
    assert [s for s, n in stream for _ in range(n)] == want


def test_targets_leave_what_is_not_named_for_last(spark):
    rows = [(i, "one two three four " * 20, s) for i, s in enumerate("aabbccc" * 10)]
    pieces = mixture_packing.pack(frame(spark, rows), WORDS, 256, targets={"a": 3, "b": 1}).collect()
    check_pieces(pieces, rows, 256)
    source = dict((d, s) for d, _, s in rows)
    order = [source[p.doc_id] for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset))]
    assert "c" not in order[: order.index("c")] and set(order[order.index("c") :]) == {"c"}
    first = collections.Counter()
    for p in pieces:
        if p.sequence_id < 6:
            first[source[p.doc_id]] += p.length
    assert abs(first["a"] / 6 / 256 - 0.75) < 0.1
