"""The pipeline's stages, each on its own input, against brute force where it decides."""

import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from merchlake.llm.queries import tokenizer_file

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for i, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, DATA).write.parquet(f"{root}/{i}")
        docs = spark.read.parquet(f"{root}/{i}")
        out.append(docs)
    return out


def test_all_but_the_last_return_documents(staged):
    for df in staged[1:-1]:
        assert tuple(df.columns) == corpus_pipeline.COLUMNS
        assert df.count() == df.select("doc_id").distinct().count()


def shingles(t):
    w = t.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stages_decide(staged):
    rows = [{r.doc_id: r for r in df.collect()} for df in staged[:-1]]
    assert set(rows[1]) < set(rows[0])
    # line dedup: no two lines in a row stand in two places any more, and only copies went
    before, after = collections.Counter(), collections.Counter()
    for n, rs in ((before, rows[1]), (after, rows[2])):
        for r in rs.values():
            lines = r.text.split("\n")
            n.update((a, b) for a, b in zip(lines, lines[1:]) if a.strip() and b.strip())
    assert max(before.values()) > 1
    assert all(after[p] >= 1 for p, n in before.items() if n == 1 and p in after)
    # near-dedup: no two documents left are near, each that went has a smaller near one
    sets = {i: shingles(r.text) for i, r in rows[2].items()}
    near = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    assert all(rows[3][i].text == rows[2][i].text for i in rows[3]) and set(rows[3]) <= set(rows[2])
    assert not any(near(sets[a], sets[b]) for a in rows[3] for b in rows[3] if a < b and len(sets[a]) > 20)
    for i in set(rows[2]) - set(rows[3]):
        assert any(near(sets[i], sets[j]) for j in rows[2] if j != i)
    # passages: the words whose windows start in an earlier document, and no others
    first, want = {}, {}
    for i in sorted(rows[3]):
        w = rows[3][i].text.split()
        gone = [False] * len(w)
        for s in range(len(w) - 49):
            if first.setdefault(tuple(w[s : s + 50]), i) < i:
                gone[s : s + 50] = [True] * 50
        if not all(gone) or not w:
            want[i] = " ".join(x for x, g in zip(w, gone) if not g) if any(gone) else rows[3][i].text
    assert {i: r.text for i, r in rows[4].items()} == want
    for i, r in rows[4].items():
        assert r.n_chars == (rows[3][i].n_chars if r.text == rows[3][i].text else len(r.text))


def test_packing_of_what_is_left(staged):
    lib = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    pieces, places = collections.defaultdict(list), collections.defaultdict(list)
    for r in staged[-1].collect():
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    texts = {r.doc_id: r.text for r in staged[-2].collect()}
    assert set(pieces) == set(texts)
    for i, own in pieces.items():
        ids, at = [*lib.encode(texts[i], add_special_tokens=False).ids, 2], 0
        for r in sorted(own, key=lambda r: r.piece):
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for own in places.values():
        ends = [0, *(o + n for o, n in sorted(own))]
        assert [o for o, _ in sorted(own)] == ends[:-1] and ends[-1] <= 1024


def test_stages_of_nothing_and_of_awkward_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n ", "x"), (4, text("a", 20_000), "x"), (4, text("a", 20_000), "x"), (None, text("b"), "x"), (5, text("c"), None)]
    docs = odd(spark, rows).withColumns({"key": F.lit("clash"), "row": F.lit(1), "doc": F.lit(2), "kept": F.lit("k")})
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, docs.limit(0), DATA).count() == 0, name
        out = step(spark, docs, DATA)
        if name != "best-fit packing":
            assert tuple(out.columns) == corpus_pipeline.COLUMNS
        docs_left = {r.doc_id for r in out.collect()}
        assert docs_left == ({4, None, 5} if name == "quality rules" else {1, 2, 3, 4, 5, None}), name


def test_run_equals_the_stages(spark, staged):
    def key(df):
        return sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())

    assert key(corpus_pipeline.run(spark, DATA)) == key(staged[-1])


def odd(spark, rows):
    return spark.createDataFrame([(i, t, "en", source, len(t or "")) for i, t, source in rows], "doc_id long, text string, lang string, source string, n_chars long")


def text(name, n=80):
    return " ".join(f"{name}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n))


def held(df):
    return collections.Counter((r.doc_id, r.text) for r in df.collect())


def test_quality_of_null_and_repeated_ids(spark):
    a, b, c = text("a"), text("b"), text("c")
    rows = [(None, a, "x"), (None, b, "x"), (None, b, "y"), (1, c, "x"), (1, "too short", "x"), (2, a, "x"), (2, a, "x"), (None, "short", "x"), (3, None, "x")]
    assert held(corpus_pipeline.quality(spark, odd(spark, rows), DATA)) == {(None, a): 1, (None, b): 1, (1, c): 1, (2, a): 1}


def test_near_of_null_and_repeated_ids(spark):
    a, b, c, d, e = map(text, "abcde")
    rows = [(None, a, "x"), (None, b, "x"), (None, b, "x"), (1, c, "x"), (1, d, "x"), (2, d + " tail", "x"), (3, e, "x"), (3, e, "y"), (None, e, "x"), (4, "", "x"), (4, "", "x"), (5, None, "x"), (None, None, "x"), (None, None, "x")]
    want = {(None, a): 1, (None, b): 1, (1, c): 1, (1, d): 1, (3, e): 1, (4, ""): 1, (5, None): 1, (None, None): 1}
    assert held(corpus_pipeline.near(spark, odd(spark, rows), DATA)) == want


def test_classes_of_null_ids(spark):
    from merchlake.llm import near_duplicates

    rows = [(None, text("a"), "x"), (None, text("b"), "x"), (1, text("a"), "x")]
    assert sorted(map(str, ((r.doc_id, r.class_id) for r in near_duplicates.classes(odd(spark, rows)).collect()))) == ["(1, 1)", "(None, None)", "(None, None)"]


def test_other_stages_keep_null_and_repeated_ids(spark):
    a, b, c = text("a"), text("b"), text("c")
    docs = odd(spark, [(None, a, "x"), (None, b, "x"), (1, c, "x"), (1, text("d"), "x")])
    want = held(docs)
    assert held(corpus_pipeline.lines(spark, docs, DATA)) == want and held(corpus_pipeline.passages(spark, docs, DATA)) == want
    assert collections.Counter(r.doc_id for r in corpus_pipeline.packed(spark, docs, DATA).where("piece = 0").collect()) == {None: 2, 1: 2}


def test_runs_that_are_interleaved_keep_their_tables(spark, tmp_path):
    """Two runs stage by stage in turns, and a result that is held and read late."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    inputs = {"a": docs.where("doc_id % 2 = 0"), "b": docs.where("doc_id % 2 = 1")}
    held = corpus_pipeline.quality(spark, inputs["a"], DATA)
    want = {n: {} for n in inputs}
    now = dict(inputs)
    for i, (_, step) in enumerate(corpus_pipeline.STAGES[:3]):
        made = {n: step(spark, df, DATA) for n, df in now.items()}
        for n, df in made.items():
            df.write.parquet(f"{tmp_path}/{n}{i}")
            now[n] = spark.read.parquet(f"{tmp_path}/{n}{i}")
            want[n][i] = now[n].count()
    assert held.count() == want["a"][0]
    for n, df in inputs.items():  # each run alone
        for i, (_, step) in enumerate(corpus_pipeline.STAGES[:3]):
            step(spark, df, DATA).write.parquet(f"{tmp_path}/alone-{n}{i}")
            df = spark.read.parquet(f"{tmp_path}/alone-{n}{i}")
            assert df.count() == want[n][i]
