"""Stored tables, streams with state, inferred shapes, table functions, discovery and the serving copy."""

import datetime as dt
import hashlib
import os
import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from merchlake.operators import reports, rows, upserts
from merchlake.sources import discovery, manifests, serving, shapes, table_functions
from merchlake.streaming import activity, alerts, ingest

# --- tables of partitions -------------------------------------------------------------


def files(root):
    return {os.path.join(d, n)[len(str(root)) :] for d, _, names in os.walk(root) for n in names if n.startswith("part-")}


def frame(spark, rows, columns="site string, run timestamp, x long"):
    return spark.createDataFrame(rows, columns)


R1, R2 = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 16)


def test_a_batch_leaves_other_partitions_alone(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    manifests.write(frame(spark, [("a", R1, 1), ("a", R2, 2), ("b", R1, 3), (None, R1, 4), ("", R1, 5)]), root, ["site", "run"])
    before = files(tmp_path / "t")
    manifests.write(frame(spark, [("a", R2, 20), ("a", R2, 21), (None, R1, 40), ("c", None, 6)]), root, ["site", "run"])
    got = sorted(map(str, manifests.read(spark, root).collect()))
    assert got == sorted(map(str, frame(spark, [("a", R1, 1), ("a", R2, 20), ("a", R2, 21), ("b", R1, 3), (None, R1, 40), ("", R1, 5), ("c", None, 6)]).collect()))
    assert before < files(tmp_path / "t")  # nothing moved, nothing written anew
    live = {p["path"] for p in manifests.manifest(spark, root)["parts"]}
    assert manifests.vacuum(spark, root, keep=1) == 2
    left = files(tmp_path / "t")
    assert {f for f in before if any(p in f for p in live)} <= left and len(left & before) == 3
    assert sorted(map(str, manifests.read(spark, root).collect())) == got
    assert [r.x for r in manifests.read(spark, root, {"site": ["b", None]}).orderBy("x").collect()] == [3, 40]


def test_the_digest_of_keys_does_not_depend_on_the_zone(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    manifests.write(frame(spark, [("a", R1, 1)]), root, ["site", "run"])
    same = frame(spark, [("a", R1, 2)])
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        manifests.write(same, root, ["site", "run"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r.x for r in manifests.read(spark, root).collect()] == [2]


def test_a_crash_before_the_list_leaves_the_table(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/t"
    manifests.write(frame(spark, [("a", R1, 1), ("b", R1, 2)]), root, ["site", "run"])
    with monkeypatch.context() as m:
        m.setattr(manifests, "_publish", lambda *a: (_ for _ in ()).throw(OSError("cut off")))
        with pytest.raises(OSError):
            manifests.write(frame(spark, [("a", R1, 10)]), root, ["site", "run"])
    assert sorted(r.x for r in manifests.read(spark, root).collect()) == [1, 2]
    manifests.write(frame(spark, [("a", R1, 11)]), root, ["site", "run"])
    assert sorted(r.x for r in manifests.read(spark, root).collect()) == [2, 11]
    assert manifests.vacuum(spark, root, keep=1) == 2 and sorted(r.x for r in manifests.read(spark, root).collect()) == [2, 11]
    (tmp_path / "t/manifests/000000003.json").write_text("{}")  # another writer took the number that this one is about to take
    with monkeypatch.context() as m:
        m.setattr(manifests, "manifest", lambda s, r, n=None, f=manifests.manifest: f(s, r, 2))
        with pytest.raises(RuntimeError):
            manifests.write(frame(spark, [("a", R1, 12)]), root, ["site", "run"])


def test_columns_that_come_later_and_types_that_change(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    manifests.write(frame(spark, [("a", R1, 1)]), root, ["site", "run"])
    manifests.write(frame(spark, [("b", R1, 2, "z")], "site string, run timestamp, x long, more string"), root, ["site", "run"])
    assert sorted((r.x, r.more) for r in manifests.read(spark, root).collect()) == [(1, None), (2, "z")]
    other = frame(spark, [("c", R1, "text")], "site string, run timestamp, x string")
    with pytest.raises(ValueError):
        manifests.write(other, root, ["site", "run"])
    with pytest.raises(ValueError):
        manifests.write(frame(spark, [("a", R1, 1)]), root, ["site"])
    manifests.write(other, root, ["site", "run"], rebuild=True)
    assert [r.x for r in manifests.read(spark, root).collect()] == ["text"]
    manifests.write(other.where("false"), root, ["site", "run"])
    assert manifests.read(spark, root).count() == 1 and manifests.read(spark, root, {"site": ["none"]}).count() == 0
    assert manifests.manifest(spark, f"file://{tmp_path}/none") is None


def test_a_stream_writes_a_batch_once(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    for _ in range(2):
        manifests.write(frame(spark, [("a", R1, 1)]), root, ["site", "run"], batch=("s", 0))
    assert manifests.manifest(spark, root)["number"] == 1
    frame(spark, [("a", R1, 5), ("b", R2, 6)]).coalesce(1).write.parquet(f"file://{tmp_path}/in")
    for _ in range(2):
        ingest.ingest_partitions(spark, f"file://{tmp_path}/in", frame(spark, []).schema, root, f"file://{tmp_path}/c", ["site", "run"], name="other")
    assert sorted(r.x for r in manifests.read(spark, root).collect()) == [5, 6]
    assert manifests.manifest(spark, root)["batches"] == {"s": 0, "other": 0}


def test_a_stored_history(spark, tmp_path):
    from merchlake.plans import history

    root, columns = f"file://{tmp_path}/h", "site_code string, fetch_at timestamp, x long"
    history.store_runs(frame(spark, [("a", R1, 1), ("a", R2, 2), ("b", R1, 3)], columns), root)
    for _ in range(2):
        history.store_runs(frame(spark, [("a", R2, 20)], columns), root, ("runs", 7))
    assert sorted(r.x for r in manifests.read(spark, root).collect()) == [1, 3, 20] and manifests.manifest(spark, root)["number"] == 2
    history.store_runs(frame(spark, [("c", R1, 5, "z")], columns + ", more string"), root)
    assert [tuple(r)[2:] for r in manifests.read(spark, root).collect()] == [(5, "z")]


# --- streams with state -----------------------------------------------------------------


def test_spells_join_in_any_order():
    import numpy as np

    rng = random.Random(1)
    for _ in range(200):
        at = [rng.randrange(200) for _ in range(rng.randint(1, 30))]
        gap = rng.randint(0, 12)
        want, times = [], sorted(at)
        for x in times:
            if want and x - want[-1][1] <= gap:
                want[-1][1] = x
            else:
                want.append([x, x])
        begins, ends = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for i in range(0, len(at), 4):
            part = np.array(at[i : i + 4], np.int64)
            begins, ends = activity.joined(np.r_[begins, part], np.r_[ends, part], gap)
        assert [list(p) for p in zip(begins.tolist(), ends.tolist(), strict=True)] == want


def test_activity_is_the_same_however_it_arrives(spark, tmp_path):
    t = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    seen = [("a", 0), ("a", 5), ("b", 3), ("a", 40), ("a", 45), (None, 1), ("b", 90), ("c", 200)]
    took = {}
    for name, parts in {"once": [seen], "twice": [seen[:3], seen[3:]], "mixed": [[seen[1], seen[2], seen[0]], [seen[4], seen[3]], seen[5:]]}.items():
        for part in parts:
            spark.createDataFrame([(k, t(m)) for k, m in part], "url string, at timestamp").coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/{name}/in")
            stream = spark.readStream.schema("url string, at timestamp").parquet(f"file://{tmp_path}/{name}/in")
            out = activity.spells(stream, "url", "at", 600, "10 minutes")
            out.writeStream.format("parquet").option("path", f"file://{tmp_path}/{name}/out").option("checkpointLocation", f"file://{tmp_path}/{name}/c").trigger(availableNow=True).start().awaitTermination()
        took[name] = sorted((r.url, r.spell, r.first_seen_at, r.seen_from, r.last_seen_at, r.gone_at) for r in spark.read.parquet(f"file://{tmp_path}/{name}/out").collect())
    want = [("a", 1, t(0), t(0), t(5), t(15)), ("a", 2, t(0), t(40), t(45), t(55)), ("b", 1, t(3), t(3), t(3), t(13)), ("b", 2, t(3), t(90), t(90), t(100))]
    assert took == {"once": want, "twice": want, "mixed": want}


def test_a_batch_that_comes_again_alerts_once(spark, tmp_path):
    ledger, columns = f"file://{tmp_path}/ledger", "k string, at int"
    send = lambda rows, name, n: sorted(r.k or "-" for r in alerts.send(spark.createDataFrame(rows, columns), ledger, name, n, ["k"], ["at"]).collect())
    assert alerts.ledger(spark, ledger) is None
    assert send([("a", 2), ("a", 1), (None, 1)], "s", 0) == ["-", "a"]
    assert send([("a", 3), ("b", 3), (None, 9)], "s", 1) == ["b"]
    assert send([("a", 3), ("b", 3), (None, 9)], "s", 1) == ["b"]  # after a failure
    assert send([("a", 2), ("a", 1), (None, 1)], "s", 0) == ["-", "a"]
    assert send([("a", 5), ("c", 5)], "anew", 0) == ["c"]
    assert sorted((r.k or "-", r["at"], r.stream, r.batch) for r in alerts.ledger(spark, ledger).collect()) == [("-", 1, "s", 0), ("a", 1, "s", 0), ("b", 3, "s", 1), ("c", 5, "anew", 0)]


# --- without hot tasks ---------------------------------------------------------------------


@pytest.mark.parametrize("one_key", [True, False])
def test_sessions_by_range_equal_sessions(spark, tmp_path, one_key):
    rng = random.Random(4)
    data = [("k" if one_key else rng.choice(["a", "b", None]), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.choice([1, 30, 3000]) * rng.randint(0, 400)), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, at timestamp, i int").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows.sessions_by_range(df, ["k"], "at", "20 SECONDS", f"file://{tmp_path}/s", ["i"])
        found = sorted(map(str, got.collect()))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == sorted(map(str, rows.sessions(df, ["k"], "at", "20 SECONDS", ["i"]).collect()))
    ranges = spark.read.parquet(f"file://{tmp_path}/s").groupBy("_range").count().collect()
    assert len(ranges) > 2 and max(r["count"] for r in ranges) < 2000  # no task has all rows of the key


def test_one_long_session_over_all_ranges(spark, tmp_path):
    df = spark.range(2000).selectExpr("'k' AS k", "timestamp_seconds(id) AS at")
    out = rows.sessions_by_range(df, ["k"], "at", "1 SECOND", f"file://{tmp_path}/s").select("session", "session_end").distinct().collect()
    assert [tuple(r) for r in out] == [(1, dt.datetime(1970, 1, 1, 0, 33, 19))]
    assert rows.sessions_by_range(df.where("false"), ["k"], "at", "1 SECOND", f"file://{tmp_path}/e").collect() == []


def test_set_hash_of_groups(spark):
    data = [("a", "x"), ("a", "é"), ("a", "x"), ("a", None), (None, "q"), ("b", None), ("c", "")]
    got = {r.g: r.content_hash for r in upserts.set_hash(spark.createDataFrame(data, "g string, v string"), ["g"], "v").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {"a": sha("x\né"), None: sha("q"), "b": sha(""), "c": sha("")}


def test_set_hash_holds_no_group_in_memory(spark):
    """200 MB of values in one group: what runs in the Python worker stays far below that."""
    df = spark.range(200_000).selectExpr("'g' AS g", "repeat(md5(CAST(id AS STRING)), 32) AS v")
    digest = hashlib.sha256("\n".join(sorted(hashlib.md5(str(i).encode()).hexdigest() * 32 for i in range(200_000))).encode()).hexdigest()
    assert upserts.set_hash(df, ["g"], "v").collect() == [("g", digest)]
    plan = upserts.set_hash(df, ["g"], "v")._jdf.queryExecution().toString()
    assert "collect_set" not in plan and "collect_list" not in plan


def test_exact_profile(spark):
    df = spark.createDataFrame([(1, "b\nc", ["x"], None), (2, "a", ["x"], None), (2, None, None, None)], "i int, s string, l array<string>, n string")
    got = {r.path: (r.dtype, r.fill_pct, r.distinct_count, r.sample_value) for r in reports.profile(df).collect()}
    assert got == {"i": ("int", 100.0, 2, "1"), "s": ("string", 66.7, 2, "a"), "l": ("array<string>", 66.7, 1, '["x"]'), "n": ("string", 0.0, 0, None)}
    assert "Expand" not in reports.profile(df)._jdf.queryExecution().toString()
    assert {(r.path, r.fill_pct, r.distinct_count) for r in reports.profile(df.where("false")).collect()} == {(c, None, 0) for c in df.columns}


def test_profiles_add_up(spark):
    df = spark.range(3000).selectExpr("id % 3 AS run", "id % 700 AS a", "CASE WHEN id % 2 = 0 THEN id END AS b")
    stored = [reports.sketches(df.where(f"run = {i}"), ["run"]) for i in range(3)]
    merged = {r.path: r for r in reports.merged_profile(stored[0].unionByName(stored[1]).unionByName(stored[2])).collect()}
    whole = {r.path: r for r in reports.merged_profile(reports.sketches(df.drop("run"))).collect()}
    assert {p: tuple(r)[:5] for p, r in merged.items()} == {p: tuple(r)[:5] for p, r in whole.items()}
    assert (merged["b"].n, merged["b"].fill) == (3000, 1500) and all(abs(x["a"].distinct_count - 700) < 50 for x in (merged, whole))


# --- shapes ------------------------------------------------------------------------------------


def test_shapes_merge():
    of = shapes.shape_of
    assert shapes.ddl(of("OBJECT<`a b`: ARRAY<OBJECT<c: DECIMAL(3,1)>>, d: VOID>")) == "STRUCT<`a b`: ARRAY<STRUCT<`c`: DOUBLE>>, `d`: STRING>"
    both = lambda a, b, lists=False: shapes.ddl(shapes.merge(of(a), of(b), lists))
    assert both("OBJECT<a: BIGINT>", "OBJECT<b: STRING, a: DOUBLE>") == "STRUCT<`a`: DOUBLE, `b`: STRING>"
    assert both("OBJECT<a: BIGINT>", "OBJECT<a: ARRAY<BIGINT>>") == "STRUCT<`a`: STRING>"
    assert both("OBJECT<a: BIGINT>", "OBJECT<a: ARRAY<DOUBLE>>", True) == "STRUCT<`a`: ARRAY<DOUBLE>>"
    assert both("OBJECT<a: VOID>", "OBJECT<a: ARRAY<VOID>>") == "STRUCT<`a`: ARRAY<STRING>>"
    assert both("OBJECT<a: OBJECT<x: BIGINT>>", "OBJECT<a: BOOLEAN>") == "STRUCT<`a`: STRING>" and both("OBJECT<>", "VOID") == "STRING"


def test_documents_of_both_kinds(spark):
    texts = ['{"a":1,"l":[1]}', '{"a":1.5,"o":{"x y":true}}', "<r><a>2</a><l>1</l><l>2</l></r>", "<r><a>3</a><l>7</l></r>", "<r><a>4</a></r>", "<r><a>", "{", None, " \n<r kind='k'><n:a xmlns:n='u'>5</n:a></r>"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: r.document and (r.document.a, r.document.l, r.document.o and r.document.o["x y"]) for r in shapes.parsed(df, "text").collect()}
    assert got == {0: (1.0, [1], None), 1: (1.5, None, True), 2: (2.0, [1, 2], None), 3: (3.0, [7], None), 4: (4.0, None, None), 5: None, 6: None, 7: None, 8: (5.0, None, None)}
    assert shapes.infer(df.where("i > 4 AND i < 8"), F.col("text")) is None
    assert [r.document for r in shapes.parsed(df.where("i = 6"), "text").collect()] == [None]
    lists = spark.createDataFrame([("[1,2]",), ("[",)], "text string")
    assert {r.document for r in shapes.parsed(lists, "text", kind="json").collect()} == {"[1,2]", None}


# --- table functions, discovery, serving ------------------------------------------------------------


def test_table_functions(spark):
    import gzip

    table_functions.register(spark)
    ask = lambda f, **a: [tuple(r) for r in spark.sql(f"SELECT * FROM {f}", args=a).collect()]
    assert ask("robots_rules(:t)", t="User-agent: *\nCrawl-delay: 5\nUser-agent: bot\nDisallow: /x\nSitemap: s") == [("sitemap", "s", 4)]
    assert ask("robots_rules(:t)", t="Disallow: /n\nUser-agent: a\nUser-agent: *\nDisallow: /x #c\nAllow:\n") == [("disallow", "/x", 3)]
    assert ask("robots_rules(CAST(NULL AS STRING))") == []
    doc = b"<sitemapindex><sitemap><loc> m </loc></sitemap><other><loc>n</loc></other></sitemapindex>"
    assert ask("sitemap_entries(:c)", c=bytearray(gzip.compress(doc))) == ask("sitemap_entries(:c)", c=bytearray(doc)) == [("sitemapindex", "m")]
    assert ask("sitemap_entries(:c)", c=bytearray(b"<a>")) == []
    assert ask("embedded_records(:p, 'd=\"(.*?)\"', 'id')", p='d="{&quot;id&quot;:1}" d="[{},2,null]" d="x"') == [(0, "1"), (1, None)]
    with pytest.raises(Exception, match="constant"):
        spark.sql("SELECT r.* FROM VALUES ('a', 'b') t(p, f), LATERAL embedded_records(p, 'x', f) r").collect()


def test_discovery(spark):
    urls = [f"https://H.example/shop/{c}/{i}?x=/y" for c in ("a", "b") for i in range(4)] + [f"https://h.example/shop/c/{i}" for i in range(2)] + ["https://h.example/", "https://h.example/shop/a/0", "mailto:x", None, "https://h.example/about#a/b"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    tree = {(r.prefix, r.depth): (r.children, r.pages) for r in discovery.prefix_tree(df).collect()}
    assert tree["", 0] == (2, 12) and tree["shop", 1] == (3, 10) and tree["shop/a", 2] == (4, 4) and tree["about", 1] == (0, 1)
    found = lambda **a: sorted(r.prefix for r in discovery.categories(df, **a).collect())
    assert found() == ["shop/a", "shop/b"]
    assert found(leaves_only=False) == ["shop", "shop/a", "shop/b"]
    assert found(depths=(1, 1)) == ["shop"] and found(least_children=2) == ["shop/a", "shop/b", "shop/c"] and found(least_children=9) == []
    assert sorted(map(tuple, discovery.matching(df, r"/shop/([ab])/\d", ["c"]).collect())) == [("h.example", "a", 5), ("h.example", "b", 4)]


def test_serving_survives_a_failed_task(spark, tmp_path):
    serving.register(spark)
    where = {"database": f"{tmp_path}/s.db", "table": "t", "key": "k"}
    df = spark.range(5000).selectExpr("id AS k", "CAST(id AS STRING) AS name", "id / 2 AS x").repartition(3)
    df.write.format("serving").options(**where).mode("append").save()
    boom = F.udf(lambda k: k if k != 4321 else 1 / 0, "long")
    with pytest.raises(Exception, match="division"):
        df.withColumn("x", F.col("x") + 1).withColumn("k", boom("k")).write.format("serving").options(**where).mode("append").save()
    read = lambda: spark.read.format("serving").options(**where, partitions=4).load()
    assert sorted(map(tuple, read().collect())) == sorted(map(tuple, df.collect())) and read().rdd.getNumPartitions() == 4
    con = sqlite3.connect(f"{tmp_path}/s.db")
    assert [n for (n,) in con.execute("SELECT name FROM sqlite_master WHERE type = 'table'")] == ["t"]  # no staging table is left
    spark.createDataFrame([(1, "new", 0.0), (9000, None, None)], "k long, name string, x double").write.format("serving").options(**where, preserve="name").mode("append").save()
    assert {r.k: (r.name, r.x) for r in read().where("k IN (1, 9000)").collect()} == {1: ("1", 0.0), 9000: (None, None)}
    df.limit(2).write.format("serving").options(**where).mode("overwrite").save()
    assert read().count() == 2
    con.execute("DELETE FROM t")
    con.commit()
    assert read().count() == 0


# --- quarantine --------------------------------------------------------------------------------------


def test_casts_of_a_formula():
    from merchlake.plans.quarantine import casts

    assert casts("CAST(a AS DOUBLE) + cast( concat('x) AS y', \"q\") as  string)") == [("a", "DOUBLE"), ("concat('x) AS y', \"q\")", "string")]
    assert casts("CAST(CAST(b AS INT) / 2 AS DECIMAL(10, 2))") == [("CAST(b AS INT) / 2", "DECIMAL(10, 2)"), ("b", "INT")]
    assert casts("'CAST(a AS INT)' || TRY_CAST(c AS INT) || broadcast(x)") == []


def test_rows_that_fail_stop_nothing(spark):
    from merchlake.plans.quarantine import map_apart

    rows_ = [(1, "1.5", 3, [10]), (2, "x", 0, []), (3, None, None, None), (None, "2", 1, [1])]
    df = spark.createDataFrame(rows_, "code int, price string, per int, l array<int>")
    fields = {
        "id": {"path": "code"}, "name": {"formula": "'p' || code"}, "list_price_try": {"formula": "CAST(price AS DOUBLE)"}, "sale_price_try": {"path": "price", "unit": "minor"},
        "discount_rate": {"formula": "list_price_try * 2"}, "stock_qty": {"formula": "6 / per + l[0]", "required": True}, "currency": {"static": "TRY"}, "is_in_stock": {"path": "per"}, "url": {"none": True},
    }
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    good, bad = map_apart(df, "s", fields)
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    got = [(r.id, r.list_price_try, r.sale_price_try, r.discount_rate, r.stock_qty, r.currency, r.is_in_stock) for r in good.collect()]
    assert got == [("1", 1.5, 0.02, 3.0, 12, "TRY", True), ("2", None, None, None, None, "TRY", False), ("3", None, None, None, None, "TRY", None), (None, 2.0, 0.02, 4.0, 7, "TRY", True)]
    errors = sorted((r.id, r.field, r.reason, r.value or "") for r in bad.collect())
    assert errors == [("2", "list_price_try", "cast", "x"), ("2", "sale_price_try", "cast", "x"), ("2", "stock_qty", "null", ""), ("3", "stock_qty", "null", "")]
    with pytest.raises(ValueError):
        map_apart(df, "s", {"name": {"path": "code"}})
    with pytest.raises(Exception, match="nope"):
        map_apart(df, "s", {"id": {"path": "nope"}})


def test_sites_from_files(spark, tmp_path):
    import json

    from merchlake.plans import sites

    (tmp_path / "a.json").write_text(json.dumps({"product_id_field": "p.id", "drop_prefixes": ["ads"], "drop": ["images"], "add": {"image": "get(images, 0)"}, "field_mapping": {"id": {"strategy": "direct_path", "path": "p.id"}, "image_url": {"strategy": "direct_path", "path": "image"}, "name": {"strategy": "none", "required": True}}}))
    (tmp_path / "b.json").write_text(json.dumps({"product_id_field": "id", "field_mapping": {"name": {"strategy": "static", "static": "x"}}}))
    (tmp_path / "c.json").write_text("{}")
    found = sites.sites(spark, f"file://{tmp_path}")
    assert sorted(found) == ["a", "b"] and found["a"].drop == ("images",)
    raw = spark.sql("SELECT named_struct('id', 7) AS p, array('u') AS images, named_struct('x', 1) AS ads, timestamp'2024-03-01 10:00:00' AS _ingested_at, id AS _row_id FROM range(2)")
    good, bad, failed = sites.build(found, {"a": raw, "b": raw})
    assert [(r.source_product_id, r.image_url, r.site_code) for r in good.collect()] == [("7", "u", "a")]
    assert [tuple(r) for r in bad.collect()] == [("a", "7", "name", "null", None)] and [*failed] == ["b"]
    assert sites.build({}, {}) == (None, None, {})
