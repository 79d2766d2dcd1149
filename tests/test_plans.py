"""Table cases: drops, runs, dedupe, upserts, snapshots, robots, sitemaps, mapping."""

import datetime as dt
import gzip
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from merchlake.operators import reports, rows, upserts
from merchlake.plans import history, mapping, queries
from merchlake.plans import price_drops as drops
from merchlake.sources import archive, records, tables, web


def t(n):
    return dt.datetime(2024, 1, n)


HISTORY = [
    (1, t(1), 100.0, None, True), (1, t(2), 80.0, None, True), (2, t(1), 100.0, None, True), (2, t(2), 95.0, None, True),
    (3, t(1), 100.0, None, True), (3, t(2), 70.0, None, False), (4, t(1), 100.0, None, True), (4, t(2), 40.0, None, False), (4, t(3), 85.0, None, True),
    (5, t(1), 100.0, 90.0, True), (5, t(2), 100.0, 60.0, True), (6, t(1), 100.0, None, True), (7, t(1), 100.0, None, True), (7, t(2), 50.0, None, True),
    (8, t(1), 100.0, None, True), (8, t(2), 90.0, None, True), (9, t(1), 80.0, None, True), (9, t(2), 100.0, None, True), (10, t(1), 100.0, None, True), (10, t(2), 50.0, None, None),
]


@pytest.mark.parametrize("find", [drops.price_drops, drops.price_drops_by_joins])
def test_price_drops(spark, find):
    h = spark.createDataFrame(HISTORY, "p int, at timestamp, sale double, conditional double, in_stock boolean")
    alerted = spark.createDataFrame([(7, t(2))], "p int, at timestamp")
    got = {r.p: r.pct_drop for r in find(h, ["p"], "at", [], 10.0, alerted, ["p", "at"]).collect()}
    assert got == {1: 20.0, 4: 15.0, 5: 33.3, 8: 10.0}


def test_mass_split_and_rest(spark):
    d = spark.createDataFrame([("a", i, 10.0 + i) for i in range(51)] + [("b", i, 20.0) for i in range(50)], "site string, i int, pct_drop double")
    kinds = {(r.site, r.kind): r["count"] for r in drops.mass_events(d, "site").groupBy("site", "kind").count().collect()}
    assert kinds == {("a", "summary"): 51, ("b", "individual"): 50}
    shown, rest = drops.shown_and_rest(d.where("site = 'b'"), [F.desc("pct_drop"), F.col("i")])
    assert (shown.count(), rest.first()[0]) == (30, 20)
    assert [r.site for r in drops.mass_summaries(d, "site").collect()] == ["a"]


def test_run_clusters(spark):
    times = ["2024-01-01 10:00:00", "2024-01-01 10:15:00", "2024-01-01 10:30:01"]
    df = spark.createDataFrame([("s", str(i), x) for i, x in enumerate(times)], "site string, name string, m string").withColumn("modified", F.to_timestamp("m"))
    assert [r.session for r in rows.sessions(df, ["site"], "modified", "15 MINUTES", ["name"]).orderBy("name").collect()] == [1, 1, 2]
    stamped = rows.run_stamps(df.where("name < '2'"), run_time=dt.datetime(2024, 5, 5)).select("run_at").distinct().collect()
    assert [r.run_at for r in stamped] == [dt.datetime(2024, 5, 5)]


def test_dedupe_and_ids(spark):
    df = spark.createDataFrame([(1, "r1", 3), (1, "r1", 1), (1, "r2", 2), (2, "r1", 0)], "p int, run string, _row_id int")
    assert sorted(map(tuple, rows.first_per_key(df, ["p", "run"], [F.col("_row_id")]).collect())) == [(1, "r1", 1), (1, "r2", 2), (2, "r1", 0)]
    ids = rows.with_row_ids(df.drop("_row_id"), F.col("p"), [F.col("p"), F.col("run")], 5)
    assert sorted(r._row_id for r in ids.collect()) == [5, 6, 7, 8]


def test_replace_is_idempotent(spark):
    old = spark.createDataFrame([("A", 1, "p1"), ("A", 2, "p1"), ("B", 1, "p1")], "site string, run int, p string")
    new = spark.createDataFrame([("A", 2, "p1'"), ("A", 2, "p2")], "site string, run int, p string")
    once = upserts.replace_by_keys(old, new, ["site", "run"])
    want = [("A", 1, "p1"), ("A", 2, "p1'"), ("A", 2, "p2"), ("B", 1, "p1")]
    assert sorted(map(tuple, once.collect())) == want
    assert sorted(map(tuple, upserts.replace_by_keys(once, new, ["site", "run"]).collect())) == want


def test_append_by_name(spark):
    a, b = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([("y", 2.0)], "b string, c double")
    assert sorted(map(str, upserts.append_by_name(a, b).collect())) == sorted(["Row(a=1, b='x', c=None)", "Row(a=None, b='y', c=2.0)"])
    assert upserts.append_by_name(a, spark.createDataFrame([(1,)], "b int")) is None


@pytest.mark.parametrize(
    "now,want",
    [
        (["a", "b", "e"], {"a": True, "b": True, "c": False, "d": False, "e": True}),
        (["a"], dict.fromkeys("abcd", True)),
        ([], dict.fromkeys("abcd", True)),
    ],
)
def test_url_diff(spark, now, want):
    old = spark.createDataFrame([(u, t(1), t(1), True) for u in "abcd"], "url string, first_seen_at timestamp, last_seen_at timestamp, is_active boolean")
    cur = spark.createDataFrame([(u,) for u in now], "url string")
    out = upserts.sync_activity(old, cur, F.lit(t(2)))
    got = {r.url: r for r in out.collect()}
    assert {u: r.is_active for u, r in got.items()} == want
    assert got["a"].first_seen_at == t(1)
    assert (got["a"].last_seen_at == t(2)) == ("e" in want)
    assert (got["c"].last_seen_at == t(2)) == ("e" in want)  # also one that has just turned inactive


def test_url_diff_leaves_what_was_inactive(spark):
    old = spark.createDataFrame([("a", t(1), t(1), True), ("b", t(1), t(1), False), ("c", t(1), t(1), False)], "url string, first_seen_at timestamp, last_seen_at timestamp, is_active boolean")
    got = {r.url: (r.is_active, r.last_seen_at.day) for r in upserts.sync_activity(old, spark.createDataFrame([("a",), ("c",)], "url string"), F.lit(t(2))).collect()}
    assert got == {"a": (True, 2), "b": (False, 1), "c": (True, 2)}


def test_url_diff_first_time(spark):
    old = spark.createDataFrame([], "url string, first_seen_at timestamp, last_seen_at timestamp, is_active boolean")
    out = upserts.sync_activity(old, spark.createDataFrame([("c",)], "url string"), F.lit(t(2))).collect()
    assert [(r.url, r.first_seen_at, r.is_active) for r in out] == [("c", t(2), True)]


ROBOTS = "User-agent: Foo\nDisallow: /foo\nUser-agent: *\nUser-agent: Bar\nDisallow: /x  # note\nAllow: /y\nSitemap: https://e.com/s.xml\nUser-agent: Baz\nDisallow: /z"


def test_robots(spark):
    got = web.robots(spark.createDataFrame([("h", ROBOTS)], "host string, text string"))
    assert sorted((r.kind, r.value) for r in got.collect()) == [("allow", "/y"), ("disallow", "/x"), ("sitemap", "https://e.com/s.xml")]


@pytest.mark.parametrize("between", ["Crawl-delay: 5", "Sitemap: https://e.com/t.xml", "Unknown:", ": x"])
def test_any_directive_ends_the_agents_of_a_robots_group(spark, between):
    text = f"Disallow: /before\nUser-agent: *\n{between}\nUser-agent: bot\n\tDisallow :\t/x\u2028User-agent: *\r\nAllow:/y"
    got = web.robots(spark.createDataFrame([("h", text), ("g", None), ("i", "")], "host string, text string"))
    assert sorted((r.kind, r.value) for r in got.collect() if r.kind != "sitemap") == [("allow", "/y")]


def test_sitemaps(spark):
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:image="http://i"'
    leaf = f"<urlset {ns}><url><loc>u1</loc><image:image><image:loc>no</image:loc></image:image></url><url><loc> u2 </loc></url></urlset>"
    index = f"<sitemapindex {ns}><sitemap><loc>m1</loc></sitemap></sitemapindex>"
    files = [("leaf", gzip.compress(leaf.encode())), ("index", index.encode()), ("bad", b"<urlset><url>")]
    got = web.sitemap_locations(spark.createDataFrame([(a, bytearray(b)) for a, b in files], "name string, content binary"))
    assert sorted(map(tuple, got.collect())) == [("index", "sitemapindex", "m1"), ("leaf", "urlset", "u1"), ("leaf", "urlset", "u2")]


def test_mapping_errors(spark):
    df = spark.createDataFrame([(1, 250)], "code int, cents int")
    with pytest.raises(ValueError):
        mapping.map_source(df, "s", {"name": {"path": "code"}})
    with pytest.raises(ValueError):
        mapping.compile_field({"guess": "x"})
    out, errors = mapping.map_sources({"good": (df, {"id": {"path": "code"}, "list_price_try": {"path": "cents", "unit": "minor"}}), "bad": (df, {"id": {"path": "nope"}})})
    assert set(errors) == {"bad"}
    assert out.select("site_code", "id", "list_price_try").collect()[0][:] == ("good", "1", 2.5)


def test_history_round(spark):
    df = spark.createDataFrame([(1, "Krem &amp; 50 ml", "ACME", -1.0, t(1)), (None, "x", None, 1.0, t(1))], "id int, title string, maker string, price double, _ingested_at timestamp")
    mapped = mapping.map_source(df, "site_a", {"id": {"path": "id"}, "name": {"path": "title"}, "brand": {"path": "maker"}, "sale_price_try": {"path": "price"}}, keep=("_ingested_at",))
    silver = history.normalise(mapped)
    (r,) = silver.collect()
    assert (r.name, r.name_full_normalized, r.size_value, r.size_unit, r.sale_price_try, r.fetch_date) == ("Krem & 50 ml", "acme krem 50 ml", 50.0, "ml", None, dt.date(2024, 1, 1))
    again = history.replace_runs(silver, silver)
    assert again.count() == 1


def test_records(spark):
    df = spark.createDataFrame([('{"d":{"items":[{"a":{"b":1,"c":[1,2]}},null]}}',), ("<x><d><items><a><b>2</b><c>3</c></a></items></d></x>",), ("{bad",)], "t string")
    parsed = df.select(records.parse(F.col("t"), "d struct<items: array<struct<a: struct<b: int, c: array<int>>>>>").alias("doc"))
    flat = records.flatten(records.items(parsed, F.col("doc"), "d.items").select("item.*"))
    assert flat.columns == ["a.b", "a.c"]
    assert sorted(r[0] for r in flat.collect()) == [1, 2]
    assert records.drop_prefixes(flat, ["a.c"]).columns == ["a.b"]


def test_archive_and_swap(spark, tmp_path):
    folder = tmp_path / "category/site_a/2024-01-02/x"
    folder.mkdir(parents=True)
    (folder / "p.json").write_bytes(b'{"a": "\xff"}')
    (folder / "p.meta.json").write_text('{"page": 1}')
    pages = archive.contents(spark, str(tmp_path))
    assert [r.text for r in pages.collect()] == ['{"a": "�"}']
    assert archive.sidecars(spark, str(tmp_path)).first().page == 1
    assert archive.listing(spark, str(tmp_path)).count() == 2
    target = str(tmp_path / "table")
    tables.swap(spark.range(3), target)
    tables.swap(tables.read(spark, target).where("id > 0"), target)
    assert tables.read(spark, target).count() == 2


def test_reports(spark):
    df = spark.createDataFrame([(1, ["x"]), (2, [None]), (None, None)], "a int, e array<string>")
    assert {r.field: r.nulls for r in reports.null_rates(df, ["a", "e"]).collect()} == {"a": 1, "e": 2}
    pages = spark.createDataFrame([("s", "c", 1, 200, 5, 10, None), ("s", "c", 2, 200, 5, 10, "empty_page"), ("s", "d", 1, 500, 0, None, "http_error"), ("s", "e", 1, 200, 3, None, "empty_page"), ("s", "f", 1, 200, 3, 4, "empty_page")], "site string, category string, page int, status int, items int, declared_total int, stop_reason string")
    assert {r.category: r.verdict for r in reports.completeness(pages).collect()} == {"c": "complete", "d": "incomplete", "e": "unverified", "f": "maybe_incomplete"}


def test_a_failed_swap_leaves_the_last_version(spark, tmp_path):
    target = f"file://{tmp_path}/t"
    tables.swap(spark.range(3), target)
    (tmp_path / "t" / "version-000000001").mkdir()  # a write that was cut off
    assert tables.read(spark, target).count() == 3
    tables.swap(tables.read(spark, target).where("id > 0"), target)
    tables.swap(tables.read(spark, target).where("id > 1"), target)
    assert [r.id for r in tables.read(spark, target).collect()] == [2] and tables.table_exists(spark, target)
    assert not tables.table_exists(spark, f"file://{tmp_path}/none")


def test_batches_that_come_again_change_nothing(spark, tmp_path):
    from merchlake.streaming import ingest

    source, target, schema = tmp_path / "in", f"file://{tmp_path}/out", "site string, run string, x long"
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"file://{source}")
    take = lambda n: ingest.ingest_available(spark, f"file://{source}", spark.createDataFrame([], schema).schema, target, f"file://{tmp_path}/c{n}")
    put([("a", "1", 1), ("a", "1", 2), (None, "1", 3)])
    take(0)
    first = sorted(map(str, ingest.landed(spark, target, ["site", "run"]).collect()))
    take(1)  # a new ledger: the same batch once more
    assert sorted(map(str, ingest.landed(spark, target, ["site", "run"]).collect())) == first and len(first) == 3
    put([("a", "1", 9), (None, "2", 4)])
    take(1)
    got = {(r.site, r.run, r.x) for r in ingest.landed(spark, target, ["site", "run"]).collect()}
    assert got == {("a", "1", 9), (None, "1", 3), (None, "2", 4)}


def test_streams(spark, tmp_path):
    from merchlake.streaming import ingest

    spark.sql("SELECT 'k' AS k, timestamp'2024-01-01 10:00:00' + make_interval(0, 0, 0, 0, 0, m) AS t FROM (SELECT explode(array(0, 5, 10, 60, 62, 300)) AS m)").coalesce(1).write.parquet(f"file://{tmp_path}/in")
    stream = lambda: spark.readStream.schema("k string, t timestamp").parquet(f"file://{tmp_path}/in")

    def run(df, name, mode):
        df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"file://{tmp_path}/{name}").trigger(availableNow=True).start().awaitTermination()
        return spark.table(name).collect()

    found = sorted((r.run_start.minute + 60 * (r.run_start.hour - 10), r.n) for r in run(ingest.session_counts(stream(), "t", ["k"]), "runs", "append"))
    assert found == [(0, 3), (60, 2)]  # the last run is open until the watermark passes it
    assert len(run(ingest.first_seen(stream(), "k", "t"), "firsts", "append")) == 1


def test_mapping_files(spark, tmp_path):
    import json

    (tmp_path / "b.json").write_text(json.dumps({"field_mapping": {"id": {"strategy": "direct_path", "path": "x.y", "note": "n"}, "name": {"strategy": "computed", "formula": "upper(a)"}, "list_price_try": {"strategy": "direct_path", "path": "p", "unit": "kurus"}, "currency": {"strategy": "static", "value": "TRY"}, "url": {"strategy": "none"}}}))
    (tmp_path / "a.json").write_text(json.dumps({"other": 1}))
    got = mapping.mapping_files(spark, f"file://{tmp_path}")
    assert list(got) == ["b"]
    df = spark.createDataFrame([(1, "a", 250)], "`x.y` int, a string, p long")
    row = mapping.map_source(df, "b", got["b"]).first()
    assert (row.id, row.name, row.list_price_try, row.currency, row.url) == ("1", "A", 2.5, "TRY", None)
    with pytest.raises(ValueError):
        mapping.spec_of({"strategy": "guess"})


def test_overrides_and_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id": 1, "images": ["u"]}\n{"id": 2, "late": 1.5}\n')
    raw = records.json_lines(spark, f"file://{tmp_path}/x.jsonl")
    assert set(raw.columns) == {"id", "images", "late"}
    out = history.clean(raw.withColumns({"_ingested_at": F.lit(1), "_row_id": F.col("id")}), ["id", "images", "_ingested_at", "_row_id"], "id", drop=["images"], add={"image_url": "'https://e.com/' || get(images, 0)"})
    assert {r.id: r.image_url for r in out.collect()} == {1: "https://e.com/u", 2: None} and "images" not in out.columns
    texts = ["\n <r><a>1</a></r>", "<r><a>1</a>", '\t{"a":1}', "{a", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    assert [r[0] for r in df.select(records.is_malformed(F.col("t"))).collect()] == [False, True, False, True, False]
    assert [r[0] for r in df.select(records.parse(F.col("t"), "a int")["a"]).collect()][0:3:2] == [1, 1]


def test_mass_events_of_null_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4), ("b", 5)], "g string, pct_drop int")
    got = {r.pct_drop: r.kind for r in drops.mass_events(df, "g", 1).collect()}
    assert got == {1: "summary", 2: "summary", 3: "summary", 4: "summary", 5: "individual"}
    assert [r.pct_drop for r in drops.report(df, ["g"]).collect()] == [5, 4, 3, 2, 1]


def test_pages_are_archived_under_their_content(spark, tmp_path):
    row = ("site_a", 7, "Yüz & Göz", 1, 200, dt.datetime(2024, 3, 1, 10), b"\xff{}", "json")
    columns = "site string, category_id int, category_name string, page int, http_status int, fetch_timestamp timestamp, content binary, extension string"
    pages = spark.createDataFrame([row, (*row[:6], None, "json")], columns)
    root = "file://" + str(tmp_path)
    assert archive.write_pages(pages, root) == archive.write_pages(pages, root) == 1
    (file,) = tmp_path.rglob("*.json.meta.json")
    page = file.with_name(file.name.removesuffix(archive.SIDECAR))
    assert page.read_bytes() == b"\xff{}" and page.stem == hashlib.sha256(b"\xff{}").hexdigest()
    assert page.relative_to(tmp_path).parts[:4] == ("category", "site_a", "2024-03-01", "7_yuz_goz")
    told = archive.sidecars(spark, root).first()
    assert (told.content_hash, told.page, told.http_status, told.category_name) == (page.stem, 1, 200, "Yüz & Göz")
    assert archive.contents(spark, root).count() == 1
    assert archive.write_pages(pages.where("false"), root) == 0


def test_sorted_row_ids(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "id * 7919 % 1000 AS x")
    ids = rows.with_sorted_row_ids(df, [F.col("x").desc()], str(tmp_path / "ids"), 10).collect()
    assert len(ids) == 1000 and all(r._row_id == 10 + 999 - r.x for r in ids)
    assert rows.with_sorted_row_ids(df.where("false"), [F.col("x")], str(tmp_path / "none")).count() == 0


def test_profile_by_sketches(spark):
    df = spark.range(1000).selectExpr("id", "id % 10 AS few")
    got = {r.path: r.distinct_count for r in reports.profile(df, distinct_error=0.02).collect()}
    assert got["few"] == 10 and abs(got["id"] - 1000) < 100


def test_sidecars_are_read_without_a_pass_to_infer_them(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"p{i}.html{archive.SIDECAR}").write_text(f'{{"page": {i},\n "site": "a", "http_status": 200, "more": "x"}}')
    told = archive.sidecars(spark, f"file://{tmp_path}")
    assert told.columns == list(archive.TOLD)
    assert sorted(r.page for r in told.collect()) == [0, 1, 2]
    assert sorted(r.more for r in archive.sidecars(spark, f"file://{tmp_path}", "page long, more string").collect()) == ["x"] * 3


def test_a_site_without_a_run_time_keeps_the_end_of_its_only_run(spark):
    df = spark.createDataFrame([("s", "0", dt.datetime(2024, 1, 1, 10)), ("s", "1", dt.datetime(2024, 1, 1, 10, 5)), ("t", "2", dt.datetime(2024, 1, 1, 9))], "site string, name string, modified timestamp")
    own = F.when(F.col("site") == "t", F.lit(dt.datetime(2024, 5, 5)))
    got = {r.name: r.run_at for r in rows.run_stamps(df, run_time=own).collect()}
    assert got == {"0": dt.datetime(2024, 1, 1, 10, 5), "1": dt.datetime(2024, 1, 1, 10, 5), "2": dt.datetime(2024, 5, 5)}


def test_rows_of_a_small_file_are_dealt_over_all_tasks(spark, tmp_path):
    from merchlake.plans import registry

    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    dealt = registry.spread(spark.read.parquet(str(tmp_path / "t")))
    assert len({r[0] for r in dealt.select(F.spark_partition_id()).distinct().collect()}) == 4 and dealt.count() == 1000


def test_objects_are_listed_by_tasks_as_spark_lists_them(spark, tmp_path):
    for name in ("a b/x.html", "a b/%41.txt", "c/d/e/y.html", "c/.hidden/z.html", "c/_x/z.html", "_k=1/z.html", "top.html"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{html,txt}").load(str(tmp_path))
    want = files.select("path", "modificationTime", "length", F.col("content").cast("string")).collect()
    found = archive.listing(spark, str(tmp_path), "*.{html,txt}")
    assert found.inputFiles() and all("/objects-" in f for f in found.inputFiles())  # not the archive's own files
    got = {r.name: (r.modified, r.length) for r in found.collect()}
    text = {r.name: r.text for r in archive.contents(spark, str(tmp_path), "*.{html,txt}").collect()}
    assert sorted((n, *v, text[n]) for n, v in got.items()) == sorted(map(tuple, want)) and len(got) >= 5


def test_contents_are_not_broadcast(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"p{i}.html").write_text(f"{i}" * 100_000)
    root = f"file://{tmp_path}"
    found = archive.listing(spark, root, "*.html").select("name", "length")
    for joined in (found.join(archive.contents(spark, root, "*.html").select("name", "text"), "name"), archive.contents(spark, root, "*.html").join(found, "name", "left")):
        assert sorted((r.length, len(r.text), r.text[0]) for r in joined.collect()) == [(100_000, 100_000, c) for c in "012"]
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


def test_a_round_trip_joins_texts_last_and_broadcasts_nothing(spark, tmp_path):
    spark.createDataFrame([(i, "u", f"{i}" * 50_000) for i in range(3)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    out = queries.archive_round_trip(spark, str(tmp_path))
    assert sorted((r.page_id, r.page, r.text) for r in out.collect()) == [(i, 0, f"{i}" * 50_000) for i in range(3)]
    assert re.findall(r"(\w+)Join \[(\w+)#", out._jdf.queryExecution().executedPlan().toString())[:2] == [("SortMerge", "name"), ("SortMerge", "content_hash")]
