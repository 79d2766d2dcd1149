"""The archive of fetched pages: listing, provenance, content, ledger, sidecars."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import path_segment
from ..functions.text import slugify
from . import tables

#: Fixed value: the ending of the JSON files that lie beside archived pages.
SIDECAR = ".meta.json"
#: What ``write_pages`` tells of a page in its sidecar.
TOLD = {"fetch_timestamp": "string", "site": "string", "category_id": "long", "category_name": "string", "page": "long", "plugin_version": "string", "http_status": "long", "content_hash": "string"}


def _place(root: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a qualified root."""
    return (fs.LocalFileSystem(), root.removeprefix("file:")) if root.startswith("file:") else fs.FileSystem.from_uri(root)


def _objects(spark: SparkSession, root: str, pattern: str) -> tuple[DataFrame, str]:
    """name, modified, length of every object below root whose file name matches, and the qualified root.

    Folders are listed by tasks, one level after the other, and what they hold is written in the shared
    folder, so that no list of objects passes through the driver.  As in Spark's own sources, names that begin with a
    dot or an underscore are left out.
    """
    path, files = tables._hadoop(spark, root)
    root = files.makeQualified(path).toString()
    found, level, levels = f"{tables.work_dir(spark)}/objects-{uuid.uuid4().hex[:12]}", spark.createDataFrame([("",)], "path string"), []

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _place(root)
        for b in batches:
            for folder in b.column(0).to_pylist():
                held = system.get_file_info(fs.FileSelector(base + folder))
                held = [x for x in held if not x.base_name.startswith(".") and (not x.base_name.startswith("_") or "=" in x.base_name)]
                for at in range(0, len(held), 10_000):
                    part = held[at : at + 10_000]
                    is_folder = [x.type == fs.FileType.Directory for x in part]
                    modified = pa.array([(x.mtime_ns or 0) // 1_000_000 * 1000 for x in part], pa.timestamp("us", "UTC"))
                    yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{x.base_name}" for x in part], pa.string()), pa.array(is_folder, pa.bool_()), modified, pa.array([x.size or 0 for x in part], pa.int64())], ["path", "folder", "modified", "length"])

    tasks, schema = int(spark.conf.get("spark.sql.shuffle.partitions")), "path string, folder boolean, modified timestamp, length long"
    while not levels or not level.isEmpty():
        levels.append(f"{found}/{len(levels)}")
        level.repartition(tasks, "path").mapInArrow(look, schema).write.parquet(levels[-1])
        level = spark.read.schema(schema).parquet(levels[-1]).where("folder").select("path")
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.GlobPattern(pattern).compiled().pattern()
    objects = spark.read.schema(schema).parquet(*levels).where("NOT folder").where(F.regexp_extract("path", "(?s)[^/]*$", 0).rlike(rf"(?s)\A(?:{glob})\z"))
    return objects.select(F.concat(F.lit(root.rstrip("/")), "path").alias("name"), "modified", "length"), root


def _read(objects: DataFrame, root: str) -> DataFrame:
    """Adds the content of objects; each task reads its own, and hands on some megabytes at a time.

    Spark's estimate of the result knows nothing of the contents, however long they are: the hint keeps joins from broadcasting them.
    """
    spark = objects.sparkSession
    size = objects.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (64 << 20)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _place(root)
        cut = len(root.rstrip("/"))
        for b in batches:
            begin, held, total = 0, [], 0
            for i, name in enumerate(b.column(0).to_pylist()):
                with system.open_input_stream(base.rstrip("/") + name[cut:], compression=None) as f:
                    held.append(f.read())
                total += len(held[-1])
                if total > 4 << 20 or i == b.num_rows - 1:
                    part = b.slice(begin, len(held))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(held, pa.binary())], [*part.schema.names, "content"])
                    begin, held, total = i + 1, [], 0

    return objects.repartition(tasks, "name").mapInArrow(read, "name string, modified timestamp, length long, content binary").hint("merge")


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """name, modified, length of every object below root, the oldest first, equal ones by name. Contents are not read."""
    return _objects(spark, root, pattern)[0].orderBy("modified", "name")


def contents(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """name, modified, text of every page below root; bytes that are no UTF-8 become U+FFFD. Sidecars are left out."""
    objects, root = _objects(spark, root, pattern)
    return _read(objects.where(is_page(F.col("name"))), root).select("name", "modified", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def sidecars(spark: SparkSession, root: str, schema: str = ", ".join(f"{k} {v}" for k, v in TOLD.items())) -> DataFrame:
    """What the sidecars below root tell, in the fields of schema, which is not inferred."""
    text = F.make_valid_utf8(F.col("content").cast("string"))
    return _read(*_objects(spark, root, "*" + SIDECAR)).select(F.from_json(text, schema).alias("told")).select("told.*")


def is_page(name: Column, extension: str | None = None) -> Column:
    page = ~F.endswith(name, F.lit(SIDECAR))
    return page & F.endswith(name, F.lit("." + extension)) if extension else page


def provenance(name: Column) -> dict[str, Column]:
    """Where a page comes from: its name is category/site/date/folder/file."""
    return {"_source_object": name, "_fetch_date": path_segment(name, 2).try_cast("date"), "_category_folder": path_segment(name, 3)}


def object_name(site: Column, date: Column, folder: Column, digest: Column, extension: str) -> Column:
    """The content-addressed name of a page."""
    return F.concat(F.lit("category/"), F.concat_ws("/", site, F.date_format(date, "yyyy-MM-dd"), folder, F.concat(digest, F.lit("." + extension))))


def named(pages: DataFrame) -> DataFrame:
    """Adds name and content_hash to fetched pages: the SHA-256 of the content, in a folder of the category's id and slug."""
    digest = F.sha2("content", 256)
    folder = F.concat_ws("_", F.col("category_id").cast("string"), slugify(F.col("category_name")))
    return pages.withColumns({"content_hash": digest, "name": object_name(F.col("site"), F.to_date("fetch_timestamp"), folder, digest, "{}")}).withColumn("name", F.replace("name", F.lit("{}"), F.col("extension")))


def write_pages(pages: DataFrame, root: str, version: str = "1") -> int:
    """Write pages and their sidecars below root; the number of pages written.

    pages: site, category_id, category_name, page, http_status,
    fetch_timestamp, content (binary), extension.  Each task writes its own
    rows.  A name follows from the content, so a task that runs again writes
    the same files; of equal pages of one day and category the last written
    sidecar stays.  Null contents are left out.
    """
    meta = F.to_json(F.struct(*TOLD), {"ignoreNullFields": "false"})
    rows = named(pages.where("content IS NOT NULL")).withColumn("plugin_version", F.lit(version)).select("name", "content", meta.alias("meta"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(root)
        for b in batches:
            for name, content, about in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                files.create_dir(f"{base}/{name.rpartition('/')[0]}", recursive=True)
                for path, data in ((name, content), (name + SIDECAR, about.encode())):
                    with files.open_output_stream(f"{base}/{path}") as out:
                        out.write(data)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    return rows.mapInArrow(put, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def unseen(objects: DataFrame, ledger: DataFrame) -> DataFrame:
    """Objects that the ledger lacks, by name and time of change: an object written anew is new."""
    return objects.join(ledger.select(F.col("object_name").alias("name"), "modified"), ["name", "modified"], "left_anti")


def request_body(template: dict[str, str], values: dict[str, Column]) -> Column:
    """A request as base64 of JSON; a template value that is one whole token keeps the column's type."""
    fields = []
    for key, text in template.items():
        whole = next((c for name, c in values.items() if text == "{" + name + "}"), None)
        if whole is None:
            whole = F.lit(text)
            for name, c in values.items():
                whole = F.replace(whole, F.lit("{" + name + "}"), c.cast("string"))
        fields.append(whole.alias(key))
    return F.replace(F.base64(F.to_json(F.struct(*fields))), F.lit("\r\n"), F.lit(""))  # Spark breaks lines at 76 characters
