"""Manifests, journals, catalogues, CSV exports and pages as DataFrames."""

from __future__ import annotations

import hashlib
import json
import sqlite3
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import packages


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(manifest, output_path, status) of every entry; the list is called ``entries`` or ``results``. Unreadable manifests have none."""
    entry = "array<struct<output_path:string,status:string>>"
    raw = spark.read.option("wholetext", "true").text(path).withColumn("manifest", F.col("_metadata.file_path"))
    parsed = raw.withColumn("m", F.from_json("value", f"struct<entries:{entry},results:{entry}>"))
    return parsed.select("manifest", F.explode(F.coalesce("m.entries", "m.results")).alias("e")).select("manifest", "e.output_path", "e.status").where("output_path is not null")


def missing(entries: DataFrame, files: DataFrame) -> DataFrame:
    """Entries whose file is not there. files(path)."""
    return entries.join(files.select(F.col("path").alias("output_path")).distinct(), "output_path", "left_anti")


def journal(spark: SparkSession, path: str) -> DataFrame:
    """The last record of each item of an append-only JSON-lines journal.

    A torn last line is passed over; a damaged line before it raises when the result is read.
    """
    # inside a split, lines come in order; splits of a file go by where they begin, not by the order in which they are read
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    fields = "struct<item_id:string,status:string,seq:bigint,_damaged:string>"
    lines = lines.withColumn("line", F.struct("block", "place"))
    parsed = lines.where("trim(value) <> ''").withColumn("r", F.from_json("value", fields, {"columnNameOfCorruptRecord": "_damaged"}))
    last = parsed.groupBy("file").agg(F.max("line").alias("last"))
    checked = parsed.join(last, "file")
    torn = F.col("r").isNull() | F.col("r._damaged").isNotNull() | F.col("r.item_id").isNull()
    # one expression, so that no part of it can be applied before the damaged lines are seen
    item = F.when(torn & (F.col("line") < F.col("last")), F.raise_error(F.lit("a damaged journal line")).cast("string")).when(~torn, F.col("r.item_id"))
    fine = checked.withColumn("item", item).where("item is not null")
    return fine.groupBy("r.item_id").agg(F.max(F.struct("file", "line", "r")).alias("x")).select("x.r.item_id", "x.r.status", "x.r.seq")


def csv_chunks(spark: SparkSession, pattern: str) -> DataFrame:
    """Chunk nodes from CSV exports, all columns as strings; texts may span lines."""
    return spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(pattern)


def csv_aliases(rows: DataFrame, key: str = "document_key", aliases: str = "citation_alias_keys") -> DataFrame:
    """alias -> sorted ids, from pipe-delimited lists."""
    each = rows.select(F.col(key).alias("id"), F.explode(F.split(aliases, r"\|")).alias("alias")).where("trim(alias) <> ''").distinct()
    return each.groupBy("alias").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(position, title, url) of a catalogue of <item> elements; items without a title or a ZIP link are left out."""
    raw = spark.read.option("wholetext", "true").text(path).select(F.col("value"))
    items = raw.select(F.posexplode(F.regexp_extract_all("value", F.lit(r"(?s)<item>.*?</item>"), 0)).alias("position", "item"))
    pick = lambda tag: F.trim(F.regexp_extract("item", rf"(?s)<{tag}>\s*(.*?)\s*</{tag}>", 1))
    return items.select("position", pick("title").alias("title"), pick("link").alias("url")).where("title <> '' and url rlike '^https?://.*[.]zip$'")


def page_links(pages: DataFrame, host: str) -> DataFrame:
    """(page_id, url, score, rank) of the ZIP links of a page on the same host: 10 for an XML package, 5 for XML in the name, 2 for XML in the label.

    Links with no score and repeated ones are left out; the best come first, then the earlier. pages(page_id, html).
    """
    anchors = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r"(?is)<a\s[^>]*?href\s*=\s*[\"'][^\"']+[\"'][^>]*>.*?</a>"), 0)).alias("position", "a"))
    link = anchors.select("page_id", "position", F.regexp_extract("a", r"(?is)href\s*=\s*[\"']([^\"']+)[\"']", 1).alias("href"), F.lower(F.regexp_replace("a", r"(?s)<[^>]*>", " ")).alias("label"))
    url = F.when(F.col("href").startswith("/"), F.concat(F.lit(f"https://{host}"), F.col("href"))).otherwise(F.col("href"))
    name = F.lower(F.regexp_extract("url", r"([^/]+)$", 1))
    score = F.when(F.lower("url").endswith("/xml.zip"), 10).otherwise(0) + F.when(name.contains("xml"), 5).otherwise(0) + F.when(F.col("label").contains("xml"), 2).otherwise(0)
    found = link.withColumn("url", url).where(F.lower("url").endswith(".zip") & F.col("url").startswith(f"https://{host}/")).withColumn("score", score).where("score > 0")
    once = found.groupBy("page_id", "url").agg(F.max("score").alias("score"), F.min("position").alias("position"))
    return once.withColumn("rank", F.row_number().over(Window.partitionBy("page_id").orderBy(F.col("score").desc(), "position"))).drop("position")


def html_blocks(pages: DataFrame) -> DataFrame:
    """(page_id, position, tag, text) of the paragraphs, headings and list items of old HTML, tags and entities resolved."""
    body = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    blocks = pages.select("page_id", F.posexplode(F.regexp_extract_all(body, F.lit(r"(?is)<(?:p|h[1-6]|li|td)\b[^>]*>.*?(?=<(?:/?(?:p|h[1-6]|li|td|tr|table|div|body))\b|$)"), 0)).alias("position", "b"))
    text = F.regexp_replace(F.regexp_replace("b", r"(?i)<br\s*/?>", "\n"), r"(?s)<[^>]*>", "")
    for entity, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&auml;", "ä"), ("&ouml;", "ö"), ("&uuml;", "ü"), ("&Auml;", "Ä"), ("&Ouml;", "Ö"), ("&Uuml;", "Ü"), ("&szlig;", "ß"), ("&sect;", "§"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(ch))
    out = blocks.select("page_id", "position", F.lower(F.regexp_extract("b", r"^<(\w+)", 1)).alias("tag"), F.trim(F.regexp_replace(text, r"[\s ]+", " ")).alias("text"))
    return out.where("text <> ''")


def _sqlite(query: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with tempfile.NamedTemporaryFile(suffix=".sqlite") as f:  # read here and now, by this task alone
                    f.write(data)
                    f.flush()
                    with sqlite3.connect(f"file:{f.name}?mode=ro", uri=True) as db:
                        db.row_factory = sqlite3.Row
                        cursor = db.execute(query)
                        while rows := cursor.fetchmany(10_000):
                            texts = [json.dumps({k: r[k] for k in r.keys() if not isinstance(r[k], bytes)}, ensure_ascii=False) for r in rows]
                            yield pa.RecordBatch.from_arrays([pa.array([path] * len(texts)), pa.array(texts)], ["path", "row"])

    return run


def sqlite_rows(spark: SparkSession, path: str, query: str, schema: str) -> DataFrame:
    """The rows of a query on every SQLite file below a path, with the file's path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(_sqlite(query), "path string, row string").select("path", F.from_json("row", schema).alias("r")).select("path", "r.*")


def rules(spark: SparkSession, path: str) -> DataFrame:
    """(rule, pattern) of the anomaly rules of all JSON files below a path, in the order of the files' names and of their lists."""
    entry = "struct<anomaly_patterns:array<struct<type:string,pattern:string>>>"
    raw = spark.read.option("wholetext", "true").text(path).select(F.col("_metadata.file_name").alias("file"), F.from_json("value", entry).alias("r"))
    each = raw.select("file", F.posexplode("r.anomaly_patterns").alias("place", "x")).where("x.pattern is not null")
    return each.orderBy("file", "place").select(F.col("x.type").alias("rule"), F.col("x.pattern").alias("pattern"))


def catalogue_aliases(spark: SparkSession, path: str) -> DataFrame:
    """(alias, id) of a JSON catalogue: a list of documents with an id and a list of aliases."""
    raw = spark.read.option("wholetext", "true").text(path).select(F.from_json("value", "struct<documents:array<struct<id:string,title:string,aliases:array<string>>>>").alias("c"))
    docs = raw.select(F.explode("c.documents").alias("d"))
    return docs.select(F.col("d.id").alias("id"), F.explode(F.array_union(F.coalesce("d.aliases", F.array().cast("array<string>")), F.array("d.title"))).alias("alias")).where("trim(alias) <> ''").select("alias", "id").distinct()


def _collection(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, taken = [], set()
        for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            try:
                files = packages.members(data)
            except packages.Refused:
                continue
            for name in sorted((n for n in files if n.lower().endswith(".pdf")), key=lambda n: (n.casefold(), n)):
                stem = name.rsplit("/", 1)[-1][:-4].lower()
                plain = "".join(c if c.isalnum() else "_" for c in stem).strip("_") or "document"
                if (path, plain) in taken:
                    plain += "_" + hashlib.sha1(name.encode()).hexdigest()[:8]
                taken.add((path, plain))
                out.append((path, plain, name, hashlib.sha256(files[name]).hexdigest(), len(files[name])))
        types = [*[pa.string()] * 4, pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * 5, types)], ["path", "id", "member", "sha256", "size"])


def collection(spark: SparkSession, path: str) -> DataFrame:
    """(path, id, member, sha256, size) of the PDF files of every ZIP below a path, in the order of their names; an id that is
    taken gets a suffix. A refused archive has none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(_collection, "path string, id string, member string, sha256 string, size bigint")


def run_logs(spark: SparkSession, path: str, newest: int, schema: str, conversation: str | None = None) -> DataFrame:
    """The newest run files, as many as asked for, by the time of their last change; of one conversation, if one is named."""
    files = spark.read.option("wholetext", "true").text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("changed"))
    runs = files.select("path", "changed", F.from_json("value", schema).alias("r")).where("r is not null").select("path", "changed", "r.*")
    if conversation is not None:
        runs = runs.where(F.col("conversation_id") == conversation)
    return runs.orderBy(F.col("changed").desc(), "path").limit(newest)


def artefacts(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """Runs and scores by a path pattern; ``profile`` is the folder that a file lies in."""
    raw = spark.read.schema(schema).option("multiLine", "true").json(pattern).withColumn("path", F.col("_metadata.file_path"))
    return raw.withColumn("profile", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))
