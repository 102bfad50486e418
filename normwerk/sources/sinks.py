"""Writing: versioned tables with a pointer, first-wins inserts, upserts, CSV by label and load statements."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import forms


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _replace(spark: SparkSession, fs, source, target) -> None:
    """One rename that replaces the target."""
    jvm = spark.sparkContext._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(source, target, how)


def publish(tables: dict[str, DataFrame], path: str, folders: dict[str, list[str]] | None = None) -> str:
    """Write all tables of an index to a new version and then point to it; a failure leaves the old version current.

    ``folders``: the columns by which a table is laid out in folders.
    """
    spark = next(iter(tables.values())).sparkSession
    version = uuid.uuid4().hex
    for name, df in tables.items():
        by = (folders or {}).get(name, [])
        laid = df.repartition(*by) if by else df  # one file a folder
        laid.write.partitionBy(*by).parquet(f"{path}/versions/{version}/{name}")
    fs, pointer, jvm = _fs(spark, f"{path}/CURRENT")
    temporary = jvm.org.apache.hadoop.fs.Path(f"{path}/CURRENT.{version}")
    out = fs.create(temporary, True)
    out.write(bytearray(version.encode()))
    out.close()
    _replace(spark, fs, temporary, pointer)  # so that there is an index at any time
    return version


def current(spark: SparkSession, path: str, name: str) -> DataFrame:
    version = spark.read.text(f"{path}/CURRENT").first()[0].strip()
    return spark.read.parquet(f"{path}/versions/{version}/{name}")


def first_wins(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; later ones are left out."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """old with the rows of new in place of those of the same key."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)


def continue_positions(old: DataFrame, new: DataFrame, group: str, position: str, order: list[str]) -> DataFrame:
    """new with positions that go on after the last of the same group in old."""
    last = old.groupBy(group).agg(F.max(position).alias("_last"))
    n = F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1
    return new.withColumn("_n", n).join(last, group, "left").withColumn(position, F.coalesce(F.col("_last") + 1, F.lit(0)) + F.col("_n")).drop("_n", "_last")


def _scalar(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() not in ("array", "map", "struct", "variant") and not f.name.endswith("_json")]


def write_csv(nodes: DataFrame, path: str, by: str, first: tuple[str, ...] = ()) -> None:
    """One folder of CSV files a label or type: the columns of ``first``, then the others in order. Values of arrays and structs are
    left out, as they have no place in a CSV."""
    scalar = _scalar(nodes)
    columns = [c for c in first if c in scalar] + sorted(c for c in scalar if c not in first)
    nodes.select(*columns).write.partitionBy(by).option("header", "true").option("escape", '"').csv(path)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, size) of every file below a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


def load_statements(nodes: DataFrame, by: str, key: str, columns: list[str], batch: int = 5000) -> list[str]:
    """Statements that make each label's key unique and load its CSV files into a graph database, label by label, read from the
    cluster part by part."""
    labels = sorted(r[0] for r in nodes.select(by).where(F.col(by).isNotNull()).distinct().toLocalIterator())
    fields = ", ".join(f"{c}: row.{c}" for c in columns)
    unique = [f"CREATE CONSTRAINT IF NOT EXISTS FOR (n:{x}) REQUIRE n.{key} IS UNIQUE;" for x in labels]
    load = [f"LOAD CSV WITH HEADERS FROM 'file:///{by}={x}.csv' AS row CALL {{ WITH row MERGE (n:{x} {{{key}: row.{key}}}) SET n += {{{fields}}} }} IN TRANSACTIONS OF {batch} ROWS;" for x in labels]
    return unique + load


def edge_statements(graph_edges: DataFrame, by: str, key: str, batch: int = 5000) -> list[str]:
    """The same for the edges of each type, between nodes that are there."""
    types = sorted(r[0] for r in graph_edges.select(by).where(F.col(by).isNotNull()).distinct().toLocalIterator())
    return [f"LOAD CSV WITH HEADERS FROM 'file:///{by}={x}.csv' AS row CALL {{ WITH row MATCH (a {{{key}: row.start_node_id}}) MATCH (b {{{key}: row.end_node_id}}) MERGE (a)-[:{x}]->(b) }} IN TRANSACTIONS OF {batch} ROWS;" for x in types]


def inline_statements(nodes: DataFrame, by: str, key: str, columns: list[str], batch: int = 500, spread: int = 64) -> DataFrame:
    """(label, part, batch_no, statement): nodes as literal maps, ``batch`` in a statement, made by the cluster.

    The rows of a label are spread by their key, so that one label's statements are not made by one task.
    """
    pairs = [F.concat(F.lit(f"{c}: "), F.when(F.col(c).isNull(), F.lit("null")).otherwise(forms.cypher_text(F.col(c).cast("string")))) for c in (key, *columns)]
    rows = nodes.where(F.col(by).isNotNull() & F.col(key).isNotNull()).select(F.col(by).alias("label"), F.col(key).alias("_k"), F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}")).alias("_m"))
    part = F.pmod(F.xxhash64("_k"), F.lit(spread)).cast("int")
    placed = rows.withColumn("part", part).withColumn("_n", F.row_number().over(Window.partitionBy("label", "part").orderBy("_k")))
    grouped = placed.groupBy("label", "part", F.floor((F.col("_n") - 1) / batch).cast("int").alias("batch_no")).agg(F.array_sort(F.collect_list(F.struct("_k", "_m"))).alias("_r"))
    maps = F.array_join(F.transform("_r", lambda x: x["_m"]), ", ")
    return grouped.select("label", "part", "batch_no", F.concat(F.lit("UNWIND ["), maps, F.lit("] AS row MERGE (n:"), "label", F.lit(f" {{{key}: row.{key}}}) SET n += row;")).alias("statement"))


def write_graph(nodes: DataFrame, graph_edges: DataFrame, path: str) -> dict:
    """Nodes and edges as one version, with the counts by label and type."""
    version = publish({"nodes": nodes, "edges": graph_edges}, path)
    spark = nodes.sparkSession
    counts = lambda name, by: {r[0]: r[1] for r in current(spark, path, name).groupBy(by).count().collect()}  # noqa: E731  # one row a label or type
    return {"version": version, "labels": counts("nodes", "label"), "types": counts("edges", "type")}


def cache_misses(asked: DataFrame, cache: DataFrame) -> DataFrame:
    """(profile, purpose, text_hash, text) of what is not in the cache, each once. asked(profile, purpose, text)."""
    keyed = asked.where("text is not null").withColumn("text_hash", F.sha2("text", 256)).dropDuplicates(["profile", "purpose", "text_hash"])
    return keyed.join(cache.select("profile", "purpose", "text_hash"), ["profile", "purpose", "text_hash"], "left_anti").select("profile", "purpose", "text_hash", "text")


def write_copies(df: DataFrame, path: str, formats: tuple[str, ...] = ("parquet", "json", "csv")) -> None:
    """A register in several formats; a CSV has its scalar columns."""
    for f in formats:
        (df.select(*_scalar(df)) if f == "csv" else df).write.format(f).option("header", "true").save(f"{path}/{f}")


def publish_pages(pages: DataFrame, path: str) -> DataFrame:
    """Pages by the hash of their content: contents that are there already are not written again; -> (document_id, page, sha256)."""
    spark = pages.sparkSession
    keyed = pages.withColumn("sha256", F.sha2(F.col("text").cast("binary"), 256))
    new = keyed.select("sha256", "text").dropDuplicates(["sha256"])
    fs, target, _ = _fs(spark, path)
    if fs.exists(target):
        new = new.join(spark.read.parquet(path).select("sha256"), "sha256", "left_anti")
    new.write.mode("append").parquet(path)
    return keyed.select("document_id", "page", "sha256")


def orphan_pages(stored: DataFrame, references: DataFrame) -> DataFrame:
    """Stored contents that no page refers to."""
    return stored.select("sha256").distinct().join(references.select("sha256"), "sha256", "left_anti")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, a manifest or report, put in place by one rename."""
    fs, target, jvm = _fs(spark, path)
    temporary = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(temporary, True)
    out.write(bytearray(text.encode()))
    out.hsync()
    out.close()
    _replace(spark, fs, temporary, target)


def append_journal(records: DataFrame, path: str) -> None:
    """One line of JSON a record, in a file of its own that is never changed; ``registers.journal`` reads all of them."""
    records.select(F.to_json(F.struct(*records.columns)).alias("value")).write.mode("append").text(path)


def markdown(findings: DataFrame, title: str) -> str:
    """A report of an audit: a line a code, of which there are few."""
    rows = findings.orderBy(F.col("occurrences").desc(), "code").collect()
    head = [f"# {title}", "", f"{len(rows)} codes, {sum(r.occurrences for r in rows)} occurrences", "", "| Code | Occurrences | Examples |", "| --- | --- | --- |"]
    return "\n".join(head + [f"| {r.code} | {r.occurrences} | {r.examples} |" for r in rows]) + "\n"


def rendered(chunks: DataFrame) -> DataFrame:
    """(document_id, place, html) of chunks(document_id, place, label, text, columns, rows): texts as paragraphs, tables as tables,
    those of more than 12 columns as lists of labels and values."""
    cell = lambda tag: lambda x: F.concat(F.lit(f"<{tag}>"), forms.html_text(F.coalesce(x, F.lit(""))), F.lit(f"</{tag}>"))
    row = lambda tag, xs: F.concat(F.lit("<tr>"), F.array_join(F.transform(xs, cell(tag)), ""), F.lit("</tr>"))
    grid = F.concat(F.lit("<table>"), row("th", F.col("columns")), F.array_join(F.transform("rows", lambda r: row("td", r)), ""), F.lit("</table>"))
    pair = lambda r: F.transform(F.arrays_zip(F.col("columns").alias("c"), r.alias("v")), lambda x: F.concat(F.lit("<dt>"), forms.html_text(F.coalesce(x["c"], F.lit(""))), F.lit("</dt><dd>"), forms.html_text(F.coalesce(x["v"], F.lit(""))), F.lit("</dd>")))
    listed = F.concat(F.lit("<dl>"), F.array_join(F.flatten(F.transform("rows", pair)), ""), F.lit("</dl>"))
    body = F.when(F.col("rows").isNull(), F.concat(F.lit("<p>"), forms.html_text(F.coalesce("text", F.lit(""))), F.lit("</p>"))).when(F.size("columns") > 12, listed).otherwise(grid)
    return chunks.select("document_id", "place", F.concat(F.lit("<h3>"), forms.html_text(F.coalesce("label", F.lit(""))), F.lit("</h3>"), body).alias("html"))


def store_runs(runs: DataFrame, path: str) -> None:
    """Each run in a folder of its own, which a later state of it replaces and others leave alone; for ``foreachBatch`` too."""
    runs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
