"""Ranked full-text search by BM25 without a stored index: one scan gives term frequencies, lengths and totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import normalize as N

K1, B = 1.2, 0.75


def _scanned(texts: DataFrame, text: str, terms: list[str]) -> DataFrame:
    bag = texts.withColumn("_tokens", F.coalesce(N.tokens(F.col(text)), F.array().cast("array<string>")))
    times = lambda t: F.size(F.filter("_tokens", lambda x: x == F.lit(t)))
    return bag.withColumns({"_dl": F.size("_tokens"), **{f"_tf{i}": times(t) for i, t in enumerate(terms)}}).drop("_tokens")


def bm25(texts: DataFrame, id_column: str, text: str, query: str, scope: Column | None = None, mode: str = "auto", limit: int = 10) -> DataFrame:
    """The ``limit`` best texts for the query's terms, with a score (lower is better), rank and the relation used.

    mode ``and`` demands all terms, ``or`` any, ``auto`` all and, only if nothing inside the scope has all, any. Document
    frequencies and lengths are those of all texts. Ties go by id. Null texts count as empty. No term gives no row.
    """
    spark = texts.sparkSession
    terms = list(dict.fromkeys(spark.range(1).select(N.tokens(F.lit(query))).first()[0]))
    scanned = _scanned(texts, text, terms)
    totals = scanned.agg(F.count(F.lit(1)).alias("_n"), F.avg("_dl").alias("_avg"), *[F.count_if(F.col(f"_tf{i}") > 0).alias(f"_df{i}") for i in range(len(terms))])
    rows = scanned.where(scope) if scope is not None else scanned
    any_term = [F.col(f"_tf{i}") > 0 for i in range(len(terms))] or [F.lit(False)]
    has_any, has_all = any_term[0], any_term[0]
    for c in any_term[1:]:
        has_any, has_all = has_any | c, has_all & c
    hits = rows.where(has_any).crossJoin(F.broadcast(totals))  # one row of totals

    score = F.lit(0.0)
    for i in range(len(terms)):
        n, tf = F.col(f"_df{i}"), F.col(f"_tf{i}").cast("double")
        idf = F.log((F.col("_n") - n + 0.5) / (n + 0.5))
        idf = F.when(idf <= 0, F.lit(1e-6)).otherwise(idf)
        score = score + F.when(tf > 0, idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("_dl") / F.col("_avg")))).otherwise(0.0)
    scored = hits.select(F.col(id_column), (-F.round(score, 6)).alias("score"), has_all.alias("_all"))
    if mode == "and":
        scored = scored.where("_all")
    elif mode == "auto":
        # one more row of totals: whether anything has all terms
        scored = scored.crossJoin(F.broadcast(scored.agg(F.max("_all").alias("_some")))).where("_all or not _some").drop("_some")
    best = scored.orderBy("score", id_column).limit(limit)
    return best.select(id_column, "score", F.row_number().over(Window.orderBy("score", id_column)).alias("rank"), F.when(F.col("_all"), "and").otherwise("or").alias("relation"))


def idf(texts: DataFrame, text: str) -> DataFrame:
    """Document frequency of each term and ln((N + 1) / (df + 1)) + 1."""
    total = texts.agg(F.count(F.lit(1)).alias("n"))
    each = texts.select(F.explode(F.array_distinct(N.tokens(F.col(text)))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return each.crossJoin(F.broadcast(total)).select("term", "df", F.round(F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1, 6).alias("idf"))
