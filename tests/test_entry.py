import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from normwerk.durable import materialize, release, shared_folder
from normwerk.plans import audits, forms, problems, reference, rollups, service, validators
from normwerk.skew import salted_left_join

ROOT = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings register_documents aliases structural_units chunks refers_to_edges passage_vectors raw_payloads core_laws eval_cases mix_targets".split()


MODULES = (reference, audits, forms, problems, rollups, service, validators)


def test_contract(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 60
    modules = [m.QUERIES for m in MODULES]
    assert sum(map(len, modules)) == len(set().union(*modules))
    assert entry.entry(spark).count() > 0


def plain(df):
    """Rows as sorted texts: columns by name, numbers to nine digits, every kind of null alike."""

    def text(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "-"
        if isinstance(v, bool) or type(v).__name__ == "bool":
            return str(bool(v))
        if isinstance(v, float) or type(v).__name__.startswith("float"):
            return f"{float(v):.9g}"
        return str(list(v)) if type(v).__name__ == "ndarray" else str(int(v)) if type(v).__name__.startswith(("int", "uint")) else str(v)

    df = df[sorted(df.columns)]
    return sorted(tuple(map(text, row)) for row in zip(*(df[c].tolist() for c in df.columns)))


@pytest.mark.parametrize("name", [name for m in MODULES for name in m.SQL])
def test_sql_agrees(spark, name):
    """The rows of each query with those of its SQL, on the smallest data."""
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{ROOT}/{t}.parquet'")
    want = db.execute(entry.oracle_sql()[name]).fetchdf()
    got = entry.queries()[name](spark, ROOT).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    # a column without any value may be read as another type
    assert plain(got) == plain(want)


def test_materialize(spark):
    df = spark.range(10).selectExpr("id", "id % 3 as k")
    kept = materialize(df, "t")
    assert kept.schema.names == ["id", "k"] and sorted(r.id for r in kept.collect()) == list(range(10))
    assert materialize(df.limit(0), "t").count() == 0
    assert shared_folder(spark)
    release([])


def test_shared_folder_is_demanded_on_a_cluster(spark, monkeypatch):
    from normwerk import durable

    class Conf:
        get = staticmethod(lambda *a: None)

    class Cluster:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getConf = staticmethod(lambda: Conf)

            class _jsc:  # noqa: N801
                sc = staticmethod(spark.sparkContext._jsc.sc)

        conf = Conf

    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            durable.shared_folder(Cluster)


def test_salted_join(spark):
    left = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 0 else id % 50 end as k")
    right = spark.range(0, 60).selectExpr("id as k", "id * 10 as v")
    from pyspark.sql import functions as F

    plain = sorted(tuple(r) for r in left.join(right, "k", "left").select("id", "k", "v").collect())
    salted = salted_left_join(left, right, ["k"], [F.col("id")], hot_rows=100).select("id", "k", "v").collect()
    assert sorted(tuple(r) for r in salted) == plain


def test_hops_of_every_law(spark):
    db = duckdb.connect()
    law_keys = [k for (k,) in db.execute(f"select distinct law_key from '{ROOT}/core_laws.parquet' where law_key is not null").fetchall()]
    latest = f"select unit_id, arg_max(document_id, loaded_at) as document_id, arg_max(document_key, loaded_at) as document_key from '{ROOT}/structural_units.parquet' group by 1"
    edges = db.execute(f"select distinct u.document_key, r.target_document_key from '{ROOT}/refers_to_edges.parquet' r join ({latest}) u on u.document_id = r.source_document_id where r.target_document_key is not null and u.document_key is not null").fetchall()
    after = {}
    for a, b in edges:
        after.setdefault(a, set()).add(b)
    want = set()
    for start in law_keys:
        seen, front = {start}, {start}
        for d in (1, 2):
            front = {b for a in front for b in after.get(a, ())} - seen
            seen |= front
            want |= {(start, b, d) for b in front}
    got = [(r.start_id, r.node_id, r.distance) for r in reference.k_hop_documents(spark, ROOT).collect()]
    assert set(got) == want and len(got) == len(want)
    assert len({a for a, _, _ in want}) > 1


def test_blind_order_places_every_document(spark):
    import hashlib

    docs = [r.doc_id for r in spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id").collect()]
    want = sorted((hashlib.sha256(str(i).encode()).hexdigest(), i) for i in docs)
    assert [(r.doc_id, r.blind_key) for r in audits.blind_order(spark, ROOT).collect()] == [(i, h[:16]) for h, i in want] and len(want) > 50
