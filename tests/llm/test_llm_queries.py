"""Registered queries against their SQL on the smallest tables, and the pipeline's stages against their own definitions."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from sparklogs.llm import jaccard_join, secret_scan
from sparklogs.llm.queries import QUERIES, SQL

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = QUERIES[name](spark, sf)
    names = sorted(df.columns)
    expected = con.sql(f"SELECT {', '.join(names)} FROM ({SQL[name]}) q").fetchall()
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(expected)


def test_all_are_registered():
    known = entry.queries()
    assert {n.split("_")[0] for n in known if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    assert known["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("stored", [False, True])
def test_copies_go_by_row(spark, sf, tmp_path, stored):
    """Repeated and null ids: one row of each text, and of each group of near copies, stays."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    near = f"{a} more"
    rows = [(1, a), (1, a), (None, a), (2, a), (2, b), (None, c), (None, c), (3, near), (None, near)]
    docs = spark.createDataFrame([(i, t, "en", "x", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    if stored:
        docs.write.parquet(f"{tmp_path}/docs")
        docs = spark.read.parquet(f"{tmp_path}/docs")
    stay = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    assert stay(corpus_pipeline.copies_out(spark, docs, sf)) == sorted([(1, a), (2, b), (None, c), (3, near)], key=str)
    assert stay(corpus_pipeline.near_copies_out(spark, docs, sf)) == sorted([(1, a), (2, b), (None, c)], key=str)


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
        assert docs.columns == columns
    rows = {r.doc_id: r for r in docs.collect()}
    assert all(r.n_chars == len(r.text) for r in rows.values())
    assert all(secret_scan.scan(r.text) == [] for r in rows.values())
    groups = jaccard_join.jaccard_components(docs.select("doc_id", "text"), 80, 5).collect()
    assert all(r.component_id == r.doc_id for r in groups)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in packed} == set(rows)
    assert len(corpus_pipeline.run(spark, sf).collect()) == len(packed)


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_rows(spark, sf, empty):
    """Nulls, empty and long texts, repeats, and columns whose names the operators use themselves."""
    long = " ".join(f"w{k}" for k in range(30_000))
    rows = [(1, None), (1, None), (2, ""), (None, "no id"), (3, "a b"), (3, "a b"), (4, long), (5, f"{long} tail"), (6, "the token: abcdef123456 is here"), (None, None)]
    clash = "doc_id long, text string, id string, row string, node string, component_id string, kept string, digest string, group_size string, length string, _shard0 string, sequence_no string"
    docs = spark.createDataFrame([] if empty else [(i, t, *["x"] * 10) for i, t in rows], clash).repartition(3)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stage(spark, docs, sf)
        seen[name] = docs.collect()
        if name != "best-fit packing":
            assert docs.columns == columns
            docs = spark.createDataFrame(seen[name], docs.schema)
    texts = lambda name: sorted((str(r.doc_id), r.text or "") for r in seen[name])
    if empty:
        assert not any(seen.values())
        return
    assert len(seen["toxicity"]) == len(rows)
    stay = [("1", ""), ("3", "a b"), ("4", long), ("5", f"{long} tail"), ("6", "the token: abcdef123456 is here"), ("None", "no id")]
    assert texts("exact dedup") == stay
    assert texts("n-gram jaccard join") == [s for s in stay if s[0] != "5"]
    assert [t for i, t in texts("secret scans") if i == "6"] == ["the [SECRET] is here"]
    assert {r.doc_id for r in seen["best-fit packing"]} == {1, 3, 4, 6, None}
