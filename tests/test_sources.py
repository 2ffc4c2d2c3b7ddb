"""Catalogue reads, joins for hot keys, written tables, components and the stream."""

import random

import pytest
from pyspark.sql import functions as F

from strataform import runtime
from strataform.operators.components import connected_components
from strataform.operators.dedup import keep_first
from strataform.sources import catalog
from strataform.streaming import ingest


def test_latest_upsert_ensure(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "y"), ("b", None, "z"), (None, 1, "n")], "id string, at int, v string")
    assert {(r.id, r.v) for r in catalog.latest(rows, "id", "at").collect()} == {("a", "y"), ("b", "z"), (None, "n")}
    new = spark.createDataFrame([("a", 9, "new"), ("c", 9, "new")], rows.schema)
    assert {(r.id, r.v) for r in catalog.upsert(catalog.latest(rows, "id", "at").where("id is not null"), new, ["id"]).collect()} == {("a", "new"), ("b", "z"), ("c", "new")}
    known = spark.createDataFrame([("r1", "u1")], "id string, url string")
    got = catalog.ensure_resources(known, spark.createDataFrame([("u1",), ("u2",), ("u2",), (None,)], "url string")).collect()
    assert len(got) == 2 and {r.url for r in got} == {"u1", "u2"}
    assert catalog.latest(rows.limit(0), "id", "at").count() == 0


def test_find_any_and_keep_first(spark):
    table = spark.createDataFrame([("a", None, 1), ("b", "x", 2), ("x", "x", 3)], "k1 string, k2 string, v int")
    wanted = spark.createDataFrame([("x",), ("x",), ("q",)], "id string")
    assert sorted(r.v for r in catalog.find_any(table, wanted, ["k1", "k2"]).collect()) == [2, 3]
    rows = spark.createDataFrame([(2, "s"), (1, "s"), (3, None), (4, None)], "id int, sum string")
    assert sorted(r.id for r in keep_first(rows, "sum", ["id"]).collect()) == [1, 3, 4]


def test_read_payloads(spark, tmp_path):
    (tmp_path / "a.html").write_bytes(b"<p>x</p>")
    (tmp_path / "b.txt").write_bytes(b"y")
    rows = catalog.read_payloads(spark, str(tmp_path)).collect()
    assert sorted(r.size_bytes for r in rows) == [1, 8] and catalog.read_payloads(spark, str(tmp_path), "*.txt").count() == 1


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_equals_plain_join(spark, how):
    left = spark.createDataFrame([("hot", i) for i in range(50)] + [("k", 1), ("gone", 2), (None, 3)], "key string, n int")
    right = spark.createDataFrame([("hot", "H"), ("k", "K"), ("other", "O")], "id string, v string")
    counts = left.groupBy(F.col("key").alias("id")).agg(F.count("*").alias("c"))
    hot = right.join(runtime.hot_rows(counts, "c", 400), "id", "left_semi")
    assert hot.count() == 1
    want = left.join(right.withColumnRenamed("id", "key"), "key", how)
    got = runtime.lookup_join(left, "key", right, "id", hot, how)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_stored_tables(spark):
    stored = runtime.store(spark.range(5).toDF("x"), "test")
    assert stored.path.startswith(spark.conf.get("spark.checkpoint.dir")) and stored.df.count() == 5 and stored.size_bytes() > 0
    stored.drop()
    with pytest.raises(Exception):  # noqa: B017
        stored.df.count()


def test_components_equal_union_find(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(100 + i, 101 + i) for i in range(40)] + [(200, 200 + i) for i in range(1, 30)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    frame = spark.createDataFrame(edges, "u long, v long")
    assert {(r.group_id, r.id) for r in connected_components(frame).collect()} == {(find(x), x) for x in parent}
    assert connected_components(frame.limit(0)).count() == 0


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([(1, "one text"), (2, "one text  "), (3, "two")], "doc_id long, text string").withColumn("fetched_at", F.timestamp_seconds(F.lit(1_900_000_000)))
    rows.write.parquet(str(tmp_path / "in"))
    stream = ingest.normalized_stream(ingest.read_documents(spark, str(tmp_path / "in"), rows.schema))
    ingest.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    assert sorted(r.normalized_text for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["one text\n", "two\n"]
