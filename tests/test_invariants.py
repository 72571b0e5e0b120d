"""The invariant queries see wrong fits and wrong partitions; records keep their white space through CSV."""

from pyspark.sql import functions as F

from prismark.operators import cluster as cl, graph as gr
from prismark.sinks.export import write_records
from prismark.sources.records import read_or_empty


def test_fit_invariants_count_what_is_wrong(spark):
    points = [([0.0, 0.0], 0), ([0.0, 2.0], 0), ([9.0, 9.0], 1), ([9.0, 11.0], 1)]
    df = spark.createDataFrame(points, "v array<double>, cluster int")
    right = spark.createDataFrame([(0, [0.0, 1.0]), (1, [9.0, 10.0])], "label int, centroid array<double>")
    assert tuple(cl.fit_invariants(df, "v", right, "cluster", 0.01).first()) == (4, 2, 0, 0)
    moved = df.withColumn("cluster", F.when(F.col("v")[1] == 2.0, 1).otherwise(F.col("cluster")))
    assert tuple(cl.fit_invariants(moved, "v", right, "cluster", 0.01).first()) == (4, 2, 1, 2)
    off = spark.createDataFrame([(0, [0.0, 1.5]), (1, [9.0, 10.0])], "label int, centroid array<double>")
    assert tuple(cl.fit_invariants(df, "v", off, "cluster", 0.01).first()) == (4, 2, 0, 1)


def test_community_invariants_see_bad_partitions(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("x", "y"), ("y", "z"), ("x", "z"), ("c", "x")], "a string, b string")
    good = spark.createDataFrame([(n, "abc" if n in "abc" else "xyz") for n in "abcxyz"], "node string, community string")
    assert tuple(gr.community_invariants(edges, good).first()) == (6, 0, 0, True)
    bad = spark.createDataFrame([(n, n) for n in "abcxyz"], "node string, community string")
    assert tuple(gr.community_invariants(edges, bad).first()) == (6, 0, 0, False)
    assert gr.community_invariants(edges, good.unionByName(good.where("node = 'a'"))).first()["repeated"] == 1


def test_choose_k_uses_the_settings_of_kmeans(spark):
    rows = [([0.3 * (k // 3) + 50 * (k % 3), float(k % 3)],) for k in range(30)]  # three groups of ten evenly spread points
    df = spark.createDataFrame(rows, "v array<double>")
    table = cl.choose_k(df, "v", range(2, 5), n_init=2)
    assert [r["best_k"] for r in table.collect()] == [3, 3, 3]


def test_csv_keeps_white_space_quotes_and_breaks(spark, tmp_path):
    rows = [("1", "  led by\n a break ", 'said "x", then'), ("2", "\ttab", None), ("3", "é,ü", "a\n\n\"b\"")]
    df = spark.createDataFrame(rows, "ID string, Title string, Abstract string")
    assert write_records(df, str(tmp_path / "out"), "csv")
    got = read_or_empty(spark, str(tmp_path / "out")).orderBy("ID").collect()
    assert [tuple(r) for r in got] == rows
    assert not write_records(df.limit(0), str(tmp_path / "none"), "csv")
    assert read_or_empty(spark, str(tmp_path / "none")).count() == 0
