"""N2, N3, N5, N6 hand cases; clustering properties; J4 against brute force."""

import itertools
import random

from pyspark.sql import functions as F

from prismark.functions.similarity import PackedTitles, TitleBlock, indel_ratio, lcs_length
from prismark.operators import cluster as cl
from prismark.operators import enrich as en
from prismark.operators import graph as gr


def test_edges_by_position(spark):
    df = spark.createDataFrame([(1, "A; B; C"), (2, "A; A")], "id long, Authors string")
    p = gr.author_positions(df, "id", "Authors")
    e = {(r.a, r.b): r.weight for r in gr.coauthor_edges(p).collect()}
    assert e == {("A", "B"): 1, ("A", "C"): 1, ("B", "C"): 1, ("A", "A"): 1}


def test_salted_edges_equal_plain_pairs(spark):
    rows = [(1, "; ".join(f"a{i}" for i in range(150))), (2, "a1; a2; a3")]
    df = spark.createDataFrame(rows, "id long, Authors string")
    p = gr.author_positions(df, "id", "Authors")
    got = {(r.a, r.b): r.weight for r in gr.coauthor_edges(p, block=16).collect()}
    want = {}
    for _, s in rows:
        for x, y in itertools.combinations(s.split("; "), 2):
            k = (min(x, y), max(x, y))
            want[k] = want.get(k, 0) + 1
    assert got == want


def test_stats_and_modularity(spark):
    nodes = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "author string, publications long")
    edges = spark.createDataFrame([("a", "b", 1), ("b", "c", 1)], "a string, b string, weight long")
    st = gr.graph_stats(nodes, edges).first()
    assert (st.nodes, st.edges, st.density) == (3, 2, 0.666667)
    tri = [("a", "b"), ("b", "c"), ("a", "c"), ("d", "e"), ("e", "f"), ("d", "f")]
    e2 = spark.createDataFrame([(x, y, 1) for x, y in tri], "a string, b string, weight long")
    lab = spark.createDataFrame([(n, 0 if n in "abc" else 1) for n in "abcdef"], "node string, community int")
    assert gr.modularity(e2, lab).first().modularity == 0.5
    comm = {r.node: r.community for r in gr.communities(e2).collect()}
    alone = spark.createDataFrame([("a",), ("z",)], "author string")
    assert {r.node: r.community for r in gr.communities(e2, alone).collect()} == comm | {"z": "z"}
    assert len({comm[n] for n in "abc"}) == 1 and len({comm[n] for n in "def"}) == 1 and comm["a"] != comm["d"]


def test_lcs_and_ratio():
    assert lcs_length("kitten", "sitting") == 4
    assert indel_ratio("kitten", "sitting") == 62 and indel_ratio("abc", "abc") == 100
    assert indel_ratio("ab", "ba") == indel_ratio("ba", "ab")


def test_title_match_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", F.split_part("text", F.lit("\n"), F.lit(1)).alias("t"),
        (F.substring("source", 4, 10).cast("int") % 2 == 0).alias("primary")).toPandas()
    recs = docs[~docs.primary][["doc_id", "t"]]
    works = docs[docs.primary][["doc_id", "t"]]
    want = {}
    for rid, rt in zip(recs.doc_id, recs.t):
        if len(rt) < 10:
            continue
        best = None
        for wid, wt in zip(works.doc_id, works.t):
            r = indel_ratio(rt.lower(), wt.lower())
            if r > 80 and (best is None or r > best[1] or (r == best[1] and wid < best[0])):
                best = (wid, r)
        if best:
            want[rid] = best
    r_df = spark.createDataFrame(recs).withColumnRenamed("doc_id", "article_id").withColumnRenamed("t", "Title")
    w_df = spark.createDataFrame(works).withColumnRenamed("doc_id", "work_id").withColumnRenamed("t", "title")
    got = {r.article_id: (r.work_id, r.ratio) for r in en.match_by_title(r_df, w_df).collect()}
    assert got == want and len(want) > 0


def test_title_match_finds_what_no_common_word_shows(spark):
    works = [
        (1, "neural networks for strokes"), (2, "Neural Networks for Strokes"), (3, "abcdefghijklmnopqrst"), (4, None), (5, ""),
        (6, "x" * 3000), (7, "日本語の題名についての研究報告"), (8, "a title that nobody has"), (9, "short"), (10, "  neural nets"),
    ]
    records = [
        (1, "neurol netwerks fur strikes"), (2, "NEURAL NETWORKS FOR STROKES"), (3, "abxcdefgyhijklzmnopqrst"), (4, None), (5, "neural"),
        (6, "x" * 2990 + "y" * 700), (7, "日本語の題名についてのご研究報告"), (8, "quite another thing"), (9, "shortshort"), (10, "😀" * 12),
        *((100 + k, "neural networks for strokes") for k in range(40)),
    ]
    want = {}
    for rid, rt in records:
        if rt and len(rt) >= 10:
            found = [(-indel_ratio(rt.lower(), wt.lower()), wid) for wid, wt in works if wt is not None]
            ratio, wid = min(found)
            if -ratio > 80:
                want[rid] = (wid, -ratio)
    assert {1, 2, 3, 6, 7, 100, 139} <= set(want)
    r_df = spark.createDataFrame(records, "article_id long, Title string")
    w_df = spark.createDataFrame(works, "work_id long, title string")
    got = {r.article_id: (r.work_id, r.ratio) for r in en.match_by_title(r_df, w_df).collect()}
    assert got == want
    assert en.match_by_title(r_df.limit(0), w_df).collect() == en.match_by_title(r_df, w_df.limit(0)).collect() == []


def test_title_blocks_equal_single_comparisons():
    rnd = random.Random(5)
    titles = ["".join(rnd.choice("abc d") for _ in range(rnd.choice([0, 1, 5, 40, 41, 45]))) for _ in range(300)]
    titles += [t[:20] + "x" + t[20:] for t in titles[:80]]
    assert PackedTitles(titles).lcs("abc dabcd").tolist() == [lcs_length(t, "abc dabcd") for t in titles]
    block = TitleBlock(titles, list(range(len(titles))), pack_chars=200)
    for other in titles[::7]:
        for least in (0, 60, 80, 95):
            scores = [indel_ratio(t, other) for t in titles]
            top = max(scores)
            assert block.best(other, least) == ((scores.index(top), top) if top > least else None)


def test_title_bounds_rule_out_titles_of_the_same_letters():
    rnd = random.Random(7)
    letters = "eeeeetttaaaooiinnsshhrdlucmfwygpb     "
    titles = ["".join(rnd.choice(letters) for _ in range(rnd.randint(280, 320))) for _ in range(200)]
    others = ["".join(rnd.choice(letters) for _ in range(300)) for _ in range(20)]
    block = TitleBlock(titles, list(range(200)))
    assert block.best_of_each(others, 80) == [None] * 20
    assert not any(block.packs)  # no title was compared whole


def test_title_blocks_equal_single_comparisons_over_long_and_foreign_titles():
    rnd = random.Random(11)
    for letters in ("ab", "abcdefghijklmnopqrstuvwxyz \u00e9\u00fc", [chr(0x4E00 + k) for k in range(300)] + list("ab \ud800\U0001f600")):
        titles = ["".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 62, 63, 64, 90, 600, 1300]))) for _ in range(80)]
        titles += ["".join(c for c in t if rnd.random() > 0.1) for t in titles[:60]]
        others = ["".join(c if rnd.random() > 0.08 else rnd.choice(letters) for c in t) for t in titles[::4]] + ["", "zzz", titles[5]]
        scores = [[indel_ratio(t, other) for t in titles] for other in others]
        block = TitleBlock(titles, list(range(len(titles))), pack_chars=3000)
        for least in (0, 50, 80, 95):
            want = [(row.index(max(row)), max(row)) if max(row) > least else None for row in scores]
            assert block.best_of_each(others, least) == want


def test_silhouette_and_nearest(spark):
    pts = [(0, [0.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [10.0, 10.0], 1), (3, [10.0, 11.0], 1)]
    df = spark.createDataFrame(pts, "id long, v array<double>, label int")
    s = cl.silhouette_sqeuclidean(df, "v", "label").first().silhouette
    want = (2 * 209.5 / 210.5 + 2 * 189.5 / 190.5) / 4  # squared distances, worked by hand
    assert abs(s - want) < 1e-6
    cents = cl.centroids_from_labels(df, "v", "label")
    got = {r.id: r.cluster for r in cl.assign_nearest(df, "v", cents).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 1}


def _brute_knn(rows, k, cosine=False):
    import math

    vecs = {}
    for i, v in rows:
        if cosine:
            n = math.sqrt(sum(x * x for x in v))
            v = [x / n for x in v]
        vecs[i] = v
    out = {}
    for i, a in vecs.items():
        ds = []
        for j, b in vecs.items():
            if i != j:
                acc = 0.0
                for x, y in zip(a, b):
                    acc += (x - y) * (x - y)
                ds.append((math.sqrt(acc), j))
        ds.sort()
        out[i] = [j for _, j in ds[:k]]
    return out


def test_knn_matches_brute_force_with_duplicates(spark):
    import random

    from prismark.operators import neighbors as nbr

    rnd = random.Random(7)
    hot = [rnd.random() for _ in range(8)]
    rows = [(i, list(hot)) for i in range(30)]  # one vector held by 30 rows
    rows += [(100 + i, [rnd.random() for _ in range(8)]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    for cosine in (False, True):
        got = nbr.knn(df, "id", "v", k=5, metric="cosine" if cosine else "euclidean", n_pivots=6, block=8)
        res = {}
        for r in got.collect():
            res.setdefault(r.id, []).append((r["rank"], r.neighbor))
        res = {i: [n for _, n in sorted(v)] for i, v in res.items()}
        want = _brute_knn(rows, 5, cosine)
        assert res == want


def test_knn_of_a_grid_in_many_tiles(spark):
    from prismark.operators import neighbors as nbr

    rows = [(10 * x + y, [float(x), float(y), 0.0]) for x in range(10) for y in range(9)]  # ties everywhere
    df = spark.createDataFrame(rows + [(None, [0.0, 0.0, 0.0]), (777, None)], "id long, v array<double>")
    for block in (16, 1 << 16):
        res = {}
        for r in nbr.knn(df, "id", "v", k=6, block=block).collect():
            res.setdefault(r.id, []).append((r["rank"], r.neighbor))
        assert {i: [n for _, n in sorted(v)] for i, v in res.items()} == _brute_knn(rows, 6, False)


def test_knn_of_copies_only_and_vectors_are_shipped_a_fixed_number_of_times(spark):
    from prismark.operators import neighbors as nbr

    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], "id long, v array<double>")
    got = sorted((r.id, r.neighbor, r["rank"]) for r in nbr.knn(df, "id", "v", k=2).collect())
    assert got == [(0, 1, 1), (0, 2, 2), (1, 0, 1), (1, 2, 2), (2, 0, 1), (2, 1, 2), (3, 0, 1), (3, 1, 2)]
    assert {nbr.blocks_of(n) for n in (20_000, 120_000, 500_000)} == {8}


def test_density_clusters_two_blobs(spark):
    import random

    from prismark.operators import neighbors as nbr

    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 0.1), rnd.gauss(0, 0.1)]) for i in range(20)]
    rows += [(100 + i, [rnd.gauss(5, 0.1), rnd.gauss(5, 0.1)]) for i in range(20)]
    rows += [(999, [50.0, 50.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    lab = {r.id: r.cluster for r in nbr.density_clusters(nbr.knn(df, "id", "v", k=5), 4, 2).collect()}
    assert lab[999] == -1
    from collections import Counter

    a = Counter(lab[i] for i in range(20)).most_common(1)[0]
    b = Counter(lab[100 + i] for i in range(20)).most_common(1)[0]
    assert a[0] != -1 and b[0] != -1 and a[0] != b[0]
    assert a[1] >= 15 and b[1] >= 15  # fringe points of a blob may be noise
    assert {lab[i] for i in range(20)} <= {a[0], -1} and {lab[100 + i] for i in range(20)} <= {b[0], -1}
