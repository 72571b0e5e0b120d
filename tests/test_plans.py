"""Plan checks: Python only where it is meant to be, no pair-all joins."""

import pytest

import __spark_entry__ as E
from prismark.plans import catalog

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapCoGroupsInPandas", "FlatMapGroupsInPandas")
PAIR_ALL = ("CartesianProduct", "BroadcastNestedLoopJoin")
# S5 result pages, P6 user scorer, X2 title ratio (J4/J5), M9 block kernel (and M10 on top of it)
PYTHON_ALLOWED = {"scholar_results", "scored_screening", "title_match", "enrich_records", "knn_embeddings",
                  "density_clusters"}
# the corpus operators have their own style rules and their own tests in tests/llm
# queries whose construction runs Spark jobs (iterative operators, MLlib fits) are checked by their tests
SKIP = {"communities_top30", "kmeans_clusters", "choose_k", "pca_embeddings", "density_clusters", "knn_embeddings",
        "density_hierarchy"}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - SKIP))
def test_plan(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in PAIR_ALL:
        assert node not in plan, f"{name} plans a {node}"
    if name not in PYTHON_ALLOWED:
        for node in PYTHON_NODES:
            assert node not in plan, f"{name} runs Python ({node})"


def _scan_lines(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [ln for ln in plan.split("\n") if "FileScan parquet" in ln]


def test_scans_read_only_needed_columns(spark):
    # the flagship reads doc_id, text and source; never lang or n_chars
    for ln in _scan_lines(E.queries()["decades_after_dedup"](spark, SF)):
        assert "lang" not in ln and "n_chars" not in ln, ln
    # the co-author graph reads three lineitem columns out of eleven
    for ln in _scan_lines(E.queries()["coauthor_edges"](spark, SF)):
        assert "l_extendedprice" not in ln and "l_shipdate" not in ln, ln


def test_filter_reaches_the_scan(spark):
    lines = _scan_lines(E.queries()["documents_of_topic"](spark, SF))
    assert lines and all("PushedFilters: [IsNotNull(label), EqualTo(label,3)]" in ln for ln in lines), lines
