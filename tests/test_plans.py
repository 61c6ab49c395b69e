"""Plan checks: no cartesian products or Python UDF nodes, pushed filters and
pruned scans, and results independent of the input partitioning."""
import pytest

import __spark_entry__ as entry
from quire.plans.registry import QUERIES
from quire.plans import manifest as PM
from quire.session import table

from conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
             "MapInPandas", "BroadcastNestedLoopJoin")
# queries that land files / run streams are checked by their own tests
SKIP = {"incremental_extract", "incremental_discover", "frontier_rounds", "gated_rounds", "discover_summary", "pull_gate", "crawl_queue"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_no_forbidden_nodes(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_SMALL))
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node}"


def test_scan_is_pruned_and_filter_pushed(spark):
    df = table(spark, SF_SMALL, "documents", "doc_id", "lang").where("lang = 'de'")
    plan = plan_of(df)
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,de)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan


def test_worklist_filter_reaches_scan(spark):
    df = PM.pdf_worklist(spark, SF_SMALL)
    plan = plan_of(df)
    assert "PushedFilters" in plan and "lang" in plan


@pytest.mark.parametrize("name", ["date_kind_distribution", "part_list", "field_merge", "clause_fields"])
def test_repartitioned_input_same_result(spark, name, scratch):
    """Results must not depend on the physical split of the input."""
    base = sorted(map(tuple, entry.queries()[name](spark, SF_SMALL).collect()))
    for t in ("documents", "labels", "orders", "lineitem"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").repartition(5).write.parquet(f"{scratch}/{t}.parquet")
    again = sorted(map(tuple, entry.queries()[name](spark, scratch).collect()))
    assert base == again


@pytest.mark.parametrize("name", ["export_deviations", "export_clauses"])
def test_reports_never_sort_in_one_task(spark, name):
    """The only single-partition exchange is that of the partition offsets."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(entry.queries()[name](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert len(single) == 1 and "HashAggregate(keys=[_pid" in "".join(lines[single[0]:single[0] + 3])
    assert "row_number" not in plan


@pytest.mark.parametrize("name", ["pdf_manifest", "assemble_text_60", "heading_dates"])
def test_first_per_key_limits_before_shuffle(spark, name):
    """First-n-per-key windows keep at most n rows per key in every map task."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(entry.queries()[name](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) + final


@pytest.mark.parametrize("name", ["upsert_last_wins", "frontier_union", "part_list"])
def test_keyed_picks_are_partial_aggregates(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_SMALL))
    import re

    assert "Window" not in plan.replace("WindowGroupLimit", "")
    # partial (map-side) + final aggregate; struct buffers plan as SortAggregate
    assert len(re.findall(r"(HashAggregate|SortAggregate|ObjectHashAggregate)", plan)) >= 2


def test_paged_sections_gather_no_document(spark):
    """Windows go over runs of pages or one row a run, and nothing collects a document's pages."""
    from quire.operators import paged
    from quire.plans.sections import clause_pages

    plan = plan_of(paged.segment_pages(clause_pages(spark, SF_SMALL)))
    assert "collect_list" not in plan and "SinglePartition" not in plan
    for line in plan.splitlines():
        if "Window " in line and "page_no" in line:
            assert "run#" in line, line


def test_main_text_is_made_once(spark):
    """The gate on the length of a page's text does not make the text a second time for the column."""
    from quire.plans import links

    plan = plan_of(links.page_gate(spark, SF_SMALL))
    assert plan.count("<noscript") == 1


def broadcast_sides(plan):
    """The lines of each broadcast's subtree."""
    lines = plan.splitlines()
    at = [len(x) - len(x.lstrip(" :+-*(0123456789)")) for x in lines]
    out = []
    for i, x in enumerate(lines):
        if "BroadcastExchange" in x:
            j = i + 1
            while j < len(lines) and at[j] > at[i]:
                j += 1
            out.append("\n".join(lines[i:j]))
    return out


def test_pattern_join_broadcasts_no_file_names(spark):
    """The names of all files and their grams go by key; what is sent to every machine comes from the rows."""
    sides = broadcast_sides(plan_of(entry.queries()["pattern_join"](spark, SF_SMALL)))
    names = [x for x in sides if "_Deviation_" in x and "partial_count" not in x]  # counts are one row a gram asked for
    assert sides and not names, names[0]


def test_supplier_part_edges_in_many_tasks(spark):
    """Pairs are told apart in a fixed number of tasks at least, once, before they are doubled."""
    from quire.plans import crawl

    edges = crawl.supplier_part_edges(spark, SF_SMALL)
    plan = plan_of(edges)
    assert f"{crawl.PAIR_PARTS}), REPARTITION_BY_NUM" in plan and "Union" not in plan and plan.count("Exchange") == 1
    rows = [tuple(r) for r in edges.collect()]
    pairs = {(r["l_suppkey"] * 2, r["l_partkey"] * 2 + 1) for r in table(spark, SF_SMALL, "lineitem", "l_suppkey", "l_partkey").collect()}
    assert sorted(rows) == sorted(pairs | {(b, a) for a, b in pairs})
