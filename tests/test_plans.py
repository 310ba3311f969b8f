"""What the plans must and must not contain."""

import re

import pytest

import rillframe.catalogue_streams  # noqa: F401  adds the streaming queries
from rillframe.catalogue import QUERIES
from rillframe.operators import basic, combine
from rillframe.plans import Lineup, max_run

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_single_task_over_a_table(spark, name):
    lines = plan(QUERIES[name](spark, FOLDER)).splitlines()
    assert not [line for line in lines if "CartesianProduct" in line or "BroadcastNestedLoop" in line]
    assert not [line for line in lines if "BatchEvalPython" in line or "ArrowEvalPython" in line]
    for above, below in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in above:
            assert "Aggregate" in below or "Limit" in below, f"whole table in one task:\n{below}"


def test_filters_and_columns_reach_the_scan(spark):
    dear = plan(QUERIES["oncall_enrich"](spark, FOLDER))
    assert "EqualTo(event_type,error)" in dear
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,event_type:string>", dear)


def test_take_keeps_n_per_task(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["filter_take"](spark, FOLDER))


def test_buffers_are_cut_before_the_shuffle(spark):
    for name in ("shed_drop_head", "shed_drop_new", "replay_dedupe"):
        text = plan(QUERIES[name](spark, FOLDER))
        assert re.search("WindowGroupLimit .*Partial", text), f"{name} shuffles every row"


def test_keyed_operators_shuffle_once(spark):
    for name in ("scan_user", "split_when", "batch_n", "throttle", "shed_drop_tail", "restart_scan"):
        assert plan(QUERIES[name](spark, FOLDER)).count("Exchange hashpartitioning") == 1, name


def test_row_wise_operators_do_not_shuffle(spark):
    for name in ("map_chain", "zip_same_source", "flag_split", "merge", "notify", "resume_skip", "mask_documents", "map_async", "lookup_async"):
        assert "Exchange" not in plan(QUERIES[name](spark, FOLDER)), name


def test_small_drop_moves_no_rows(spark):
    rows = spark.read.parquet(f"{FOLDER}/orders.parquet")
    outer = plan(basic.drop(rows, 10, ["o_orderkey"])).split("Subquery")[0]
    assert "Exchange" not in outer


def jobs_of(spark, make):
    """Jobs that building a plan runs, and the plan's result."""
    group = f"jobs-{id(make)}"
    spark.sparkContext.setJobGroup(group, group)
    made = make()
    spark.sparkContext.setJobGroup("other", "other")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), made


def test_a_zip_surveys_each_input_once(spark):
    """One job surveys all inputs, one counts their slices; Spark counts the stage before a shuffle as a job of its own."""
    tables = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey"}
    inputs = [(spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet").select(k), [k]) for t, k in tables.items()]
    jobs, zipped = jobs_of(spark, lambda: combine.zip_by_place(*inputs))
    assert jobs <= 4
    assert plan(zipped).count("Exchange") <= 2 * len(inputs)


def test_a_drop_looks_up_its_place(spark):
    rows = spark.read.parquet(f"{FOLDER}/orders.parquet").select("o_orderkey", "o_custkey")
    jobs, made = jobs_of(spark, lambda: basic.drop(rows, 10, ["o_orderkey"]))
    assert jobs <= 4 and re.search(r"PushedFilters: \[[^]]*GreaterThan\(o_orderkey", plan(made))


def test_a_zip_moves_little_of_a_longer_input(spark, tmp_path):
    """Of a million rows those past the first thousand are filtered out at the scan, up to the error of the survey."""
    spark.range(1_000_000).selectExpr("id * 7 AS long_key").repartition(4).write.parquet(f"{tmp_path}/long")
    short = spark.range(1000).selectExpr("id AS short_key")
    long = spark.read.parquet(f"{tmp_path}/long")
    zipped = combine.zip_by_place((short, ["short_key"]), (long, ["long_key"]))
    bound = re.search(r"LessThanOrEqual\(long_key,(\d+)\)", plan(zipped))
    assert bound and 7 * 999 <= int(bound[1]) < 7 * 60_000
    assert zipped.filter("long_key <> place * 7 OR short_key <> place").count() == 0 and zipped.count() == 1000


def test_sliced_running_values_need_no_join_and_move_rows_once(tiny_slices):
    rows = tiny_slices.read.parquet(f"{FOLDER}/events.parquet").select("user_id", "ts", "event_id")
    text = plan(Lineup.of(rows, ["user_id"], ["ts", "event_id"]).numbered("place").rows())
    assert "SortMergeJoin" not in text and "Exchange SinglePartition" not in text
    wide = [line for line in text.splitlines() if "Exchange hashpartitioning(user_id" in line and "_slice" in line]
    assert len(wide) == 3, "the rows, the totals of their slices, and the carries"


def test_a_second_running_value_leaves_rows_where_they_are(tiny_slices):
    rows = tiny_slices.read.parquet(f"{FOLDER}/events.parquet").select("user_id", "ts", "event_id")
    line = Lineup.of(rows, ["user_id"], ["ts", "event_id"]).numbered("place")
    text = plan(line.running(most=max_run(line.frame.place)).rows()).splitlines()
    union = next(i for i, below in enumerate(text) if "Union" in below)
    assert not [line for line in text[:union] if "Exchange" in line]
