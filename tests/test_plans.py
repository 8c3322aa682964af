"""Shape of the physical plans."""

import re

import pytest

from terrace.plans import job_queries, operator_queries

BATCH = {**operator_queries.QUERIES, **job_queries.QUERIES}


def physical(spark, sf_dir, name):
    return BATCH[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(BATCH) - {"write_partitions"}))
def test_batch_plans_stay_in_the_jvm_without_cross_joins(spark, sf_dir, name):
    plan = physical(spark, sf_dir, name)
    for word in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_date_range_reaches_the_scan(spark, sf_dir):
    plan = BATCH["recent_days_rollup"](spark, sf_dir)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(o_orderdate,1998-06-01" in plan and "LessThan(o_orderdate,1998-07-01" in plan
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp,o_orderpriority:string>" in plan


def test_topk_is_cut_before_the_shuffle(spark, sf_dir):
    plan = physical(spark, sf_dir, "topk_with_ties")
    assert plan.count("WindowGroupLimit") >= 2


def test_streak_needs_no_sort(spark, sf_dir):
    assert "Sort" not in physical(spark, sf_dir, "consecutive_days_mask")


def scans(spark, sf_dir, name):
    plan = BATCH[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    relations = re.findall(r"Relation \[([^\]]*)\]", plan)
    return {table: sum(f"{table}_" in r for r in relations) for table in ("l", "o")}


@pytest.mark.parametrize("report, daily", [("ads_order_stats", ["dws_trade_org_cargo_type_order_1d"]), ("ads_trans_stats", ["dws_trans_org_truck_model_type_trans_finish_1d"]),
                                           ("ads_express_stats", ["dws_trans_org_deliver_suc_1d", "dws_trans_org_sort_1d"])])
def test_reports_read_each_daily_table_once(spark, sf_dir, report, daily):
    got, want = scans(spark, sf_dir, f"parcel_{report}"), [scans(spark, sf_dir, f"parcel_{name}") for name in daily]
    assert all(got[table] <= sum(w[table] for w in want) for table in got)


def test_daily_user_orders_are_dealt_once_and_parcel_orders_finely(spark, sf_dir):
    from terrace.plans.job_queries import QUERIES

    partitions = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = lambda name: QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    user, parcel = plan("shop_dws_trade_user_order_1d"), plan("parcel_dws_trade_org_cargo_type_order_1d")
    assert user[:user.index("Join")].count("Exchange") == 1 and f", {partitions}), REPARTITION_BY_NUM" in user
    assert f", {partitions}), REPARTITION_BY_NUM" in parcel


def test_lines_meet_their_header_last(spark, sf_dir):
    plan = physical(spark, sf_dir, "shop_dws_trade_user_sku_order_1d")
    assert re.findall(r"Join \[(\w+)#", plan)[:4] == ["sku_id", "order_id", "id", "id"]  # from the last to the first; ids of lines go no further than theirs
