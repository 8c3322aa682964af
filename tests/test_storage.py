"""Writers and the layered run over stored tables."""

from datetime import date

from pyspark.sql import functions as F

from terrace.operators import union_history
from terrace.plans import raw_shop, shop
from terrace.plans.warehouse import Warehouse, derived_reader
from terrace.sources import (append_missing, insert_partitions, observed, read_partition, read_text_table, register_table, replace_partitions, save_table,
                             write_partitions, write_text_table)


def values(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_text_table_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01", 1, None), ("2024-01-01", 2, "a b")], "dt string, n int, s string")
    write_text_table(df, str(tmp_path / "t"))
    assert values(read_text_table(spark, str(tmp_path / "t"), "dt string, n int, s string")) == values(df)


def test_append_missing_twice_is_once(spark, tmp_path):
    path = str(tmp_path / "report")
    first = spark.createDataFrame([("d1", 1), ("d1", None)], "dt string, n int")
    second = spark.createDataFrame([("d1", None), ("d2", 5), ("d2", 5)], "dt string, n int")
    for frame in (first, second, second, first):
        stored = append_missing(spark, frame, path)
    assert values(stored) == values(union_history(first, second)) and stored.count() == 3


def test_replace_partitions_read_from_themselves(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(spark.createDataFrame([(1, "9999-12-31"), (2, "9999-12-31"), (3, "2024-01-01")], "id int, dt string"), path)
    table = spark.read.schema("id int, dt string").parquet(path)
    closed = table.where("dt = '9999-12-31'").withColumn("dt", F.when(F.col("id") == 1, F.lit("2024-01-02")).otherwise(F.col("dt")))
    replace_partitions(spark, closed, path)
    assert values(spark.read.schema("id int, dt string").parquet(path)) == values(spark.createDataFrame([(1, "2024-01-02"), (2, "9999-12-31"), (3, "2024-01-01")], "id int, dt string"))


def test_closing_the_last_open_row_empties_its_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(spark.createDataFrame([(1, "9999-12-31"), (3, "2024-01-01")], "id int, dt string"), path)
    table = spark.read.schema("id int, dt string").parquet(path)
    closed = table.where("dt = '9999-12-31'").withColumn("dt", F.lit("2024-01-02"))
    replace_partitions(spark, closed, path, emptied=["9999-12-31"])
    assert values(spark.read.schema("id int, dt string").parquet(path)) == values(spark.createDataFrame([(1, "2024-01-02"), (3, "2024-01-01")], "id int, dt string"))


def test_days_published_one_after_the_other_equal_one_plan(spark, sf_dir, tmp_path):
    from datetime import date

    from terrace.plans import raw_shop, shop
    from terrace.plans.warehouse import Warehouse, derived_reader

    root, names = str(tmp_path), ["dim_sku_full", "dws_trade_user_order_td", "dws_user_user_login_td", "dwd_trade_trade_flow_acc", "dim_user_zip", "ads_order_stats_by_tm"]
    reader, reports = derived_reader(spark, sf_dir, raw_shop.RAW), []
    for day in (date(1998, 6, 29), date(1998, 6, 30)):
        alone = Warehouse(reader, shop.JOBS, day)
        for name in names:
            kept = {n: spark.read.orc(f"{root}/{n}", pathGlobFilter="*.orc") for n in names if not n.startswith("ads_") and (tmp_path / n).exists()}
            Warehouse(reader, shop.JOBS, day, kept).publish(name, root)
        for name in ("dws_trade_user_order_td", "dws_user_user_login_td"):
            whole = alone[name]
            got = spark.read.schema(whole.schema).orc(f"{root}/{name}").where(F.col("dt") == day.isoformat())
            assert values(got.select(*whole.columns)) == values(whole), (name, day)
        reports += values(alone["ads_order_stats_by_tm"])
        report = alone["ads_order_stats_by_tm"]
        assert sorted(values(read_text_table(spark, f"{root}/ads_order_stats_by_tm", report._jdf.schema().toDDL())), key=str) == sorted(reports, key=str)
    history = spark.read.orc(f"{root}/dim_user_zip")
    assert history.where("end_date = '9999-12-31'").groupBy("id").count().where("count > 1").isEmpty()
    flow = spark.read.orc(f"{root}/dwd_trade_trade_flow_acc")
    assert flow.groupBy("order_id").count().where("count > 1").isEmpty()


def test_to_date_totals_over_days_that_were_not_published(spark, sf_dir, tmp_path):
    """Days 1, 2 and 4 published one after the other give the totals of day 4 as one plan."""
    root, names = str(tmp_path), ["dws_trade_user_order_td", "dws_user_user_login_td"]
    reader = derived_reader(spark, sf_dir, raw_shop.RAW)
    days = [date(1998, 6, 20), date(1998, 6, 23), date(1998, 6, 30)]
    for day in days:
        for name in names:
            kept = {n: spark.read.orc(f"{root}/{n}") for n in names if (tmp_path / n).exists()}
            Warehouse(reader, shop.JOBS, day, kept).publish(name, root)
    for name in names:
        whole = Warehouse(reader, shop.JOBS, days[-1])[name]
        got = spark.read.schema(whole.schema).orc(f"{root}/{name}").where(F.col("dt") == days[-1].isoformat())
        assert values(got.select(*whole.columns)) == values(whole), name


def test_a_dimension_is_read_as_of_its_newest_day(spark):
    dim = spark.createDataFrame([(1, "old", "2024-01-01"), (1, "new", "2024-01-03"), (1, "later", "2024-01-05")], "id int, name string, dt string")
    assert Warehouse(None, {}, date(2024, 1, 4), {"dim_x_full": dim})["dim_x_full"].first().name == "new"


def test_saved_table_replaces_all_of_it(spark, tmp_path):
    table = f"saved_{tmp_path.name.replace('-', '_')}"
    save_table(spark.createDataFrame([(1, "d1"), (2, "d2")], "id int, dt string"), table)
    save_table(spark.createDataFrame([(3, "d2")], "id int, dt string"), table)
    assert values(spark.table(table)) == values(spark.createDataFrame([(3, "d2")], "id int, dt string"))
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()] == ["dt=d2"]
    spark.sql(f"DROP TABLE {table}")


def test_rows_are_counted_while_writing(spark, tmp_path):
    df, seen = observed(spark.range(7), "rows")
    df.write.parquet(str(tmp_path / "t"))
    assert seen.get["rows"] == 7


def test_report_from_stored_layers_equals_one_plan(spark, sf_dir, tmp_path):
    day = date(1998, 6, 30)
    reader = derived_reader(spark, sf_dir, raw_shop.RAW)
    whole = Warehouse(reader, shop.JOBS, day)
    name = "dws_trade_user_sku_order_1d"
    write_partitions(whole[name].where("dt >= '1998-05-20'"), f"{tmp_path}/{name}", fmt="orc")
    stored = spark.read.schema(whole[name].schema).orc(f"{tmp_path}/{name}")
    layered = Warehouse(reader, shop.JOBS, day, stored={name: stored})
    assert values(layered["ads_order_stats_by_tm"]) == values(whole["ads_order_stats_by_tm"])
    one_day = read_partition(spark, f"{tmp_path}/{name}", "user_id string, order_count_1d bigint", "1998-06-29")
    assert one_day.count() == whole[name].where("dt = '1998-06-29'").count()


def test_published_report_is_text(spark, sf_dir, tmp_path):
    w = Warehouse(derived_reader(spark, sf_dir, raw_shop.RAW), shop.JOBS, date(1998, 6, 30))
    w.publish("ads_order_stats_by_tm", str(tmp_path))
    assert spark.read.text(f"{tmp_path}/ads_order_stats_by_tm").count() == w["ads_order_stats_by_tm"].count()
    w.publish("dim_province_full", str(tmp_path))
    assert spark.read.orc(f"{tmp_path}/dim_province_full/dt=1998-06-30").count() == w["dim_province_full"].count()


def test_equal_forms_of_the_to_date_profile(spark, sf_dir):
    w = Warehouse(derived_reader(spark, sf_dir, raw_shop.RAW), shop.JOBS, date(1998, 6, 30))
    assert values(w["dws_trade_user_order_td"]) == values(w["dws_trade_user_order_td_outer"]) == values(w["dws_trade_user_order_td_rebuild"])


def test_catalog_table_over_partition_folders(spark, tmp_path):
    path, table = str(tmp_path / "t"), f"registered_{tmp_path.name.replace('-', '_')}"
    write_partitions(spark.createDataFrame([(1, "d1"), (2, "d2")], "id int, dt string"), path)
    register_table(spark, table, path, "id int")
    write_partitions(spark.createDataFrame([(3, "d3")], "id int, dt string"), path)
    register_table(spark, table, path, "id int")
    assert spark.table(table).count() == 3
    insert_partitions(spark.createDataFrame([("d2", 20), ("d4", 40)], "dt string, id int"), table)
    assert values(spark.table(table)) == values(spark.createDataFrame([(1, "d1"), (20, "d2"), (3, "d3"), (40, "d4")], "id int, dt string"))
    spark.sql(f"DROP TABLE {table}")
