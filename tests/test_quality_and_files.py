from __future__ import annotations

import datetime as dt
import math

import pytest
from conftest import values
from pyspark.sql import functions as F

from tillsight.operators import features, quality
from tillsight.sources import files, workspace
from tillsight.sources.schema import CLEAN, RAW


def test_shape_and_types(orders):
    frame = orders({}, {})
    assert values(quality.shape(frame)) == [(2, 17)]
    kinds = {r.column: r.type for r in quality.column_types(frame).collect()}
    assert (kinds["order_date"], kinds["quantity"], kinds["sales"]) == ("date", "int", "double")
    assert quality.sample_rows(orders(*[{}] * 8)).count() == 5


def test_null_counts_include_nan(orders):
    frame = orders({"sales": None, "city": None}, {"sales": math.nan}, {})
    counts = dict(values(quality.null_counts(frame)))
    assert (counts["sales"], counts["city"], counts["region"]) == (2, 1, 0)


def test_duplicates_need_every_column(orders):
    same = {"order_id": "O-9"}
    frame = orders(same, same, same, {"order_id": "O-9", "sales": 1.0},
                   {"order_id": None, "city": None}, {"order_id": None, "city": None})
    assert values(quality.duplicate_count(frame)) == [(3,)]
    assert quality.drop_duplicates(frame).count() == 3
    assert values(quality.duplicate_count(orders({}).limit(0))) == [(0,)]


def test_bad_date_text_is_found_and_stops_the_cast(spark):
    frame = spark.createDataFrame(
        [("a", "2024-12-30", "2024-12-31"), ("b", "30/12/2024", "2025-01-01"), ("c", None, None)],
        "order_id string, order_date string, ship_date string")
    assert [r.order_id for r in quality.bad_dates(frame).collect()] == ["b"]
    good = quality.cast_dates(frame.where("order_id <> 'b'")).orderBy("order_id").collect()
    assert (good[0].order_date, good[1].order_date) == (dt.date(2024, 12, 30), None)
    with pytest.raises(Exception, match="(?i)date"):
        quality.cast_dates(frame).collect()


def test_clean_from_text_dates(spark, orders):
    frame = files.with_iso_dates(orders({"order_id": "x", "sales": math.nan},
                                        {"order_id": "x", "sales": math.nan}))
    cleaned = quality.clean(frame)
    assert cleaned.schema["order_date"].dataType.simpleString() == "date"
    assert [r.sales for r in cleaned.collect()] == [None]


def test_summary(orders):
    frame = orders({"sales": 10.4, "customer_id": None},
                   {"sales": 0.1, "product_name": "B", "order_date": dt.date(2023, 5, 1)})
    assert values(quality.summary(frame)) == [
        (2, 17, dt.date(2022, 1, 1), dt.date(2023, 5, 1), 11.0, 40.0, 1, 2)]


def test_category_totals_drop_missing_keys(orders):
    frame = orders({"category": None}, {"sales": None}, {"sales": None})
    assert values(quality.category_totals(frame)) == [("Books", 0.0, 40.0)]


TRICKY = ['Laptop Air 13"', 'a "quoted", name', "comma, inside", "plain"]


def test_csv_round_trip(spark, orders):
    frame = orders(*[{"product_name": n} for n in TRICKY], {"city": None, "sales": None})
    path = workspace.new_path(spark, "csv")
    files.write_csv(frame, path)
    back = files.read_raw_csv(spark, path)
    assert back.schema == RAW
    assert sorted(values(back), key=str) == sorted(values(frame), key=str)
    text = files.read_raw_csv_text_dates(spark, path)
    assert text.first().order_date == "2022-01-01"
    assert sorted(values(quality.cast_dates(text)), key=str) == sorted(values(frame), key=str)


def test_clean_csv_round_trip(spark, orders):
    full = features.with_features(orders(*[{"product_name": n} for n in TRICKY]))
    path = workspace.new_path(spark, "clean")
    files.write_csv(full, path)
    assert sorted(values(files.read_clean_csv(spark, path))) == sorted(values(full))
    assert files.read_clean_csv_text_dates(spark, path).first().ship_date == "2022-01-04"


def test_malformed_csv_stops_the_load(spark, orders):
    path = workspace.new_path(spark, "bad")
    spark.createDataFrame([("order_id,order_date",), ("x,notadate",)], "v string") \
        .coalesce(1).write.text(path)
    with pytest.raises(Exception):
        files.read_raw_csv(spark, path).collect()


def test_clean_parquet_prunes_years(spark, orders):
    full = features.with_features(orders({}, {"order_date": dt.date(2023, 1, 1)}))
    path = workspace.new_path(spark, "parquet")
    files.write_clean(full, path)
    back = files.read_clean(spark, path)
    assert sorted(values(back.select(*CLEAN.fieldNames()))) == sorted(values(full))
    plan = back.where("order_year = 2023")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan


def test_publish_and_sql(spark, prepared):
    frame = prepared({}, {"region": "West"})
    path = workspace.new_path(spark, "table")
    assert files.publish(frame, "till_orders", path).count() == 2
    assert files.publish(frame.limit(1), "till_orders", workspace.new_path(spark, "t")).count() == 1
    got = files.run_sql(frame, "SELECT region, SUM(sales) AS s FROM sales GROUP BY region ORDER BY 1")
    assert values(got) == [("North", 100.0), ("West", 100.0)]


def test_shared_folder_comes_from_the_session(spark):
    assert workspace.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    frame = workspace.written(spark.range(5).withColumn("x", F.col("id") * 2), "r")
    assert sorted(values(frame)) == [(i, 2 * i) for i in range(5)]
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in frame.inputFiles())


def test_csv_columns_go_by_name(spark, orders):
    frame = orders({"city": "Delhi", "region": "North"}, {"city": None})
    swapped = [*reversed(frame.columns), "remark"]
    path = workspace.new_path(spark, "csv")
    files.write_csv(frame.withColumn("remark", F.lit("x,y")).select(*swapped), path)
    back = files.read_raw_csv(spark, path)
    assert back.columns == RAW.fieldNames()
    assert sorted(map(str, values(back))) == sorted(map(str, values(frame)))
    files.write_csv(frame.drop("city"), path)
    with pytest.raises(ValueError, match="city"):
        files.read_raw_csv(spark, path)


def test_types_count_what_is_present(orders):
    found = {r.column: r.present for r in quality.column_types(orders({"sales": math.nan}, {"city": None}, {})).collect()}
    assert (found["sales"], found["city"], found["region"]) == (2, 2, 3)


def test_clean_table_by_year_and_date(spark, orders):
    """Each year lies in few files, and a report on one year reads its folder only."""
    frame = features.with_features(orders(*({"order_date": dt.date(2019 + i % 5, 1 + i % 12, 1)}
                                            for i in range(60))))
    path = workspace.new_path(spark, "clean")
    files.write_clean(frame.repartition(8), path)
    back = files.read_clean(spark, path)
    assert back.count() == 60
    one = back.where("order_year = 2021").select(F.input_file_name().alias("f")).distinct().count()
    assert one <= 3 < back.select(F.input_file_name().alias("f")).distinct().count()


def test_what_a_run_wrote_can_be_removed(spark):
    path = f"{workspace.shared_folder(spark)}/tillsight/other-application/kept"
    spark.range(3).write.parquet(path)
    frame = workspace.written(spark.range(3), "gone")
    assert frame.count() == 3 and workspace.run_folder(spark) in frame.inputFiles()[0]
    assert spark.read.parquet(path).count() == 3


@pytest.mark.parametrize("bits", [64, 3, 1])
def test_duplicates_are_found_by_digest_and_told_apart_where_digests_clash(spark, bits):
    rows = [(k % 40, f"t{k % 7}" if k % 5 else None, None if k % 3 else float(k % 4)) for k in range(400)]
    rows += [(1, None, 2.0), (1, "t", None), (None, None, None), (None, None, None)] + [(9, "hot", 1.0)] * 300
    frame = spark.createDataFrame(rows, "a int, b string, c double")
    assert quality.duplicate_count(frame, bits).first()[0] == len(rows) - len(set(rows))
    assert sorted(map(str, quality.drop_duplicates(frame, bits).collect())) == sorted(
        map(str, spark.createDataFrame(sorted(set(rows), key=str), "a int, b string, c double").collect()))
    empty = frame.limit(0)
    assert quality.duplicate_count(empty, bits).first()[0] == 0 and quality.drop_duplicates(empty, bits).count() == 0


def test_unequal_rows_are_not_dealt_out_whole(spark):
    frame = spark.range(5000).select("id", F.repeat(F.lit("x"), 200).alias("wide"))
    keyed, twice = quality._repeated(frame, 64)
    assert twice.count() == 0 and set(twice.columns) == {"_twice"}
    plan = keyed.groupBy("_digest").count()._jdf.queryExecution().executedPlan().toString()
    assert "wide" not in plan.split("Exchange", 1)[0]


def test_rows_with_bad_dates_are_kept_with_their_reasons(spark):
    rows = [(1, "2024-02-29", "2024-03-01"), (2, "2023-02-29", "2023-03-01"), (3, None, " "), (4, "29.02.2024", "2024-13-01"),
            (5, "2024-2-9", "2024-03-01"), (6, "0000-00-00", "2024-03-01")]
    good, bad = quality.split_dates(spark.createDataFrame(rows, "order_id int, order_date string, ship_date string"))
    assert values(good) == [(1, dt.date(2024, 2, 29), dt.date(2024, 3, 1))]
    got = {r.order_id: [tuple(x) for x in r.reasons] for r in bad.collect()}
    assert got == {2: [("order_date", "no such day")], 3: [("order_date", "missing"), ("ship_date", "missing")],
                   4: [("order_date", "no date"), ("ship_date", "no such day")], 5: [("order_date", "no date")],
                   6: [("order_date", "no such day")]}
    assert {(r.order_id, r.order_date, r.ship_date) for r in bad.collect()} == set(rows[1:])
    none, empty = quality.split_dates(spark.createDataFrame([], "order_id int, order_date string, ship_date string"))
    assert none.count() == empty.count() == 0


def test_sql_leaves_a_view_of_the_same_name_as_it_was(spark, prepared):
    spark.range(7).createOrReplaceTempView("sales")
    assert files.run_sql(prepared({}, {}), "SELECT count(*) AS n FROM sales").first().n == 2
    assert spark.table("sales").count() == 7
    spark.catalog.dropTempView("sales")
    found = files.run_sql(prepared({}), "SELECT count(*) AS n FROM sales")
    assert not spark.catalog.tableExists("sales") and found.first().n == 1
    with pytest.raises(Exception):
        files.run_sql(prepared({}), "SELECT nothing FROM sales")
    assert not spark.catalog.tableExists("sales")


def test_lines_without_a_parent_are_counted(spark, tmp_path):
    from tillsight.sources import tables

    rows = {"lineitem": ("l_orderkey long, l_partkey long", [(1, 1), (1, 9), (2, None), (7, 9)]), "orders": ("o_orderkey long, o_custkey long", [(1, 5), (2, 6)]),
            "part": ("p_partkey long", [(1,)]), "customer": ("c_custkey long, c_nationkey int", [(5, 1)]),
            "nation": ("n_nationkey int, n_regionkey int", [(1, 3)]), "region": ("r_regionkey int", [(3,)])}
    for name, (ddl, data) in rows.items():
        spark.createDataFrame(data, ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    assert {(r.child, r.parent): r.missing for r in tables.orphans(spark, str(tmp_path)).collect()} == {
        ("lineitem", "orders"): 1, ("lineitem", "part"): 3, ("orders", "customer"): 1, ("customer", "nation"): 0, ("nation", "region"): 0}


def test_rows_that_hardly_repeat_are_not_moved_to_be_compared(spark):
    """One digest of 2,000 occurs twice: only its rows, and those of its bit, are compared whole."""
    frame = spark.range(2000).select("id", F.repeat(F.lit("x"), 50).alias("wide"))
    twice = frame.unionByName(frame.where("id = 7"))
    assert values(quality.duplicate_count(twice)) == [(1,)]
    suspects = quality._suspects(*quality._repeated(twice, 64))
    assert 2 <= suspects.count() < 20 and suspects.where("id = 7").count() == 2
    plan = quality.duplicate_count(twice)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "LeftSemi" not in plan


@pytest.mark.parametrize("most", [1 << 15, 1 << 28])
def test_many_repeats_are_counted_whatever_the_bits(spark, monkeypatch, most):
    monkeypatch.setattr(quality, "_MOST", most)
    frame = spark.range(9000).select((F.col("id") % 4000).alias("k"), F.when(F.col("id") % 3 == 0, F.lit(0.5)).alias("v"))
    assert quality.duplicate_count(frame).first()[0] == 9000 - frame.distinct().count()
