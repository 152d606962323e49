from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tests.rows import tuples
from tierlake.session import apply_runtime_options
from tierlake.sinks.keyed import KeyedTable, by_bucket
from tierlake.sinks.parquet import (
    FEW_DATES, gathered, newest_version, write_dates, write_layer, write_version)
from tierlake.sinks.relational import write_options
from tierlake.sources.tables import Jdbc, scan_table

SCHEMA = StructType().add("k", "string").add("hour", "long").add("v", "long")


def _rows(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def table(spark, folder):
    return KeyedTable(spark, folder, SCHEMA, ["k"], by_bucket("k", 3))


def test_upsert_replaces_by_key(spark, table):
    assert tuples(table.read()) == []
    first = table.upsert(_rows(spark, ("a", 1, 1), ("b", 1, 2)))
    assert (first.rows_written, first.rows_replaced) == (2, 0)
    second = table.upsert(_rows(spark, ("b", 1, 20), ("c", 1, 30)))
    assert (second.rows_written, second.rows_replaced) == (2, 1)
    assert tuples(table.read()) == [("a", 1, 1), ("b", 1, 20), ("c", 1, 30)]


def test_upsert_twice_equals_once(spark, table):
    rows = _rows(spark, *((f"k{i}", 0, i) for i in range(20)))
    table.upsert(rows)
    once = tuples(table.read())
    table.upsert(rows)
    assert tuples(table.read()) == once


def test_a_batch_is_applied_once(spark, table):
    table.upsert(_rows(spark, ("a", 1, 1)), batch=("w", 0))
    again = table.upsert(_rows(spark, ("a", 1, 99)), batch=("w", 0))
    assert again.rows_written == 0 and tuples(table.read(), "v") == [1]
    table.upsert(_rows(spark, ("a", 1, 2)), batch=("other", 0))
    table.upsert(_rows(spark, ("a", 1, 3)), batch=("w", 1))
    assert tuples(table.read(), "v") == [3]
    assert table.published().batches == {"w": 1, "other": 0}


def test_replacing_a_scope_removes_what_is_gone(spark, folder):
    table = KeyedTable(spark, folder, SCHEMA, ["k", "hour"], F.col("hour").cast("string"))
    table.upsert(_rows(spark, ("a", 1, 1), ("b", 1, 1), ("a", 2, 1)))
    hours = spark.createDataFrame([(1,)], "hour long")
    table.upsert(_rows(spark, ("a", 1, 5)), replaces=hours)
    assert tuples(table.read()) == [("a", 1, 5), ("a", 2, 1)]
    table.upsert(_rows(spark), replaces=hours)
    assert tuples(table.read()) == [("a", 2, 1)]
    table.upsert(_rows(spark), replaces=spark.createDataFrame([(2,)], "hour long"))
    assert tuples(table.read()) == [] and table.published().parts == {}


def test_readers_keep_what_they_started_with(spark, table):
    table.upsert(_rows(spark, ("a", 1, 1)))
    reader = table.read()
    table.upsert(_rows(spark, ("a", 1, 2)))
    assert tuples(reader, "v") == [1] and tuples(table.read(), "v") == [2]


def test_a_run_that_dies_before_publishing_changes_nothing(spark, table, monkeypatch):
    table.upsert(_rows(spark, ("a", 1, 1)))
    with monkeypatch.context() as patch:
        patch.setattr(KeyedTable, "_publish", lambda *_: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            table.upsert(_rows(spark, ("a", 1, 2)))
    assert tuples(table.read(), "v") == [1]
    table.upsert(_rows(spark, ("a", 1, 3)))
    assert tuples(table.read(), "v") == [3]


def test_two_writers_of_one_version_conflict(spark, table):
    table.upsert(_rows(spark, ("a", 1, 1)))
    with pytest.raises(Exception, match="(?i)exists"):
        table._publish(1, {}, {})


def test_layer_overwrite_all_or_some_dates(spark, folder):
    def rows(*pairs):
        return spark.createDataFrame([(v, date(2024, 1, d)) for v, d in pairs],
                                     "v long, ingestion_date date")

    assert write_layer(rows((1, 1), (2, 2)), folder) == 2
    assert write_layer(rows((20, 2)), folder, only_written_dates=True, gather=True) == 1
    assert tuples(scan_table(spark, folder), "v") == [1, 20]
    only = scan_table(spark, folder, dates=(date(2024, 1, 2), date(2024, 1, 9)))
    assert tuples(only, "v") == [20]
    assert write_layer(rows((3, 3)), folder) == 1
    assert tuples(scan_table(spark, folder), "v") == [3]
    assert write_layer(rows(), folder) == 0


def test_relational_overwrite_keeps_the_table():
    options = write_options(Jdbc("jdbc:x", "a.Driver"), "t")
    assert options["truncate"] == "true" and options["batchsize"] == "1000"


def test_another_part_rule_is_refused(spark, folder, table):
    table.upsert(_rows(spark, ("a", 1, 1)))
    other = KeyedTable(spark, folder, SCHEMA, ["k"], by_bucket("k", 4))
    with pytest.raises(ValueError, match="parts"):
        other.upsert(_rows(spark, ("a", 1, 2)))


def test_old_versions_go_and_what_counts_stays(spark, folder):
    table = KeyedTable(spark, folder, SCHEMA, ["k"], by_bucket("k", 3), retention=-1.0)
    for n in range(4):
        table.upsert(_rows(spark, ("a", n, n), (f"b{n}", n, n)))
    assert len(table._times("published")) == 1
    assert set(table._times("data")) == set(table.published().parts.values())
    assert tuples(table.read(), "k", "v") == [("a", 3), *((f"b{n}", n) for n in range(4))]
    kept = KeyedTable(spark, folder, SCHEMA, ["k"], by_bucket("k", 3))
    kept.upsert(_rows(spark, ("a", 9, 9)))
    assert len(kept._times("published")) == 2


def test_versions_stand_side_by_side(spark, folder):
    assert newest_version(spark, folder) is None
    for n in range(5):
        assert write_version(_rows(spark, ("a", n, n)), folder, keep=2) == 1
        if n == 3:
            before = spark.read.parquet(newest_version(spark, folder))
    assert tuples(before, "v") == [3], "who reads the version before is not disturbed"
    assert tuples(spark.read.parquet(newest_version(spark, folder)), "v") == [4]


def test_rows_of_few_dates_are_not_moved_to_be_written(spark):
    rows = spark.range(9).withColumn("d", F.current_date())
    for dates, moved in ((1, False), (FEW_DATES, False), (FEW_DATES + 1, True)):
        plan = gathered(rows, "d", dates)._jdf.queryExecution().executedPlan().toString()
        assert ("Exchange" in plan) == moved


def test_written_dates_are_seen_while_writing(spark, folder):
    rows = spark.createDataFrame([(1, date(2024, 3, 1)), (2, date(2024, 3, 1)), (3, date(2024, 3, 9)),
                                  (4, None)], "v int, d date")
    assert write_dates(rows, folder, "d") == (4, {date(2024, 3, 1), date(2024, 3, 9)})
    assert write_dates(rows.filter("v = 3"), folder, "d") == (1, {date(2024, 3, 9)})
    assert write_dates(rows.filter("v > 9"), folder, "d") == (0, set())
    assert tuples(spark.read.parquet(folder), "v") == [1, 2, 3, 4]


def test_rows_of_few_dates_are_not_sorted_to_be_written(spark, folder):
    apply_runtime_options(spark)
    spark.sql(f"CREATE TABLE few_dates (v INT, d DATE) USING parquet PARTITIONED BY (d) LOCATION '{folder}'")
    try:
        plan = spark.sql("EXPLAIN INSERT INTO few_dates SELECT int(id), "
                         "date_add(DATE'2024-03-01', int(id % 2)) FROM range(9)").collect()[0][0]
    finally:
        spark.sql("DROP TABLE few_dates")
    assert "Sort" not in plan
