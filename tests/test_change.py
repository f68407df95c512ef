import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stridelake.operators import change as C
from stridelake.sources import sinks, versions

KEYS = ["user_id", "timestamp"]
BASE = "user_id string, timestamp int, steps int, seq int"
CHANGE = BASE + ", operation_type string"


def apply(spark, base, changes):
    out = C.cdc_apply(spark.createDataFrame(base, BASE), spark.createDataFrame(changes, CHANGE), KEYS, "seq")
    assert out.columns == ["user_id", "timestamp", "steps", "seq"]
    return sorted((r.user_id, r.timestamp, r.steps) for r in out.collect())


def test_cdc(spark):
    base = [("a", 1, 10, 5), ("b", 1, 20, 5), ("c", 1, 30, 5), ("d", 1, 40, 5)]
    changes = [
        ("a", 1, 11, 4, "UPDATE"),  # older than the row: ignored
        ("b", 1, 21, 5, "UPDATE"),  # same sequence: the change wins
        ("c", 1, None, 6, "DELETE"),
        ("c", 1, 31, 7, "INSERT"),  # deleted, then inserted again
        ("d", 1, None, 6, "DELETE"),
        ("x", 1, None, 6, "DELETE"),  # unknown key
        ("e", 1, 50, 1, None),
    ]
    assert apply(spark, base, changes) == [("a", 1, 10), ("b", 1, 21), ("c", 1, 31), ("e", 1, 50)]


def test_cdc_without_operation_column(spark):
    base = spark.createDataFrame([("a", 1, 10, 1)], BASE)
    out = C.cdc_apply(base, spark.createDataFrame([("a", 1, 12, 2)], BASE), KEYS, "seq")
    assert [r.steps for r in out.collect()] == [12]


tables = st.dictionaries(st.integers(0, 8), st.one_of(st.none(), st.integers(0, 3)), max_size=9)


@settings(max_examples=8, deadline=None)
@given(old=tables, new=tables)
def test_diff_then_apply_gives_the_new_snapshot(spark, old, new):
    as_df = lambda t: spark.createDataFrame([("u", k, v) for k, v in t.items()], "user_id string, timestamp int, steps int")
    feed = C.snapshot_diff(as_df(old), as_df(new), KEYS).collect()
    state = dict(old)
    for r in feed:
        if r._change_type == C.DELETED:
            assert state.pop(r.timestamp) == r.steps
    for r in feed:
        if r._change_type == C.BEFORE:
            assert old[r.timestamp] == r.steps
        elif r._change_type in (C.INSERT, C.AFTER):
            state[r.timestamp] = r.steps
    assert state == new
    unchanged = {k for k in old if k in new and old[k] == new[k]}
    assert not unchanged & {r.timestamp for r in feed}


SILVER = "user_id string, timestamp timestamp_ntz, steps int, year int, month int, day int, seq int"


def rows(spark, *items, deletes=False):
    data = [(u, dt.datetime(2024, 1, d, h), s, 2024, 1, d, q) for u, d, h, s, q, *_ in items]
    df = spark.createDataFrame(data, SILVER)
    if deletes:
        from pyspark.sql import functions as F

        df = df.withColumn("operation_type", F.lit("DELETE"))
    return df


def stored(spark, path):
    return sorted((r.user_id, r.day, r.timestamp.hour, r.steps) for r in versions.read(spark, path).collect())


def upsert(df, path):
    versions.upsert(df, path, KEYS, sinks.SILVER_PARTITIONS, "seq")


def test_upsert_keeps_earlier_hours_and_other_days(spark, tmp_path):
    path = str(tmp_path / "silver")
    upsert(rows(spark, ("a", 1, 0, 5, 1), ("a", 2, 0, 6, 1)), path)
    upsert(rows(spark, ("a", 1, 1, 7, 1)), path)
    upsert(rows(spark, ("a", 1, 0, 8, 2)), path)
    upsert(rows(spark, ("a", 1, 0, 8, 2)), path)
    assert stored(spark, path) == [("a", 1, 0, 8), ("a", 1, 1, 7), ("a", 2, 0, 6)]


def test_delete_that_empties_a_partition(spark, tmp_path):
    path = str(tmp_path / "silver")
    upsert(rows(spark, ("a", 1, 0, 5, 1), ("a", 2, 0, 6, 1), ("b", 2, 0, 6, 1)), path)
    upsert(rows(spark, ("a", 1, 0, 0, 2), ("a", 2, 0, 0, 2), deletes=True), path)
    assert stored(spark, path) == [("b", 2, 0, 6)]
    assert list(versions.load(spark, path).folders) == ["year=2024/month=1/day=2"]


def test_upsert_reads_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "silver")
    upsert(rows(spark, ("a", 1, 0, 5, 1), ("a", 2, 0, 6, 1), ("a", 3, 0, 6, 1)), path)
    df = versions.read(spark, path, only=[versions.partition_folder(spark, sinks.SILVER_PARTITIONS, (2024, 1, 2))])
    assert [r.day for r in df.collect()] == [2]
    assert {f.split("/")[-2] for f in df.inputFiles()} == {"day=2"}


def test_bad_partition_source_does_not_damage_the_table(spark, tmp_path):
    path = str(tmp_path / "silver")
    upsert(rows(spark, ("a", 1, 0, 5, 1)), path)
    bad = rows(spark, ("a", 1, 1, 5, 1)).selectExpr("*", "raise_error('boom') AS note").drop("steps").selectExpr(
        "user_id", "timestamp", "cast(note as int) steps", "year", "month", "day", "seq")
    with pytest.raises(Exception, match="boom"):
        upsert(bad, path)
    assert stored(spark, path) == [("a", 1, 0, 5)]


def test_ties_do_not_depend_on_arrival(spark):
    rows = [spark.createDataFrame([("u", 1, steps)], "user_id string, seq int, steps int") for steps in (5, 9)]
    for first, second in (rows, rows[::-1]):
        assert [r["steps"] for r in C.cdc_apply(first, second, ["user_id"], "seq", ties=["steps"]).collect()] == [5]


def test_difference_over_the_union_of_columns(spark):
    old = spark.createDataFrame([("u", 1), ("v", 2)], "user_id string, steps int")
    new = spark.createDataFrame([("u", 1, 60), ("v", 2, None)], "user_id string, steps int, heart_rate int")
    for a, b in ((old, new), (new, old)):
        found = C.snapshot_diff(a, b, ["user_id"]).collect()
        assert sorted((r["user_id"], r["heart_rate"] or 0) for r in found) == [("u", 0), ("u", 60)]


def test_empty_user_ids_are_dropped_and_counted(spark):
    from stridelake.operators import rules as R

    df = spark.createDataFrame([("", 1, 1.0), ("u", 1, 1.0)], "user_id string, steps int, calories double").selectExpr(
        "*", "timestamp_ntz '2024-01-01 00:00:00' timestamp")
    assert [r["user_id"] for r in R.enforce(df, R.BATCH_RULES).collect()] == ["u"]
    assert "1" in {str(v) for k, v in R.quality_report(df).first().asDict().items() if "user" in k}
