import gzip
import json

import pytest
from pyspark.sql import functions as F

from stridelake import schemas
from stridelake.operators import features as D
from stridelake.operators import gold as G
from stridelake.operators import ml as M
from stridelake.operators import silver as S
from stridelake.plans import adapters as A
from stridelake.sources import drift, readers, sinks, versions

SF = "/root/testdata/sf0.001"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_daily_csv_to_fact(spark, tmp_path):
    calories = write(tmp_path / "c.csv", "Id,ActivityDay,Calories\n1503960366,4/12/2016,1985\n1503960366,4/13/2016,1797\n")
    steps = write(tmp_path / "s.csv", "Id,ActivityDay,StepTotal\n1503960366,4/12/2016,13162\n")
    minutes = write(
        tmp_path / "i.csv",
        "Id,ActivityDay,SedentaryMinutes,LightlyActiveMinutes,FairlyActiveMinutes,VeryActiveMinutes\n1503960366,4/12/2016,728,328,13,25\n")
    row = D.daily_fact(*readers.read_daily_csv(spark, calories, steps, minutes)).first()
    assert (row.user_id, row.daily_steps, row.daily_calories, row.VeryActiveMinutes) == (1503960366, 13162, 1985, 25)


def test_hourly_and_minute_csv(spark, tmp_path):
    hour = "4/12/2016 1:00:00 PM"
    steps = write(tmp_path / "hs.csv", f"Id,ActivityHour,StepTotal\n1,{hour},10\n")
    effort = write(tmp_path / "hi.csv", f"Id,ActivityHour,TotalIntensity\n1,{hour},3\n")
    assert D.hourly_fact(*readers.read_hourly_csv(spark, steps, effort)).first().activity_hour == 13
    paths = [write(tmp_path / f"{n}.csv", f"Id,ActivityMinute,{n}\n1,{hour},2\n") for n in ("Steps", "Calories", "Intensity")]
    sleep = write(tmp_path / "sleep.csv", f"Id,date,value,logId\n1,{hour},3,77\n")
    assert S.minute_merge(*readers.read_minute_csv(spark, *paths, sleep)).first().sleep_value == "3"


def test_csv_with_a_different_header_is_refused(spark, tmp_path):
    path = write(tmp_path / "c.csv", "Id,Calories,ActivityDay\n1,5,4/12/2016\n")
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, path, schemas.DAILY_CALORIES).collect()


def test_bronze_json_gzip_and_corrupt_lines(spark, tmp_path):
    lines = [json.dumps({"user_id": "1", "timestamp": "t", "steps": 5}), "{broken", json.dumps({"user_id": "2"})]
    with gzip.open(tmp_path / "part.json.gz", "wt") as f:
        f.write("\n".join(lines))
    rows = readers.read_bronze_json(spark, str(tmp_path)).collect()
    assert [(r.user_id, r.steps, r[schemas.CORRUPT]) for r in rows] == [("1", "5", None), (None, None, "{broken"), ("2", None, None)]


def test_event_lines(spark, tmp_path):
    path = write(tmp_path / "gold.json", '{"user_id": "a", "day": 1, "total_steps": 5}\nnot json\n\n{"user_id": "b"}\n')
    good, bad = readers.read_event_lines(spark, path)
    assert sorted(r.user_id for r in good.collect()) == ["a", "b"]
    assert [r.value for r in bad.collect()] == ["not json"]
    assert good.count() == 2


def test_schema_drift(spark, tmp_path):
    store, raw = str(tmp_path / "schema"), tmp_path / "raw"
    write(raw / "a.json", '{"user_id": "1", "steps": 1}\n')
    first = drift.evolve_schema(spark, str(raw), store)
    assert first == schemas.BRONZE_RAW
    import os, time

    later = time.time() + 5
    os.utime(write(raw / "b.json", '{"user_id": "1", "heart_rate": 61.5}\n'), (later, later))
    second = drift.evolve_schema(spark, str(raw), store)
    assert second.names == [*schemas.BRONZE_RAW.names, "heart_rate"]
    assert drift.load_schema(spark, store)[0] == 2
    assert drift.evolve_schema(spark, str(raw), store) == second
    rates = [r.heart_rate for r in readers.read_bronze_json(spark, str(raw), second).collect()]
    assert sorted(rates, key=str) == ["61.5", None]


@pytest.fixture(scope="module")
def gold(spark):
    return A.gold_scaled(spark, SF)


def test_silver_and_gold_tables(spark, tmp_path):
    path, out = str(tmp_path / "silver"), str(tmp_path / "gold")
    sinks.write_silver(A.silver(spark, SF), path)
    silver = readers.read_silver(spark, path)
    assert silver.count() == A.silver(spark, SF).count()
    sinks.write_gold(G.gold_daily(silver), out)
    assert sorted(readers.read_gold(spark, out).select(*G.DAY_KEYS, "total_steps").collect()) == sorted(
        G.gold_daily(A.silver(spark, SF)).select(*G.DAY_KEYS, "total_steps").collect())
    one_day = readers.read_silver(spark, path, F.col("day") == 3)
    assert {f.split("/")[-2] for f in one_day.inputFiles()} >= {"day=3"}
    before = silver.count()
    sinks.write_silver(silver.filter("day = 3").withColumn("steps", F.lit(1)), path)
    again = spark.read.parquet(path)
    assert again.count() == before and again.filter("day = 3 and steps <> 1").count() == 0


def test_warehouse(spark, gold):
    sinks.load_warehouse(spark, gold)
    sinks.load_warehouse(spark, gold)
    table = spark.table("daily_summary")
    assert table.count() == gold.count()
    assert table.columns[:4] == ["user_id", "year", "month", "day"] and table.columns[-1] == "processed_at"
    spark.sql("DROP TABLE daily_summary")


def test_managed_table(spark, gold):
    first = sinks.managed_table(gold, "gold_managed", sinks.GOLD_PARTITIONS)
    table = spark.table("gold_managed")
    assert table.count() == gold.count() and table.columns == gold.columns
    plan = table.filter("month = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    sinks.managed_table(gold.withColumn("total_steps", F.col("total_steps") + F.col("day").isin(3).cast("int")), "gold_managed", sinks.GOLD_PARTITIONS)
    path = sinks.table_path(spark, "gold_managed")
    feed = versions.feed_between(spark, path, list(G.DAY_KEYS), first)
    assert {r.day for r in feed.select("day").distinct().collect()} == {3} and spark.table("gold_managed").count() == gold.count()
    spark.sql("DROP VIEW gold_managed")


def test_training_csv_and_predictions(spark, gold, tmp_path):
    data = M.training_set(gold)
    sinks.write_training_csv(data, str(tmp_path / "train"))
    rows = spark.read.csv(str(tmp_path / "train" / "*")).collect()
    assert len(rows) == gold.count() and {r._c0 for r in rows} == {"0", "1"} and len(rows[0]) == 7
    scored = M.predictions(A.scored(spark, SF))
    sinks.write_predictions(scored, str(tmp_path / "out"), "2024-02-01", "gold")
    assert spark.read.json(str(tmp_path / "out/predictions")).count() == gold.count()
    assert spark.read.json(str(tmp_path / "out/summaries")).first().total_users == gold.count()


def test_messages_and_events_as_files(spark, tmp_path):
    messages = A.messages(spark, SF)
    sinks.write_messages(messages, str(tmp_path / "q"))
    assert spark.read.text(str(tmp_path / "q")).count() == messages.count()
    assert sinks.kafka_form(messages).columns == ["key", "value"]
    lines = sinks.bronze_json(S.minute_merge(*A.minute_tables(spark, SF)), "device", F.lit("2024-02-01").cast("timestamp_ntz"))
    sinks.write_json_lines(lines, str(tmp_path / "bronze"))
    back = readers.read_bronze_json(spark, str(tmp_path / "bronze"))
    assert back.count() == lines.count() and back.filter("_corrupt_record is not null and user_id is null").count() == 0
    assert '"sleep_value":null' in lines.filter(F.col("value").contains('sleep_value":null')).first().value
