"""Loads of landing files: retried, repeated, shared between a stream and a daily run."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from postlake.operators.aggregate import batch_metrics
from postlake.plans import daily
from postlake.plans import silver as silver_plan
from postlake.sinks import ledger, tables
from postlake.sources.landing import read_landing
from postlake.sources.registry import get_source
from postlake.streaming.landing import ingest_available, read_landing_stream, write_batch

DAY = dt.date(2026, 4, 1)
SOURCE = get_source("careerviet")


def at(day=DAY):
    return F.lit(f"{day} 08:00:00").cast("timestamp")


def land(lake, name, *lines):
    folder = Path(lake.landing) / f"year={DAY:%Y}" / f"month={DAY:%m}" / f"day={DAY:%d}" / "careerviet_jobs.json"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines) + "\n")


def job(n):
    return {"job_title": f"t{n}", "company_name": "c", "job_url": f"u{n}", "skills": []}


@pytest.fixture
def lake(spark, tmp_path, request):
    prefix = f"l_{abs(hash(request.node.name))}_"
    tables.create_namespaces(spark, str(tmp_path / "tables"), prefix=prefix)
    return daily.Lake(str(tmp_path / "landing"), str(tmp_path / "aside"), buckets=8, prefix=prefix)


def bronze(spark, lake):
    return sorted(r.job_url for r in spark.table(lake.table("bronze", "careerviet_jobs")).collect())


def aside(spark, lake):
    return spark.read.schema("_corrupt_record string").json(f"{lake.quarantine}/careerviet_jobs").count()


def test_a_retried_micro_batch_counts_once(spark, lake):
    land(lake, "a.json", job(1), job(2), "bad")
    stream = read_landing_stream(spark, lake, SOURCE)
    seen = []
    query = stream.writeStream.foreachBatch(lambda batch, _: [seen.append(1), *(write_batch(batch, lake, SOURCE, at()) for _ in range(2))] and None)
    query.option("checkpointLocation", f"{lake.quarantine}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert seen and bronze(spark, lake) == ["u1", "u2"] and aside(spark, lake) == 1


def test_stream_and_daily_run_share_a_day(spark, lake, tmp_path):
    land(lake, "a.json", job(1), job(2))
    ingest_available(spark, lake, SOURCE, str(tmp_path / "c1"), at()).awaitTermination()
    land(lake, "b.json", job(3), "bad")
    assert daily.run_bronze(spark, lake, SOURCE, DAY, at()) == {"valid": 1, "corrupt": 1}
    assert daily.run_bronze(spark, lake, SOURCE, DAY, at()) == {"valid": 1, "corrupt": 1}
    assert bronze(spark, lake) == ["u1", "u2", "u3"] and aside(spark, lake) == 1
    ingest_available(spark, lake, SOURCE, str(tmp_path / "c1"), at()).awaitTermination()  # b is new to the stream
    ingest_available(spark, lake, SOURCE, str(tmp_path / "c2"), at()).awaitTermination()  # all is new to this one
    assert bronze(spark, lake) == ["u1", "u2", "u3"] and aside(spark, lake) == 1
    land(lake, "c.json", job(4))
    ingest_available(spark, lake, SOURCE, str(tmp_path / "c1"), at()).awaitTermination()
    daily.run_bronze(spark, lake, SOURCE, DAY, at())
    assert bronze(spark, lake) == ["u1", "u2", "u3", "u4"]


def test_a_rerun_leaves_nothing_of_the_attempt_before(spark, lake):
    table = lake.table("bronze", "careerviet_jobs")
    land(lake, "a.json", job(1), {"job_title": " ", "company_name": "c", "job_url": "u2"}, "bad")
    daily.run_day(spark, lake, DAY, [SOURCE], at())
    dlq = spark.table(lake.table("silver", "careerviet_jobs_dlq"))
    assert (len(bronze(spark, lake)), aside(spark, lake), dlq.count()) == (2, 1, 1)
    land(lake, "a.json", job(1))
    daily.run_day(spark, lake, DAY, [SOURCE], at())
    assert (bronze(spark, lake), aside(spark, lake), spark.table(lake.table("silver", "careerviet_jobs_dlq")).count()) == (["u1"], 0, 0)
    other = dt.date(2026, 4, 2)  # the attempt before fell on another day
    daily.run_bronze(spark, lake, SOURCE, DAY, at(other))
    assert bronze(spark, lake) == ["u1"]
    assert {str(r.ingest_date) for r in spark.table(table).collect()} == {str(other)}
    land(lake, "a.json", "nothing", "but", "rubbish")
    assert daily.run_bronze(spark, lake, SOURCE, DAY, at()) == {"valid": 0, "corrupt": 3}
    assert bronze(spark, lake) == [] and aside(spark, lake) == 3


def test_a_load_lost_before_its_files_are_recorded(spark, lake, monkeypatch):
    land(lake, "a.json", job(1))
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "record", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            daily.run_bronze(spark, lake, SOURCE, DAY, at())
    daily.run_bronze(spark, lake, SOURCE, DAY, at())
    assert bronze(spark, lake) == ["u1"]
    assert spark.table(ledger.ledger_of(lake.table("bronze", "careerviet_jobs"))).count() == 1


def test_names_of_loads():
    a, b = ("f1", dt.datetime(2026, 1, 1)), ("f2", dt.datetime(2026, 1, 2))
    assert ledger.load_of_files([a, b]) == ledger.load_of_files([b, a]) != ledger.load_of_files([a])


def test_split_is_one_scan(spark, lake):
    rows = [job(1), job(1), job(2), {"job_title": "", "company_name": "c", "job_url": "u3"}, {"company_name": "c", "job_url": "u1"}]
    land(lake, "a.json", *rows)
    landed = read_landing(spark, lake.landing, "careerviet", DAY).withColumn("ingested_at", at())
    conformed = silver_plan.conform_source(landed, "careerviet", SOURCE.renames)
    group = "split-test"
    spark.sparkContext.setJobGroup(group, group)
    complete, rejected = silver_plan.split_stored(conformed, "split")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 1
    want = batch_metrics(silver_plan.metrics_input(conformed), "job_id", "complete").first()
    kept = silver_plan.latest_postings(complete).count()
    assert (complete.count() + rejected.count(), rejected.count(), kept) == (want.bronze_count, want.rejected_count, want.silver_count) == (5, 2, 2)
    assert complete.columns == conformed.columns
    nothing = silver_plan.split_stored(conformed.limit(0), "split")
    assert [half.count() for half in nothing] == [0, 0]
