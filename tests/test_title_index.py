"""Searches by the index of titles equal a LIKE over all facts, whatever was upserted."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from postlake.fixtures import raw_postings
from postlake.operators.filters import title_like
from postlake.plans import daily
from postlake.sinks import keyed, title_index
from postlake.sinks import tables as sinks
from postlake.sinks.title_index import GRAM_PARTITION, TitleIndex, grams_of_keyword, upsert_indexed
from postlake.sources.landing import write_landing
from postlake.sources.registry import get_source

SCHEMA = "job_id string, job_title string, ingested_at date, other string"
WORDS = ["Data", "data engineer", "Kỹ sư", "ab", "100% remote", "c_c", "back\\slash", "", None, "DATABASE", "Aa"]
KEYWORDS = ["data", "DATA", "kỹ sư", "d_ta", "dat%eer", "ab", "%", "", "0% r", "k\\sl", "no such title", "aa "]


def rows_of(spark, draw, ids):
    day = dt.date(2024, 1, 1)

    def title():
        words = [draw.choice(WORDS) for _ in range(draw.randint(1, 3))]
        return None if None in words else " ".join(words)

    made = [(str(i), title(), day + dt.timedelta(draw.randint(0, 5)), draw.choice("xy")) for i in ids]
    return spark.createDataFrame(made, SCHEMA)


def found(df):
    newest = df.orderBy(F.col("ingested_at").desc(), F.col("job_id").desc()).limit(7)
    return [tuple(r) for r in newest.select("job_id", "job_title", "ingested_at").collect()]


@pytest.fixture(scope="module")
def facts(spark):
    """Three loads, one of them twice, after facts that had no index."""
    draw, index = random.Random(5), TitleIndex("found_titles", parts=4)
    keyed.upsert_keyed(rows_of(spark, draw, range(60)), "found_facts", "job_id", parts=4)
    for ids in (range(40, 90), range(0, 50, 3), range(200)):
        batch = rows_of(spark, draw, ids).cache()
        upsert_indexed(batch, "found_facts", "job_id", index, set_null=True)
        upsert_indexed(batch, "found_facts", "job_id", index, set_null=True)
    return index


@pytest.mark.parametrize("keyword", KEYWORDS)
def test_equals_a_scan(spark, facts, keyword):
    table = spark.table("found_facts")
    want = found(table.where(title_like(keyword)))
    assert found(facts.narrowed(table, 4, keyword, 7).where(title_like(keyword))) == want
    assert (facts.newest(spark, keyword, 7) is None) == (not grams_of_keyword(keyword))


def test_only_the_parts_of_hits_are_read(spark, facts):
    table = spark.table("found_facts")
    plan = facts.narrowed(table, 4, "data", 3)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert any("dynamicpruning" in line and "key_part" in line for line in scans)
    assert any(f"{GRAM_PARTITION}" in line.split("PartitionFilters")[1] for line in scans)


def test_unchanged_rows_add_nothing_and_a_cut_off_load_is_mended(spark):
    index = TitleIndex("mended_titles", parts=2)
    first = spark.createDataFrame([("1", "old title", dt.date(2024, 1, 1), "x"), ("2", None, None, "x")], SCHEMA)
    upsert_indexed(first, "mended_facts", "job_id", index, parts=2)
    size = spark.table("mended_titles").count()
    upsert_indexed(first.withColumn("other", F.lit("y")), "mended_facts", "job_id", index)
    assert spark.table("mended_titles").count() == size == 7
    second = first.withColumn("job_title", F.lit("new title"))
    index.note(second, spark.table("mended_facts"))  # and then the driver is lost
    hits = index.narrowed(spark.table("mended_facts"), 2, "new", 5).where(title_like("new"))
    assert hits.count() == 0
    upsert_indexed(second, "mended_facts", "job_id", index)
    ids = lambda k: sorted(r.job_id for r in index.newest(spark, k, 5).collect())
    assert (ids("new"), ids("old"), ids("title")) == (["1", "2"], [], ["1", "2"])
    empty = spark.createDataFrame([], SCHEMA)
    upsert_indexed(empty, "empty_facts", "job_id", TitleIndex("empty_titles"), parts=2)
    assert TitleIndex("empty_titles").newest(spark, "data", 5).count() == 0


def test_slices_of_postings_are_written_where_they_are_sorted(spark, monkeypatch):
    monkeypatch.setattr(title_index, "SLICE_ROWS", 50)
    facts, index = rows_of(spark, random.Random(3), range(200)), TitleIndex("sliced_titles", parts=2)
    laid = title_index._laid(index._all_held(facts), 0, 2)
    above, below = laid._jdf.queryExecution().executedPlan().toString().split("Generate", 1)
    assert "Exchange" not in above and below.count("Exchange") == 1
    assert laid.rdd.getNumPartitions() == 4
    index.build(facts)
    for keyword in ("data", "d_ta eng", "no such title"):
        want = [k for k, _, _ in found(facts.where(title_like(keyword)))]
        assert [r.job_id for r in index.newest(spark, keyword, 7).collect()] == want


def test_a_large_table_is_created_by_more_tasks_than_parts(spark, monkeypatch):
    monkeypatch.setattr(keyed, "FILE_ROWS", 25)
    facts = rows_of(spark, random.Random(4), range(200))
    assert keyed._laid_out(facts, "job_id", 4, 200).rdd.getNumPartitions() == 8
    keyed.upsert_keyed(facts, "many_files", "job_id", parts=4)
    keyed.upsert_keyed(facts.limit(90).withColumn("other", F.lit("z")), "many_files", "job_id")
    table = spark.table("many_files")
    assert table.where(F.col("key_part") != keyed.key_part("job_id", 4)).isEmpty()
    assert table.count() == table.select("job_id").distinct().count() == 200
    assert table.groupBy("job_id").count().where("count > 1").isEmpty() and table.where("other = 'z'").count() == 90


def test_a_daily_run_keeps_the_index(spark, tmp_path, sf_dir):
    day, source = dt.date(2024, 1, 15), get_source("careerviet")
    lake = daily.Lake(f"{tmp_path}/landing", f"{tmp_path}/aside", buckets=8, prefix="titled_", title_index=True)
    sinks.create_namespaces(spark, f"{tmp_path}/tables", prefix=lake.prefix)
    rows = raw_postings(spark, sf_dir).limit(300).select(
        "job_title", "company_name", "place", "salary", "experience", "level", "deadline", "job_url",
        F.col("company_industry").alias("industry"), F.split("skills", ",").alias("skills"),
    )
    write_landing(rows, lake.landing, source.name, day)
    daily.run_day(spark, lake, day, [source])
    once = spark.table(lake.titles().table).count()
    daily.run_day(spark, lake, day, [source])
    facts, index = spark.table(lake.table("gold", "fact_job_postings")), lake.titles()
    want = found(facts.where(title_like("data")))
    assert want and found(index.narrowed(facts, 8, "data", 7).where(title_like("data"))) == want
    assert once and spark.table(index.table).count() >= once
