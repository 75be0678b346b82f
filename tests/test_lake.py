"""Sources, sinks and the daily run, end to end on plain Spark tables."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from postlake.operators import filters
from postlake.plans import daily
from postlake.plans import quality
from postlake.plans.serving import Star, search, stats, top_skills
from postlake.plans.silver import GUARD
from postlake.registry.oracles import _GUARD
from postlake.sinks import serving, tables
from postlake.sources import landing, registry
from postlake.streaming.landing import ingest_available

DAY = dt.date(2026, 1, 5)
NEXT = dt.date(2026, 1, 6)


def at(day, time="08:00:00"):
    return F.lit(f"{day} {time}").cast("timestamp")


def drop_file(root, source, day, lines):
    path = root / f"year={day:%Y}" / f"month={day:%m}" / f"day={day:%d}"
    path.mkdir(parents=True, exist_ok=True)
    text = "\n".join(line if isinstance(line, str) else json.dumps(line, ensure_ascii=False) for line in lines)
    (path / f"{source}_jobs.json").write_text(text + "\n", encoding="utf-8")


def star_now(spark):
    return Star.from_catalog(spark)


def test_schemas():
    assert list(registry.SOURCES) == ["itviec", "vietnamworks", "careerviet", "topcv"]
    with pytest.raises(ValueError):
        registry.get_source("elsewhere")
    assert [s.name for s in registry.select_sources("topcv")] == ["topcv"]
    assert len(registry.select_sources("all")) == 4


def test_load_schema(spark, tmp_path):
    sizes = {"itviec": 15, "vietnamworks": 15, "careerviet": 13, "topcv": 18}
    for name, size in sizes.items():
        schema = registry.load_schema(name)
        assert len(schema) == size + 1 and schema.names[-1] == "_corrupt_record"
        own = registry.load_schema(name)
        (tmp_path / f"{name}_schema.json").write_text(
            json.dumps({"type": "struct", "fields": [f.jsonValue() for f in own.fields[:-1]]})
        )
        assert registry.load_schema(name, tmp_path) == schema
    with pytest.raises(FileNotFoundError):
        registry.load_schema("topcv", tmp_path / "nowhere")


def test_permissive_json(spark, tmp_path):
    drop_file(
        tmp_path, "careerviet", DAY,
        [
            {"job_title": "Đầu bếp", "skills": ["a"], "unknown": 1},
            '{"job_title": "cut',
            {"job_title": "type", "skills": "text"},
            {"job_title": {"x": 1}},
            '[{"job_title": "first"}, {"job_title": "second"}]',
        ],
    )
    df = landing.read_landing(spark, str(tmp_path), "careerviet", DAY)
    rows = df.collect()
    good = {r.job_title for r in rows if r._corrupt_record is None}
    assert good == {"Đầu bếp", '{"x": 1}', "first", "second"}
    assert sum(r._corrupt_record is not None for r in rows) == 2


def test_landing_roundtrip(spark, tmp_path):
    schema = registry.load_schema("vietnamworks")
    rows = spark.createDataFrame([("Kỹ sư", None)], "job_title string, salary string")
    path = landing.write_landing(rows, str(tmp_path), "vietnamworks", DAY)
    assert path.endswith("year=2026/month=01/day=05/vietnamworks_jobs.json")
    text = spark.read.text(path).first()[0]
    assert text == '{"job_title":"Kỹ sư","salary":null}'
    back = landing.read_landing(spark, str(tmp_path), "vietnamworks", DAY)
    assert back.schema == schema and back.first().job_title == "Kỹ sư"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    tables.create_namespaces(spark, str(root / "tables"))
    tables.create_namespaces(spark, str(root / "tables"))
    (root / "landing").mkdir()
    return daily.Lake(landing=str(root / "landing"), quarantine=str(root / "quarantine"), buckets=8)


def posting(n, **fields):
    return {
        "job_title": f"Java dev {n}", "name_company": f"Company {n % 2}", "salary": "10 - 20 triệu",
        "deadline": "Còn 5 ngày", "place": "Hà Nội", "experience": "2 năm", "level": "Senior",
        "skills": ["SQL"], "scale": "25 - 99", "job_url": f"http://x/{n}",
        "inserted_at": "2026-01-05 07:00:00",
    } | fields


def test_both_halves_of_a_landing_file_can_be_counted(spark, tmp_path):
    drop_file(tmp_path, "topcv", DAY, [posting(1), "broken", posting(2), "{"])
    good, bad = filters.split_corrupt(landing.read_landing(spark, str(tmp_path), "topcv", DAY))
    assert (good.count(), bad.count()) == (2, 2)
    assert [r.job_url for r in good.select("job_url").collect()] == ["http://x/1", "http://x/2"]


def test_two_days(spark, lake, tmp_path_factory):
    root = Path(lake.landing)
    drop_file(
        root, "topcv", DAY,
        [posting(1), posting(2, deadline=None), posting(2, deadline=None), posting(3, job_title=" "), "broken"],
    )
    drop_file(
        root, "careerviet", DAY,
        [{"job_title": "QA Tester", "company_name": "D", "job_url": "http://d/1", "skills": []}],
    )
    sources = [registry.get_source("topcv"), registry.get_source("careerviet")]
    metrics = daily.run_day(spark, lake, DAY, sources, at(DAY))
    assert metrics[0] == {
        "source": "topcv", "run_date": "2026-01-05", "bronze_count": 4, "silver_count": 2,
        "dropped_count": 2, "rejected_count": 1, "repeat_count": 1, "drop_rate": 0.5,
    }
    assert spark.table("silver.topcv_jobs_dlq").first().error_reason == "Missing mandatory fields"
    assert spark.read.json(f"{lake.quarantine}/topcv_jobs").count() == 1
    star = Star.from_catalog(spark)
    assert {(r.source, r["count"]) for r in stats(star).collect()} == {("topcv", 2), ("careerviet", 1)}
    assert {tuple(r) for r in top_skills(star).collect()} == {("SQL", 2), ("Java", 2)}

    # The next day: one posting moved, one new, one unchanged but for a skill.
    drop_file(
        root, "topcv", NEXT,
        [posting(1, place="Đà Nẵng", salary=None), posting(2, deadline=None, skills=["Rust"]), posting(4)],
    )
    daily.run_day(spark, lake, NEXT, sources[:1], at(NEXT))
    silver = {r.job_url: r for r in spark.table("silver.topcv_jobs").collect()}
    assert len(silver) == 3
    moved = silver["http://x/1"]
    assert (moved.location, moved.salary_raw) == ("Đà Nẵng", "10 - 20 triệu")
    assert (moved.ingested_at.day, moved.updated_at.day) == (5, 6)
    assert silver["http://x/2"].skills_array == ["SQL", "Java"]
    facts = {r.job_url: r for r in spark.table("gold.fact_job_postings").collect()}
    assert len(facts) == 4
    places = {r.location_id: r.location_name for r in spark.table("gold.dim_location").collect()}
    assert places[facts["http://x/1"].location_id] == "Đà Nẵng"
    assert spark.table("gold.bridge_job_skills").count() == 6

    # The tables answer plain SQL with bind parameters as well.
    hits = spark.sql(
        """SELECT f.job_title, c.company_name, l.location_name, lv.level_name
        FROM gold.fact_job_postings f
        LEFT JOIN gold.dim_company c ON f.company_id = c.company_id
        LEFT JOIN gold.dim_location l ON f.location_id = l.location_id
        LEFT JOIN gold.dim_level lv ON f.level_id = lv.level_id
        WHERE lower(f.job_title) LIKE :keyword ORDER BY f.ingested_at DESC, f.job_id LIMIT 2""",
        args={"keyword": "%java%"},
    ).collect()
    assert len(hits) == 2 and hits[0].level_name == "Senior"
    assert {tuple(r) for r in search(star_now(spark), "JAVA").select("job_url").collect()} == {
        ("http://x/1",), ("http://x/2",), ("http://x/4",)
    }
    assert quality.duplicates(spark.table("gold.fact_job_postings"), "job_id").isEmpty()
    for check in (
        quality.orphaned_companies, quality.orphaned_locations, quality.orphaned_categories,
        quality.orphaned_levels, quality.invalid_bridge_jobs, quality.invalid_bridge_skills,
    ):
        assert check(star_now(spark)).first()[0] == 0

    # A rerun changes nothing.
    before = sorted(map(str, spark.table("gold.fact_job_postings").collect()))
    daily.run_silver(spark, lake, sources[0], NEXT)
    daily.run_gold(spark, lake, NEXT)
    assert sorted(map(str, spark.table("gold.fact_job_postings").collect())) == before
    assert spark.table("gold.bridge_job_skills").count() == 6


def test_bronze_is_partitioned_and_expires(spark, lake):
    day = dt.date(2026, 1, 5)
    assert tables.expired_days(["2025-01-01", "2026-01-05"], day, 30) == ["2025-01-01"]
    spark.sql("SELECT 1 id, timestamp'2025-01-01' ingested_at").transform(
        lambda df: tables.append_or_create(df, "sandbox.scratch", "ingested_at")
        or df
    )
    tables.append_or_create(
        spark.sql("SELECT 2 id, timestamp'2026-01-05' ingested_at"), "sandbox.scratch", "ingested_at"
    )
    assert tables.drop_expired(spark, "sandbox.scratch", day) == ["2025-01-01"]
    assert [r.id for r in spark.table("sandbox.scratch").collect()] == [2]


def test_old_versions_go(spark, lake):
    for n in range(4):
        tables.publish_version(spark.range(n), "sandbox.versioned")
        assert spark.table("sandbox.versioned").count() == n
    listed = [t.name for t in spark.catalog.listTables("sandbox", "versioned*")]
    assert len(listed) == 3


def test_gold_without_silver(spark, lake):
    assert daily.run_gold(spark, lake, dt.date(2020, 1, 1)) is False
    assert daily.run_gold(spark, lake, DAY, sources=["vietnamworks"]) is False


def test_all_lines_broken(spark, lake):
    drop_file(Path(lake.landing), "vietnamworks", DAY, ["nope", "{"])
    out = daily.run_bronze(spark, lake, registry.get_source("vietnamworks"), DAY)
    assert out == {"valid": 0, "corrupt": 2}
    assert not spark.catalog.tableExists("bronze.vietnamworks_jobs")


def test_stream_reads_each_file_once(spark, lake, tmp_path):
    source = registry.get_source("itviec")
    line = {"job_title": "x", "company_name": "c", "job_url": "u", "skills": ["a"]}
    drop_file(Path(lake.landing), "itviec", DAY, [line, "bad"])
    checkpoint = str(tmp_path / "checkpoint")
    ingest_available(spark, lake, source, checkpoint, at(DAY)).awaitTermination()
    assert spark.table("bronze.itviec_jobs").count() == 1
    drop_file(Path(lake.landing), "itviec", NEXT, [line])
    ingest_available(spark, lake, source, checkpoint, at(NEXT)).awaitTermination()
    bronze = spark.table("bronze.itviec_jobs")
    assert bronze.count() == 2 and "year" not in bronze.columns


def test_native_merge_needs_a_row_level_catalog(spark, lake):
    spark.range(1).selectExpr("cast(id as string) k", "'a' a").write.saveAsTable("sandbox.plain")
    source = spark.createDataFrame([("0", "b")], "k string, a string")
    with pytest.raises(PySparkException):
        tables.native_merge(source, "sandbox.plain", "k", guard=("a",))


def test_guard_lists_agree():
    assert GUARD == _GUARD


# --- serving database: the statements, on a recording connection --------------------------


class Connection:
    def __init__(self, fail_at=None):
        self.log, self.fail_at = [], fail_at

    def setAutoCommit(self, on):
        self.log.append(("autocommit", on))

    def createStatement(self):
        return self

    def execute(self, sql):
        if self.fail_at and self.fail_at in sql:
            raise RuntimeError(sql)
        self.log.append(sql)

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


def test_swap():
    connection = Connection()
    serving.swap_in(lambda: connection, "t")
    assert connection.log == [
        ("autocommit", False),
        "DROP TABLE IF EXISTS t_old",
        "ALTER TABLE IF EXISTS t RENAME TO t_old",
        "ALTER TABLE t_temp RENAME TO t",
        "DROP TABLE IF EXISTS t_old",
        "commit",
        "close",
    ]
    connection = Connection(fail_at="t_temp")
    with pytest.raises(RuntimeError):
        serving.swap_in(lambda: connection, "t")
    assert connection.log[-2:] == ["rollback", "close"] and "commit" not in connection.log


def test_publish_order_and_abort(spark):
    done = []

    def publish(_, source, table, url, properties):
        if table == "dim_skill":
            raise RuntimeError(table)
        done.append((source, table))
        return True

    with pytest.raises(RuntimeError):
        serving.publish_all(spark, "url", {}, publish=publish)
    assert done == [(f"gold.{t}", t) for t in ("dim_company", "dim_location", "dim_job_category")]
    assert serving.publish_table(spark, "gold.missing", "missing", "url", {}) is False


def test_a_past_day_keeps_its_rows(spark, lake, tmp_path):
    place = daily.Lake(landing=str(tmp_path / "landing"), quarantine=str(tmp_path / "q"), buckets=8)
    source = registry.get_source("vietnamworks")
    past = dt.date(2025, 11, 3)
    drop_file(Path(place.landing), source.name, past, [posting(n, skills="SQL") for n in range(5)])
    metrics = daily.run_day(spark, place, past, [source])
    assert (metrics[0]["bronze_count"], metrics[0]["silver_count"]) == (5, 5)
    days = {r.d for r in spark.table("gold.fact_job_postings").where("source = 'vietnamworks'").selectExpr("to_date(ingested_at) d").collect()}
    assert days == {past}


def test_a_rerun_replaces_its_day(spark, lake):
    source, day = registry.get_source("topcv"), dt.date(2026, 3, 1)
    root = Path(lake.landing)
    drop_file(root, "topcv", day, [posting(71), posting(72), posting(73, job_title=" "), "broken"])
    drop_file(root, "topcv", dt.date(2026, 3, 2), [posting(74)])
    daily.run_day(spark, lake, dt.date(2026, 3, 2), [source])

    def rows():
        kept = [spark.table(f"bronze.{source.table}"), spark.table(f"silver.{source.table}_dlq")]
        return [df.where("ingest_date >= '2026-03-01'").count() for df in kept] + [
            spark.read.json(f"{lake.quarantine}/topcv_jobs").where("month = '03'").count()
        ]

    first = daily.run_day(spark, lake, day, [source])
    assert rows() == [4, 1, 1]
    assert daily.run_day(spark, lake, day, [source]) == first
    assert rows() == [4, 1, 1]
    drop_file(root, "topcv", day, [posting(71)])
    daily.run_day(spark, lake, day, [source])
    assert rows()[0] == 2


def test_search_exchanges_no_dimension(spark, sf_dir):
    from postlake.registry.stage import StagedStar

    star = StagedStar(spark, sf_dir)
    expected = search(star, "data").collect()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = search(star, "data")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.collect() == expected and len(expected) == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 6
    with pytest.raises(ValueError):
        search(star, "data", limit=1_000_000)
