"""The registered queries: one per operator, over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.fixtures import raw_postings
from postlake.functions.salary import salary_text
from postlake.operators import aggregate, columns, filters, ranking, web
from postlake.operators import standardize as std
from postlake.operators.upsert import upsert
from postlake.plans import daily, gold, quality, serving
from postlake.plans import silver as silver_plan
from postlake.plans.serving import Star
from postlake.registry import stage
from postlake.sinks import keyed
from postlake.sinks import tables as sinks
from postlake.sinks.title_index import TitleIndex, upsert_indexed
from postlake.sources.landing import day_path, read_json_lines, write_landing
from postlake.sources.registry import get_source
from postlake.sources.tables import read_changed_day
from postlake.streaming.landing import ingest_available

Query = Callable[[SparkSession, str], DataFrame]

DAY = dt.date(2024, 1, 15)
AS_OF = dt.date(1998, 8, 2)
KEYWORD = "data"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _joined(df: DataFrame, *names: str) -> DataFrame:
    """Lists as text, which any engine can compare."""
    return df.withColumns({name: F.array_join(name, "|") for name in names})


# --- sources and filters ------------------------------------------------------------


def src_json_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text with a fixed schema; the texts of ``error`` events lost their last character."""
    cut = F.when(
        F.col("event_type") == "error", F.expr("substring(props, 1, length(props) - 1)")
    ).otherwise(F.col("props"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": filters.CORRUPT}
    schema = f"k int, {filters.CORRUPT} string"
    parsed = _table(spark, sf_dir, "events").select(
        "event_id", F.from_json(cut, schema, options).alias("row")
    )
    parsed = parsed.select("event_id", "row.*")
    good, broken = filters.split_corrupt(parsed)
    return columns.union_by_name([good, broken])


def snk_landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All postings through JSON Lines landing files and back."""
    path = stage.staging_path(spark, sf_dir, "landing")
    rows = raw_postings(spark, sf_dir).select(
        F.col("posting_key").cast("string"), "job_title", "salary", "place",
        F.split("skills", ",").alias("skills"), "job_url",
    )
    writer = rows.write.mode("overwrite").option("ignoreNullFields", "false")
    stage.once(path, lambda: writer.json(path))
    schema = rows.schema.add(filters.CORRUPT, "string")
    good, _ = filters.split_corrupt(read_json_lines(spark, path, schema))
    return _joined(good, "skills")


def snk_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties as JSON lines, those of errors cut short: the bad lines set aside and
    read back."""
    root = stage.staging_path(spark, sf_dir, "quarantine")
    cut = F.expr("IF(event_type = 'error', substring(props, 1, length(props) - 1), props)")

    def run() -> None:
        _table(spark, sf_dir, "events").select(cut).write.mode("overwrite").text(f"{root}/lines")
        lines = read_json_lines(spark, f"{root}/lines", f"k int, {filters.CORRUPT} string")
        sinks.write_quarantine(filters.split_corrupt(lines)[1], f"{root}/aside", replace=True)

    stage.once(root, run)
    aside = spark.read.schema(f"{filters.CORRUPT} string")
    return aside.option("columnNameOfCorruptRecord", "_none").json(f"{root}/aside")


def _lake(spark: SparkSession, sf_dir: str) -> daily.Lake:
    """A lake of its own below the staging folder."""
    root = stage.staging_path(spark, sf_dir, "lake_run")
    prefix = f"of_{root.split('/')[-2]}_"
    lake = daily.Lake(f"{root}/landing", f"{root}/quarantine", buckets=8, prefix=prefix)
    sinks.create_namespaces(spark, f"{root}/tables", prefix=prefix)
    return lake


def run_day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All postings as landing files of a past day, from there to gold, and all of it again:
    rows of the tables."""
    lake, source = _lake(spark, sf_dir), get_source("careerviet")

    def run() -> None:
        rows = raw_postings(spark, sf_dir).select(
            "job_title", "company_name", "place", "salary", "experience", "level", "deadline",
            "job_url", F.col("company_industry").alias("industry"), F.split("skills", ",").alias("skills"),
        )
        write_landing(rows, lake.landing, source.name, DAY)
        for _ in range(2):
            daily.run_day(spark, lake, DAY, [source])

    stage.once(lake.landing, run)
    names = {
        "bronze": ("bronze", source.table), "silver": ("silver", source.table),
        "rejects": ("silver", f"{source.table}_dlq"), "facts": ("gold", "fact_job_postings"),
    }
    return columns.union_by_name(
        [
            spark.table(lake.table(*table)).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
            for name, table in names.items()
        ]
    )


def _landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_postings(spark, sf_dir).select(
        "posting_key", "job_title", "company_name", "place", "salary", "experience", "level", "deadline",
        "job_url", F.col("company_industry").alias("industry"),
    )


def run_day_and_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day fed by a stream and a daily run: some files arrive before the stream, the others
    after it.  The stream's batch is then tried again, a stream without a checkpoint reads the whole
    folder, and the daily run runs twice: rows of bronze with the kind of load that brought them."""
    root = stage.staging_path(spark, sf_dir, "shared_day")
    source, at = get_source("careerviet"), F.lit(f"{DAY} 05:00:00").cast("timestamp")
    prefix = f"{_lake(spark, sf_dir).prefix}shared_"
    shared = daily.Lake(f"{root}/landing", f"{root}/quarantine", buckets=8, prefix=prefix)
    sinks.create_namespaces(spark, f"{root}/tables", prefix=shared.prefix)

    def land(even: bool, mode: str) -> None:
        rows = _landing_rows(spark, sf_dir).where((F.col("posting_key") % 2 == 0) == even).drop("posting_key")
        path = f"{day_path(shared.landing, DAY)}/{source.name}_jobs.json"
        rows.write.mode(mode).option("ignoreNullFields", "false").json(path)

    def run() -> None:
        land(True, "overwrite")
        ingest_available(spark, shared, source, f"{root}/checkpoint", at).awaitTermination()
        land(False, "append")
        for _ in range(2):
            daily.run_bronze(spark, shared, source, DAY, at)
        ingest_available(spark, shared, source, f"{root}/another", at).awaitTermination()

    stage.once(root, run)
    bronze = spark.table(shared.table("bronze", source.table))
    return bronze.select(
        "job_title", "company_name", "place", "salary", "job_url", F.split("load", "-")[0].alias("brought_by")
    )


def snk_split_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves of all postings written by one job, the counts taken from what was written."""
    halves = silver_plan.split_stored(raw_postings(spark, sf_dir), "halves")
    complete, rejected = (half.select(F.lit(flag).alias("complete"), "source") for half, flag in zip(halves, (True, False), strict=True))
    return columns.union_by_name([complete, rejected]).groupBy("complete", "source").agg(F.count(F.lit(1)).alias("n"))


def snk_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events appended to a day-partitioned table, read back with the day."""
    sinks.create_namespaces(spark, stage.staging_path(spark, sf_dir, "lake"))
    table = "bronze.events_" + stage.staging_path(spark, sf_dir, "x").split("/")[-2]
    if not spark.catalog.tableExists(table):
        rows = _table(spark, sf_dir, "events").withColumn("ingest_date", F.to_date("ts"))
        # Many days at once: gather each for few files; AQE splits a large day.
        sinks.append_or_create(rows.hint("rebalance", "ingest_date"), table, "ts")
    return spark.table(table)


def flt_day_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.day_slice(_table(spark, sf_dir, "events"), DAY, "ts")


def flt_required_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = filters.split_required(raw_postings(spark, sf_dir))
    keyed = [
        part.select("posting_key", F.lit(flag).alias("complete"))
        for part, flag in ((good, True), (bad, False))
    ]
    return columns.union_by_name(keyed)


def snk_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filters.retain(raw_postings(spark, sf_dir), "ingested_at", AS_OF)
    return kept.select("posting_key", "ingested_at")


# --- projections and set operations --------------------------------------------------

# Raw column names of the four sources; the renames lead back to the common ones.
_RAW_NAMES = {
    "site_a": {"company_name": "name_company", "company_industry": "field"},
    "site_b": {"scale": "company_size"},
    "site_c": {"company_name": "name_company", "company_industry": "field"},
    "site_d": {"company_industry": "industry"},
}


def _sites(raw: DataFrame) -> dict[str, DataFrame]:
    return {
        site: raw.filter(F.col("source") == site).drop("source").withColumnsRenamed(names)
        for site, names in _RAW_NAMES.items()
    }


def prj_conform_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        silver_plan.conform_source(part, site, {raw: name for name, raw in _RAW_NAMES[site].items()})
        for site, part in _sites(raw_postings(spark, sf_dir)).items()
    ]
    return columns.union_by_name(parts).select(
        "posting_key", "source", "company_name", "company_industry", "scale"
    )


def set_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources with different columns: one lacks the salary, one the level."""
    raw = raw_postings(spark, sf_dir)
    return columns.union_by_name(
        [
            raw.filter(F.col("source").isin("site_a", "site_b")).select("posting_key", "salary"),
            raw.filter(F.col("source").isin("site_c", "site_d")).select("posting_key", "level"),
        ]
    )


# --- standardizers ----------------------------------------------------------------------


def _standardizer(step: Callable[[DataFrame], DataFrame], *outputs: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return step(raw_postings(spark, sf_dir)).select("posting_key", *outputs)

    return query


def std_skills_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lists and array lists side by side."""
    raw = raw_postings(spark, sf_dir)
    both = raw.withColumn("skills_listed", F.split("skills", ","))
    from_text = std.normalize_skills(both).withColumnRenamed("skills_array", "from_text")
    out = std.normalize_skills(from_text, "skills_listed").withColumnRenamed(
        "skills_array", "from_array"
    )
    return _joined(out.select("posting_key", "from_text", "from_array"), "from_text", "from_array")


def std_skills_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = std.enrich_skills_from_title(std.normalize_skills(raw_postings(spark, sf_dir)))
    return _joined(out.select("posting_key", "skills_array"), "skills_array")


# --- silver -------------------------------------------------------------------------------


def _silver(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    raw = raw_postings(spark, sf_dir)
    silver = silver_plan.complete_postings(raw, tie_breaks=stage.TIE_BREAKS, **how)
    return _joined(silver, "skills_array")


def dst_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = silver_plan.one_per_posting(raw_postings(spark, sf_dir), stage.TIE_BREAKS)
    return latest.select("job_id", "posting_key")


def silver_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


def silver_postings_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir, dedup_first=True)


def snk_dlq_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = silver_plan.rejected_postings(raw_postings(spark, sf_dir))
    return _joined(sinks.rejects(rejected).drop("failed_at"), "skills_array")


def srt_cap_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_postings(spark, sf_dir).select("source", "posting_key", "ingested_at")
    order = [F.col("ingested_at").desc(), F.col("posting_key").desc()]
    return ranking.top_per_group(rows, "source", order, 200)


def dq_batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver_plan.metrics_input(raw_postings(spark, sf_dir))
    return aggregate.batch_metrics(rows, "job_id", "complete")


# --- gold -----------------------------------------------------------------------------------


def _built(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(stage.silver(spark, sf_dir))


# --- upserts -----------------------------------------------------------------------------------


def _update_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later batch, stored as the daily run stores it: every posting again,
    the incomplete ones as new keys.

    Of ``site_a`` the category changed, of ``site_c`` the industry is missing.
    """

    def make() -> DataFrame:
        latest = silver_plan.one_per_posting(raw_postings(spark, sf_dir), stage.TIE_BREAKS)
        category = F.when(F.col("source") == "site_a", "Moved").otherwise(F.col("job_category"))
        industry = F.when(F.col("source") != "site_c", F.col("company_industry"))
        return silver_plan.to_silver(latest).withColumns(
            {
                "job_category": category,
                "company_industry": industry,
                "ingested_at": F.expr("ingested_at + INTERVAL 1 DAY"),
            }
        )

    return stage.staged(spark, sf_dir, "update_batch", make)


def ups_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = stage.silver(spark, sf_dir), _update_batch(spark, sf_dir)
    merged = upsert(target, source, "job_id", guard=silver_plan.GUARD, keep=silver_plan.KEEP)
    return _joined(merged, "skills_array")


def ups_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = gold.dim_company(_update_batch(spark, sf_dir))
    return upsert(stage.StagedStar(spark, sf_dir).dim_company, source, "company_id", set_null=True)


def ups_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = gold.fact_job_postings(_update_batch(spark, sf_dir))
    return upsert(stage.StagedStar(spark, sf_dir).fact_job_postings, source, "job_id")


def ups_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = gold.bridge_job_skills(_update_batch(spark, sf_dir), one_row_per_job=True)
    target = stage.StagedStar(spark, sf_dir).bridge_job_skills
    return upsert(target, source, "bridge_id", insert_only=True)


def snk_upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver into a table that does not exist yet, then the later batch into it."""
    table = _lake(spark, sf_dir).table("silver", "upserted")

    def run() -> None:
        for rows in (stage.silver(spark, sf_dir), _update_batch(spark, sf_dir)):
            sinks.upsert_table(
                rows, table, "job_id", buckets=8, guard=silver_plan.GUARD, keep=silver_plan.KEEP
            )

    stage.once(stage.staging_path(spark, sf_dir, "upserted"), run)
    return _joined(spark.table(table).drop(keyed.KEY_PARTITION), "skills_array")


def src_changed_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver loaded on one day and the later batch on the next: what changed on each, by the
    change feed."""
    table, next_day = _lake(spark, sf_dir).table("silver", "changing"), DAY + dt.timedelta(days=1)

    def run() -> None:
        for rows, day in ((stage.silver(spark, sf_dir), DAY), (_update_batch(spark, sf_dir), next_day)):
            stamped = rows.withColumn("updated_at", F.lit(f"{day} 06:00:00").cast("timestamp"))
            sinks.upsert_table(
                stamped, table, "job_id", buckets=8, feed_ts="updated_at", guard=silver_plan.GUARD,
                keep=silver_plan.KEEP,
            )

    stage.once(stage.staging_path(spark, sf_dir, "changing"), run)
    found = [
        read_changed_day(spark, table, day).select(
            "job_id", "job_category", "company_industry", F.to_date("updated_at").alias("changed_on")
        )
        for day in (DAY, next_day)
    ]
    return columns.union_by_name(found)


def snk_append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links into a table that does not exist yet, then those of the later batch."""
    table = _lake(spark, sf_dir).table("gold", "links")

    def run() -> None:
        for rows in (stage.silver(spark, sf_dir), _update_batch(spark, sf_dir)):
            links = gold.bridge_job_skills(rows, one_row_per_job=True)
            sinks.append_new(links, table, "bridge_id", by="job_id", buckets=8)

    stage.once(stage.staging_path(spark, sf_dir, "links"), run)
    return spark.table(table).drop(keyed.KEY_PARTITION)


# --- serving and quality -------------------------------------------------------------------------


def _asked(question: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, sf_dir: question(stage.StagedStar(spark, sf_dir))


def srv_salary_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = stage.StagedStar(spark, sf_dir).fact_job_postings
    text = salary_text(F.col("salary_min"), F.col("salary_max"), F.col("salary_currency"))
    return facts.select("job_id", text.alias("salary_text"))


def _searched_by_index(keyword: str) -> Query:
    """Facts under other titles first, then as they are: the index of titles follows."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake, star = _lake(spark, sf_dir), stage.StagedStar(spark, sf_dir)
        table, index = lake.table("gold", "indexed_facts"), TitleIndex(lake.table("gold", "indexed_titles"))

        def run() -> None:
            title = F.col("job_title")
            earlier = F.when(title == "Accountant", "Data Engineer").when(title == "Data Analyst", "Analyst").otherwise(title)
            for facts in (star.fact_job_postings.withColumn("job_title", earlier), star.fact_job_postings):
                upsert_indexed(facts, table, "job_id", index, parts=8)

        stage.once(stage.staging_path(spark, sf_dir, "indexed_facts"), run)
        dims = {name: getattr(star, name) for name in Star.__dataclass_fields__ if name != "fact_job_postings"}
        keyed_star = Star(fact_job_postings=spark.table(table), **dims)
        return serving.search_indexed(keyed_star, index, 8, keyword)

    return query


def _checked(check: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, sf_dir: check(stage.UncheckedStar(spark, sf_dir))


def dq_bridge_orphan_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all postings against the published facts."""
    return aggregate.orphans(
        stage.UncheckedStar(spark, sf_dir).bridge_job_skills,
        stage.StagedStar(spark, sf_dir).fact_job_postings,
        "job_id",
        "invalid_bridge_jobs",
        nulls_count=True,
    )


def dq_salary_inverted_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check on amounts that do cross: quantity and thousandth of the price."""
    amounts = _table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("job_id"),
        F.col("l_quantity").alias("salary_min"),
        (F.col("l_extendedprice") / 1000).alias("salary_max"),
    )
    return quality.salary_inverted_rows(amounts)


def dq_salary_negative_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check on amounts that do go below zero: account balances."""
    amounts = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("job_id"),
        F.col("c_acctbal").alias("salary_min"),
        (F.col("c_acctbal") + 100).alias("salary_max"),
    )
    return quality.salary_negative_rows(amounts)


def dq_dup_dim_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = stage.StagedStar(spark, sf_dir)
    keyed = {
        "company_id": star.dim_company,
        "location_id": star.dim_location,
        "skill_id": star.dim_skill,
    }
    found = [
        quality.duplicates(dim, key).select(
            F.lit(key).alias("key"), F.col(key).alias("id"), "duplicate_count"
        )
        for key, dim in keyed.items()
    ]
    return columns.union_by_name(found)


def dq_dup_dim_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check on dimension rows that were not made distinct: of all postings."""
    rows = gold.fact_job_postings(stage.unchecked(spark, sf_dir))
    found = [
        quality.duplicates(rows.where(F.col(key).isNotNull()), key).select(
            F.lit(key).alias("key"), F.col(key).alias("id"), "duplicate_count"
        )
        for key in ("company_id", "location_id", "level_id", "job_category_id")
    ]
    return columns.union_by_name(found)


def dq_orphans_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orphan checks where every dimension lacks most of its rows."""
    every = stage.UncheckedStar(spark, sf_dir)
    keys = {
        "dim_company": "company_id", "dim_location": "location_id", "dim_skill": "skill_id",
        "dim_job_category": "job_category_id", "dim_level": "level_id",
    }
    dims = {name: getattr(every, name).where(F.col(key) < "4") for name, key in keys.items()}
    star = Star(
        **dims,
        fact_job_postings=every.fact_job_postings,
        bridge_job_skills=every.bridge_job_skills,
    )
    checks = (
        quality.orphaned_companies, quality.orphaned_locations, quality.orphaned_categories,
        quality.orphaned_levels, quality.invalid_bridge_skills,
    )
    found = (check(star) for check in checks)
    return columns.union_by_name(
        [one.select(F.lit(one.columns[0]).alias("check_name"), F.col(one.columns[0]).alias("n")) for one in found]
    )


def dq_orphans_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans of two days of facts, the second day's carried forward; the dimensions lack rows
    and gain some between the days."""
    lake = _lake(spark, sf_dir)
    facts, state = lake.table("gold", "carried_facts"), lake.table("gold", "carried_orphans")
    star = stage.StagedStar(spark, sf_dir)

    def dims(below: str) -> dict[str, tuple[DataFrame, str]]:
        return {name: (getattr(star, dim).where(F.col(key) < below), key) for name, (dim, key) in quality.DIMENSIONS.items()}

    def run() -> None:
        for rows, below in ((stage.silver(spark, sf_dir), "4"), (_update_batch(spark, sf_dir), "8")):
            touched = keyed.upsert_keyed(gold.fact_job_postings(rows), facts, "job_id", parts=8)
            quality.carry_orphans_forward(spark, facts, dims(below), state, touched)

    stage.once(stage.staging_path(spark, sf_dir, "carried"), run)
    return quality.carried_orphans(spark, state)


# --- web pages -------------------------------------------------------------------------------------


def web_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = web.LinkRule(any_of=("/",), host="https://jobs.example", unique=True)
    return web.links(_table(spark, sf_dir, "pages"), rule).select("page_id", "link")


def web_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.titles(_table(spark, sf_dir, "pages")).select("page_id", "job_title")


def web_list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = web.list_items(_table(spark, sf_dir, "pages"))
    return _joined(items.select("page_id", "items"), "items")


def web_label_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes as label-value pairs."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "html")
    wanted = {"lang": "lang", "charset": "charset", "last_class": "class", "last_href": "href"}
    return web.labelled_values(pages, r'\b([a-z]+)="([^"]*)"', wanted)


def _marked_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose list entries hold text before their link, on half of the pages within a box;
    links under "/a" lie one element deeper; the list stands in an item of an outer one."""
    html = F.regexp_replace("html", '<a href="/a([^"]*)">([^<]*)</a>', '<span><a href="/a$1">$2</a></span>')
    html = F.regexp_replace(html, "<li>", '<li class="job title">See <b>this ')
    box = F.when(F.col("page_id") % 2 == 0, '<nav class="body-box">').otherwise('<nav class="body-boxes">')
    html = F.replace(html, F.lit("<nav>"), box)
    html = F.regexp_replace(html, "(?s)<ul>(.*?)</ul>", "<ul><li>Before <ul>$1</ul> after</li></ul>")
    return _table(spark, sf_dir, "pages").select("page_id", html.alias("html"))


def web_child_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links that are children of an entry within a box, in whatever place."""
    rule = web.LinkRule(child_of="title", inside="body-box", host="https://jobs.example")
    loose = _marked_lists(spark, sf_dir).withColumn("html", F.replace("html", F.lit("<b>"), F.lit("")))
    return web.links(loose, rule)


def web_whole_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with the text of inner lists and what follows them; no end tag closes the "b"."""
    return _joined(web.whole_items(_marked_lists(spark, sf_dir)), "items")


def web_grouped_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings as pages of labels and values, read back by label."""
    raw = raw_postings(spark, sf_dir)

    def group(label: str, name: str):
        shown = f'<div class="group"><div><p class="label"> {label}<div class="value">'
        return F.concat(F.lit(shown), F.replace(F.trim(name), F.lit("&"), F.lit("<i>&amp;</i>")), F.lit("</div></div></div>"))

    groups = [group("Level", "company_industry"), group("Size", "scale"), group("Level", "level"), group("Place", "place")]
    html = F.concat_ws("\n", F.lit("<body><p>Postings<br>"), *groups)
    wanted = {"level": "Level", "scale": "Size", "place": "Place", "none": "Other"}
    return web.grouped_values(raw.select("posting_key", html.alias("html")), "group", "label", "value", wanted)


QUERIES: dict[str, Query] = {
    "src_json_permissive": src_json_permissive,
    "snk_landing_roundtrip": snk_landing_roundtrip,
    "snk_append": snk_append,
    "snk_quarantine": snk_quarantine,
    "run_day_counts": run_day_counts,
    "run_day_and_stream": run_day_and_stream,
    "snk_split_write": snk_split_write,
    "snk_upsert_table": snk_upsert_table,
    "snk_append_new": snk_append_new,
    "src_changed_day": src_changed_day,
    "snk_dlq_rows": snk_dlq_rows,
    "snk_retention": snk_retention,
    "flt_day_slice": flt_day_slice,
    "flt_required_split": flt_required_split,
    "prj_conform_union": prj_conform_union,
    "set_union_by_name": set_union_by_name,
    "std_salary": _standardizer(
        std.extract_salary, "salary_raw", "salary_min", "salary_max", "salary_currency"
    ),
    "std_salary_band": _standardizer(
        lambda df: std.enrich_salary_band(std.extract_salary(df)), "salary_band"
    ),
    "std_deadline": _standardizer(std.parse_deadline, "deadline_date"),
    "std_location": _standardizer(std.standardize_location, "location"),
    "std_experience": _standardizer(std.standardize_experience, "experience_req"),
    "std_level": _standardizer(std.standardize_level, "level_processed"),
    "std_working_type": _standardizer(std.standardize_working_type, "working_type_std"),
    "std_skills_split": std_skills_split,
    "std_skills_enrich": std_skills_enrich,
    "std_job_category": _standardizer(std.standardize_job_category, "job_category"),
    "std_company_size": _standardizer(std.standardize_company_size, "company_size_std"),
    "std_job_id": _standardizer(std.generate_job_id, "job_id"),
    "std_company_id": _standardizer(std.generate_company_id, "company_id"),
    "dst_latest_per_key": dst_latest_per_key,
    "srt_cap_per_source": srt_cap_per_source,
    "silver_postings": silver_postings,
    "silver_postings_dedup_first": silver_postings_dedup_first,
    "gold_dim_company": _built(gold.dim_company),
    "gold_dim_location": _built(gold.dim_location),
    "gold_dim_job_category": _built(gold.dim_job_category),
    "gold_dim_skill": _built(gold.dim_skill),
    "gold_dim_level": _built(gold.dim_level),
    "gold_fact": _built(gold.fact_job_postings),
    "gold_bridge": _built(lambda rows: gold.bridge_job_skills(rows, one_row_per_job=True)),
    "gold_bridge_distinct": _built(gold.bridge_job_skills),
    "ups_guarded": ups_guarded,
    "ups_scd1": ups_scd1,
    "ups_fact": ups_fact,
    "ups_insert_only": ups_insert_only,
    "srv_search": _asked(lambda star: serving.search(star, KEYWORD)),
    "srv_search_page": _asked(lambda star: serving.search_pages(star, KEYWORD)),
    "srv_salary_text": srv_salary_text,
    "srv_stats_by_source": _asked(serving.stats),
    "srv_stats_with_total": _asked(serving.stats_with_total),
    "srv_stats_rolled_up": _asked(serving.stats_rolled_up),
    "srv_every_page": _asked(lambda star: serving.every_page(star, KEYWORD)),
    "srv_search_indexed": _searched_by_index(KEYWORD),
    "srv_search_indexed_wildcard": _searched_by_index("d_ta%eng"),
    "srv_search_bound": lambda spark, sf_dir: serving.search_bound(spark, stage.StagedStar(spark, sf_dir), KEYWORD),
    "srv_top_skills": _asked(serving.top_skills),
    "srv_top_skills_ranked": _asked(serving.top_skills_ranked),
    "srv_top_locations": _asked(serving.top_locations),
    "dq_completeness": _checked(quality.completeness),
    "dq_dup_job_id": _checked(lambda star: quality.duplicates(star.fact_job_postings, "job_id")),
    "dq_dup_dim_keys": dq_dup_dim_keys,
    "dq_dup_dim_rows": dq_dup_dim_rows,
    "dq_orphans_company": _checked(quality.orphaned_companies),
    "dq_orphans_location": _checked(quality.orphaned_locations),
    "dq_orphans_category": _checked(quality.orphaned_categories),
    "dq_orphans_level": _checked(quality.orphaned_levels),
    "dq_bridge_orphan_jobs": dq_bridge_orphan_jobs,
    "dq_bridge_orphan_skills": _checked(quality.invalid_bridge_skills),
    "dq_orphans_parts": dq_orphans_parts,
    "dq_orphans_carried": dq_orphans_carried,
    "dq_salary_inverted": _checked(lambda s: quality.salary_inverted_rows(s.fact_job_postings)),
    "dq_salary_inverted_amounts": dq_salary_inverted_amounts,
    "dq_salary_negative_amounts": dq_salary_negative_amounts,
    "dq_dup_company_id": _checked(
        lambda star: quality.duplicates(star.fact_job_postings, "company_id")
    ),
    "dq_salary_negative": _checked(lambda s: quality.salary_negative_rows(s.fact_job_postings)),
    "dq_batch_metrics": dq_batch_metrics,
    "web_links": web_links,
    "web_title": web_title,
    "web_list_items": web_list_items,
    "web_label_values": web_label_values,
    "web_child_links": web_child_links,
    "web_whole_items": web_whole_items,
    "web_grouped_values": web_grouped_values,
}
