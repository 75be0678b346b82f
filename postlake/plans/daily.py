"""The daily run: landing -> bronze -> silver -> gold -> serving.

Every step can be rerun.  Bronze and quarantine of a load and the rejects of a day are replaced,
silver and gold are keyed upserts; the batch between them is a table in the shared staging
folder, so that its several readers do not compute it again and a lost executor costs one task.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postlake.operators.columns import with_audit
from postlake.operators.filters import CORRUPT, has_rows, split_corrupt
from postlake.plans import gold
from postlake.plans import silver as silver_plan
from postlake.session import stored
from postlake.sinks import ledger
from postlake.sinks import tables as sinks
from postlake.sinks.title_index import TitleIndex, upsert_indexed
from postlake.sources.landing import day_path, read_landing
from postlake.sources.registry import SOURCES, Source
from postlake.sources.tables import read_day, read_united_day

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Lake:
    """Where a run reads and writes.

    ``catalog`` prefixes all tables; ``row_level`` says it has native MERGE.
    ``buckets`` is the file count of keyed tables on a plain catalog; at least
    ``spark.sql.shuffle.partitions``, or joins shuffle them anyway.
    ``compat`` keeps three habits that lose rows: a day that ends at
    23:59:59, one row per posting before incomplete ones are split off, and
    gold reading by first load instead of last change.  ``prefix`` tells
    several lakes of one catalog apart: it comes before every namespace.
    ``title_index`` keeps trigram postings of the facts' titles, on a plain catalog.
    """

    landing: str
    quarantine: str
    catalog: str | None = None
    row_level: bool = False
    buckets: int | None = None
    schema_dir: str | None = None
    compat: bool = False
    prefix: str = ""
    title_index: bool = False

    def titles(self) -> TitleIndex:
        return TitleIndex(self.table("gold", "title_index"))

    def table(self, namespace: str, name: str) -> str:
        return ".".join(part for part in (self.catalog, self.prefix + namespace, name) if part)


# --- bronze ---------------------------------------------------------------------------


def write_bronze(
    landed: DataFrame,
    lake: Lake,
    source: str,
    load: str,
    aside: str,
    ingested_at: Column | None = None,
) -> dict[str, int]:
    """Make the parsed rows the rows of a load, set its unparsable lines aside; how many of each.

    ``landed`` says which file a row is from: files of other loads are passed over.  Bad lines
    and files are noted while the good rows are written, so a clean file is parsed once; only
    a file with bad lines is read a second time.
    """
    spark, table = landed.sparkSession, lake.table("bronze", f"{source}_jobs")
    fresh = ledger.not_taken(landed, table, load)
    good, bad = split_corrupt(fresh)
    if not has_rows(good):
        log.warning("no valid rows for %s in %s", source, load)
        if spark.catalog.tableExists(table) and not lake.row_level:
            ledger.drop_load(spark, table, load)
        return {"valid": 0, "corrupt": sinks.write_quarantine(_lines(bad), aside, replace=True)}
    counts = Observation()
    broken = F.col(CORRUPT).isNotNull()
    counted = fresh.observe(
        counts, F.count_if(~broken).alias("valid"), F.count_if(broken).alias("corrupt"), ledger.taken_files()
    )
    rows = with_audit(split_corrupt(counted)[0].drop(ledger.FILE, ledger.MODIFIED), source, ingested_at)
    ledger.put_load(rows, table, "ingested_at", load, row_level=lake.row_level)
    found = counts.get
    if found["corrupt"]:
        log.warning("%s: %s corrupt lines set aside", source, found["corrupt"])
        sinks.write_quarantine(_lines(bad), aside, replace=True)
    else:  # an earlier attempt may have had some
        none = spark.createDataFrame([], f"{CORRUPT} string")
        sinks.write_quarantine(none, aside, replace=True)
    ledger.record(spark, table, load, found["files"])
    return {name: found[name] for name in ("valid", "corrupt")}


def _lines(bad: DataFrame) -> DataFrame:
    return bad.drop(ledger.FILE, ledger.MODIFIED)


def run_time(day: dt.date) -> Column:
    """The time of day of now, on the day the run is for: a rerun or a backfill lands in its
    own day's slice."""
    now = F.date_format(F.current_timestamp(), "HH:mm:ss.SSSSSS")
    return F.to_timestamp(F.concat(F.lit(f"{day.isoformat()} "), now))


def run_bronze(
    spark: SparkSession,
    lake: Lake,
    source: Source,
    day: dt.date,
    ingested_at: Column | None = None,
) -> dict[str, int]:
    """The day's landing files that no other load has taken; a rerun replaces its own rows."""
    landed = read_landing(spark, lake.landing, source.name, day, lake.schema_dir, files=True)
    stamp = run_time(day) if ingested_at is None else ingested_at
    load = f"day-{day.isoformat()}"
    aside = f"{day_path(f'{lake.quarantine}/{source.name}_jobs', day)}/load={load}"
    return write_bronze(landed, lake, source.name, load, aside, stamp)


# --- silver ---------------------------------------------------------------------------


def run_silver(spark: SparkSession, lake: Lake, source: Source, day: dt.date) -> dict[str, object]:
    """Standardize one day of a source's bronze rows and upsert them.  Returns AGG-5.

    One scan of bronze splits the day (``split_stored``); both halves and all counts are read
    from what it wrote, so a task that runs twice counts once.
    """
    bronze = read_day(
        spark, lake.table("bronze", source.table), day, to_the_second=lake.compat
    )
    conformed = silver_plan.conform_source(bronze, source.name, source.renames)
    if lake.compat:
        conformed = silver_plan.one_per_posting(conformed)
    complete, rejected = silver_plan.split_stored(conformed, source.table)
    total, rejects = (bronze if lake.compat else complete).count(), rejected.count()
    if not lake.compat:
        total += rejects
    batch = stored(silver_plan.with_updated_at(silver_plan.latest_postings(complete)), source.table)
    kept = batch.count()
    if kept:
        sinks.upsert_table(
            batch,
            lake.table("silver", source.table),
            "job_id",
            row_level=lake.row_level,
            partition_ts="ingested_at",
            buckets=lake.buckets,
            feed_ts="updated_at",
            guard=silver_plan.GUARD,
            keep=silver_plan.KEEP,
        )
    dlq = lake.table("silver", f"{source.table}_dlq")
    if rejects:
        sinks.write_rejects(
            silver_plan.to_silver(rejected), dlq, "ingested_at", row_level=lake.row_level, replace=True
        )
    elif spark.catalog.tableExists(dlq):
        sinks.clear_day(spark, dlq, day, row_level=lake.row_level)
    return {
        "source": source.name,
        "run_date": day.isoformat(),
        "bronze_count": total,
        "rejected_count": rejects,
        "repeat_count": total - kept - rejects,
        **_dropped(total, kept),
    }


def _dropped(total: int, kept: int) -> dict[str, object]:
    """What was kept decides, also where a whole posting was rejected."""
    return {
        "silver_count": kept,
        "dropped_count": total - kept,
        "drop_rate": round(1 - kept / max(total, 1), 4),
    }


# --- gold -----------------------------------------------------------------------------


def run_gold(
    spark: SparkSession, lake: Lake, day: dt.date, sources: Iterable[str] = SOURCES
) -> bool:
    """Upsert the day's changed postings into the star schema; False if there are none."""
    tables = [lake.table("silver", f"{name}_jobs") for name in sources]
    slice_by = "ingested_at" if lake.compat else "updated_at"
    united = read_united_day(
        spark, tables, day, slice_by, to_the_second=lake.compat, skip_empty=False
    )
    if united is None:
        return False
    # One scan of silver for the day; the seven builders read their columns of it.
    rows = stored(united, "gold")
    if not has_rows(rows):
        return False

    def put(df: DataFrame, name: str, key: str, **rule) -> None:
        sinks.upsert_table(
            df,
            lake.table("gold", name),
            key,
            row_level=lake.row_level,
            buckets=lake.buckets,
            **rule,
        )

    put(gold.dim_company(rows), "dim_company", "company_id", set_null=True)
    put(gold.dim_location(rows), "dim_location", "location_id", set_null=True)
    put(gold.dim_job_category(rows), "dim_job_category", "job_category_id", set_null=True)
    put(gold.dim_skill(rows), "dim_skill", "skill_id", set_null=True)
    put(gold.dim_level(rows), "dim_level", "level_id", set_null=True)
    facts = gold.fact_job_postings(rows)
    if lake.title_index and not lake.row_level:
        upsert_indexed(facts, lake.table("gold", "fact_job_postings"), "job_id", lake.titles(), parts=lake.buckets)
    else:
        put(facts, "fact_job_postings", "job_id", partition_ts="ingested_at")
    links = gold.bridge_job_skills(rows, one_row_per_job=True)
    sinks.append_new(
        links,
        lake.table("gold", "bridge_job_skills"),
        "bridge_id",
        by="job_id",
        buckets=lake.buckets,
        row_level=lake.row_level,
    )
    return True


def run_day(
    spark: SparkSession,
    lake: Lake,
    day: dt.date,
    sources: Iterable[Source] = tuple(SOURCES.values()),
    ingested_at: Column | None = None,
) -> list[dict[str, object]]:
    """All sources through bronze and silver, then gold once."""
    metrics = []
    for source in sources:
        landed = run_bronze(spark, lake, source, day, ingested_at)
        if spark.catalog.tableExists(lake.table("bronze", source.table)):
            metrics.append(run_silver(spark, lake, source, day))
            if landed["valid"] and not metrics[-1]["bronze_count"]:
                log.error("%s: %s rows landed, none of them on %s", source.name, landed["valid"], day)
    run_gold(spark, lake, day)
    return metrics
