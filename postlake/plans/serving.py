"""Questions asked of the star schema (SRV-1 to SRV-4, SRT-1 to SRT-3, FMT-1)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions import terms
from postlake.functions.salary import salary_text
from postlake.operators import aggregate, ranking
from postlake.operators.filters import title_like
from postlake.operators.lookup import star_lookup
from postlake.session import stored
from postlake.sinks.title_index import TitleIndex

# --- Fixed values: columns of a search hit -----------------------------------------
HIT = (
    "job_title", "company_name", "salary_min", "salary_max", "salary_currency", "job_url",
    "location_name", "deadline_date", "inserted_at", "level_name",
)


MOST_HITS = 10_000
"""A search is a list for a reader; its keys are broadcast, so it has a bound."""


@dataclass(frozen=True)
class Star:
    """The seven gold tables."""

    dim_company: DataFrame
    dim_location: DataFrame
    dim_job_category: DataFrame
    dim_skill: DataFrame
    dim_level: DataFrame
    fact_job_postings: DataFrame
    bridge_job_skills: DataFrame

    @classmethod
    def from_catalog(cls, spark: SparkSession, namespace: str = "gold") -> Star:
        return cls(**{name: spark.table(f"{namespace}.{name}") for name in cls.__dataclass_fields__})


def _hits(star: Star, keyword: str, limit: int, facts: DataFrame | None = None) -> DataFrame:
    """The newest matching postings, then their names; ``facts``: where to look, if not
    among all.

    The lookups keep every row, so the limit is taken before them, and the hits
    are stored: they run on ``limit`` rows instead of all matches.
    """
    if limit > MOST_HITS:
        raise ValueError(f"a search lists at most {MOST_HITS} hits")
    facts = star.fact_job_postings if facts is None else facts
    newest = ranking.latest_first(facts, ["job_id"])
    found = facts.filter(title_like(keyword)).orderBy(*newest).limit(limit)
    return star_lookup(
        stored(found, "hits"),
        [
            (star.dim_company, "company_id", ["company_name"]),
            (star.dim_location, "location_id", ["location_name"]),
            (star.dim_level, "level_id", ["level_name"]),
        ],
        few=True,
    )


def search(star: Star, keyword: str, limit: int = 100) -> DataFrame:
    """SRV-1: newest first, ties by ``job_id``."""
    hits = _hits(star, keyword, limit)
    return hits.orderBy(*ranking.latest_first(hits, ["job_id"])).select(*HIT)


def search_indexed(
    star: Star, index: TitleIndex, parts: int, keyword: str, limit: int = 100
) -> DataFrame:
    """SRV-1 by the index of titles, where ``star`` holds a keyed fact table of ``parts`` parts."""
    if limit > MOST_HITS:
        raise ValueError(f"a search lists at most {MOST_HITS} hits")
    facts = index.narrowed(star.fact_job_postings, parts, keyword, limit)
    hits = _hits(star, keyword, limit, facts)
    return hits.orderBy(*ranking.latest_first(hits, ["job_id"])).select(*HIT)


def search_pages(star: Star, keyword: str, limit: int = 100, size: int = 5) -> DataFrame:
    """SRT-2 and FMT-1: a search as shown to a reader, page by page."""
    hits = _hits(star, keyword, limit)
    paged = ranking.paged(hits, ranking.latest_first(hits, ["job_id"]), size)
    return paged.select(
        "job_id",
        "page",
        "pages",
        _shown("job_title", terms.NO_TITLE),
        _shown("company_name", terms.NO_COMPANY),
        salary_text(F.col("salary_min"), F.col("salary_max"), F.col("salary_currency")).alias(
            "salary_text"
        ),
        _shown("location_name", terms.NO_PLACE),
        _shown("job_url", terms.NO_URL),
        _shown("level_name", terms.NO_LEVEL),
        F.coalesce(F.col("deadline_date").cast("string"), F.lit(terms.NO_DATE)).alias("deadline"),
        F.substring(F.coalesce(_stated("inserted_at"), F.lit(terms.NO_DATE)), 1, 10).alias("posted"),
    )


def _stated(name: str):
    return F.when(F.col(name) != "", F.col(name))


def _shown(name: str, missing: str):
    return F.coalesce(_stated(name), F.lit(missing)).alias(name)


def every_page(star: Star, keyword: str, size: int = 5) -> DataFrame:
    """SRT-2 without a limit: the page of each posting that matches, newest first."""
    facts = star.fact_job_postings
    found = facts.filter(title_like(keyword)).select("job_id", "job_title", "ingested_at")
    return ranking.all_paged(found, ranking.latest_first(found, ["job_id"]), size).select("job_id", "page", "pages")


SEARCH_SQL = """
SELECT f.job_title, c.company_name, f.salary_min, f.salary_max, f.salary_currency, f.job_url,
       l.location_name, f.deadline_date, f.inserted_at, v.level_name
FROM (SELECT * FROM {fact} WHERE lower(job_title) LIKE concat('%', lower(:keyword), '%')
      ORDER BY ingested_at DESC, job_id DESC LIMIT :hits) f
LEFT JOIN {company} c ON f.company_id = c.company_id
LEFT JOIN {location} l ON f.location_id = l.location_id
LEFT JOIN {level} v ON f.level_id = v.level_id
ORDER BY f.ingested_at DESC, f.job_id DESC
"""


def search_bound(spark: SparkSession, star: Star, keyword: str, limit: int = 100) -> DataFrame:
    """SRV-1 as SQL with bind parameters: whatever the keyword holds, it is a value and no SQL."""
    tables = {
        "fact": star.fact_job_postings, "company": star.dim_company,
        "location": star.dim_location, "level": star.dim_level,
    }
    return spark.sql(SEARCH_SQL, args={"keyword": keyword, "hits": limit}, **tables)


def stats_rolled_up(star: Star) -> DataFrame:
    """DQ-7: postings per source, place and salary band, with subtotals.

    Counted by key before the place is looked up and before the groups are multiplied."""
    keys = ["source", "location_id", "salary_band"]
    counts = star.fact_job_postings.groupBy(*keys).agg(F.count(F.lit(1)).alias("postings"))
    named = counts.join(star.dim_location.select("location_id", "location_name"), "location_id", "left")
    return aggregate.rolled_up(named, ["source", "location_name", "salary_band"], "postings")


def stats(star: Star, name: str = "count") -> DataFrame:
    """SRV-2, DQ-7: postings per source."""
    return aggregate.count_by(star.fact_job_postings, "source", name)


def stats_with_total(star: Star) -> DataFrame:
    """AGG-6."""
    counts = star.fact_job_postings.groupBy("source").agg(F.count(F.lit(1)).alias("count"))
    return aggregate.with_grand_total(counts, "count").orderBy(F.col("count").desc(), "source")


def top_skills(star: Star, limit: int = 10, name: str = "demand") -> DataFrame:
    """SRV-3, DQ-8."""
    counts = aggregate.count_by_name(
        star.bridge_job_skills, star.dim_skill, "skill_id", "job_id", "skill_name", name
    )
    return aggregate.top(counts, name, "skill_name", limit)


def top_locations(star: Star, limit: int = 5, name: str = "job_count") -> DataFrame:
    """SRV-4, DQ-8."""
    counts = aggregate.count_by_name(
        star.fact_job_postings, star.dim_location, "location_id", "job_id", "location_name", name
    )
    return aggregate.top(counts, name, "location_name", limit)


def top_skills_ranked(star: Star, limit: int = 10) -> DataFrame:
    """SRT-3."""
    listed = top_skills(star, limit)
    return ranking.numbered(listed, [F.col("demand").desc(), F.col("skill_name")])
