"""SQL counterparts of the registered queries, for another engine to run.

Written from the semantics, not from the Spark expressions: nested CASE where
Spark uses a flat one, one boundary regex per word, window functions and
plain joins where Spark pre-aggregates.
"""

from __future__ import annotations

from collections.abc import Iterable

from postlake.fixtures import RAW_POSTINGS
from postlake.functions import terms


def _lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _any(text: str, parts: Iterable[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, {_lit(p)})" for p in parts) + ")"


def _starts(text: str, parts: Iterable[str]) -> str:
    return "(" + " OR ".join(f"starts_with({text}, {_lit(p)})" for p in parts) + ")"


def _wrap(conditions: Iterable[tuple[str, str]]) -> str:
    """Nested CASE: every further condition overrules those before it."""
    case = "CAST(NULL AS VARCHAR)"
    for condition, label in conditions:
        case = f"CASE WHEN {condition} THEN {_lit(label)} ELSE {case} END"
    return case


def _word(text: str, keyword: str) -> str:
    escaped = "".join("\\" + c if c in ".+" else c for c in keyword)
    return f"regexp_matches({text}, {_lit(chr(92) + 'b' + escaped + chr(92) + 'b')})"


def _distinct(items: str) -> str:
    """Distinct in order of first appearance."""
    return f"list_filter({items}, lambda x, i: list_position({items}, x) = i)"


RAW = RAW_POSTINGS.format(orders="orders", customer="customer")

# --- standardizers ------------------------------------------------------------------

_SALARY = "lower(trim(salary))"
_STATED = f"({_SALARY} IS NOT NULL AND NOT {_any(_SALARY, terms.NEGOTIABLE_PHRASES)})"
_USD = _any(_SALARY, ("usd", "$"))


def _number(pattern: str) -> str:
    digits = f"regexp_extract({_SALARY}, {_lit(pattern)}, 1)"
    return (
        f"TRY_CAST(CASE WHEN {_USD} THEN regexp_replace({digits}, '[,.]', '', 'g') "
        f"ELSE replace({digits}, ',', '.') END AS DOUBLE)"
    )


_FIRST = _number(terms.FIRST_AMOUNT)
_SECOND = _number(terms.SECOND_AMOUNT)
_TO = _starts(_SALARY, terms.TO_PREFIXES)
_FROM = _starts(_SALARY, terms.FROM_PREFIXES)

_PLACE = "lower(trim(place))"
_PLACES = sorted(
    ((w, name) for name, words in terms.PLACES.items() for w in words),
    key=lambda pair: len(pair[0]),
    reverse=True,
)
_LEVEL = "lower(trim(level))"
_EXP = "lower(trim(experience))"
_YEARS = f"CAST(TRY_CAST(regexp_extract({_EXP}, '([0-9]+)', 1) AS INTEGER) AS VARCHAR) || ' years'"
_TYPE = "lower(trim(working_type))"
_SIZE = r"regexp_replace(trim(scale), '[.,\n\r]', '', 'g')"
_TITLE = "lower(job_title)"

_SPLIT = "list_filter(list_transform(string_split({0}, ','), lambda x: trim(x)), lambda x: x <> '')"
_SKILLS = (
    "CASE WHEN skills IS NOT NULL AND trim(skills) <> '' "
    f"THEN {_SPLIT.format('skills')} ELSE CAST([] AS VARCHAR[]) END"
)
_TITLE_SKILLS = (
    "list_filter(["
    + ", ".join(
        f"CASE WHEN {_word(_TITLE, w)} THEN {_lit(n)} END" for w, n in terms.TITLE_SKILLS.items()
    )
    + "], lambda x: x IS NOT NULL)"
)

STD = f"""
SELECT *,
  CASE WHEN salary_min_tr IS NULL AND salary_max_tr IS NULL THEN 'Negotiable'
       WHEN mean_tr < 10 THEN '< 10tr' WHEN mean_tr <= 20 THEN '10tr - 20tr'
       WHEN mean_tr <= 30 THEN '20tr - 30tr' ELSE '> 30tr' END AS salary_band
FROM (SELECT *, CASE WHEN salary_min_tr IS NOT NULL AND salary_max_tr IS NOT NULL
    THEN (salary_min_tr + salary_max_tr) / 2 ELSE coalesce(salary_min_tr, salary_max_tr) END AS mean_tr
FROM (SELECT *,
    CASE WHEN salary_currency = 'USD' THEN salary_min * 0.025 WHEN salary_min > 1000
         THEN salary_min / 1000000 ELSE salary_min END AS salary_min_tr,
    CASE WHEN salary_currency = 'USD' THEN salary_max * 0.025 WHEN salary_max > 1000
         THEN salary_max / 1000000 ELSE salary_max END AS salary_max_tr
FROM (SELECT raw.*,
  md5(concat_ws('||', source, job_url)) AS job_id,
  md5(lower(trim(company_name))) AS company_id,
  salary AS salary_raw,
  CASE WHEN NOT {_STATED} OR {_TO} THEN NULL ELSE {_FIRST} END AS salary_min,
  CASE WHEN NOT {_STATED} THEN NULL WHEN {_FROM} AND {_SECOND} IS NULL THEN NULL
       WHEN {_SECOND} IS NOT NULL THEN {_SECOND} WHEN {_TO} THEN {_FIRST} END AS salary_max,
  CASE WHEN NOT {_STATED} THEN NULL WHEN {_USD} THEN 'USD' ELSE 'tr VND' END AS salary_currency,
  CAST(ingested_at AS DATE) + TRY_CAST(regexp_extract(deadline, '([0-9]+)', 1) AS INTEGER) AS deadline_date,
  coalesce({_wrap((f"contains({_PLACE}, {_lit(w)})", n) for w, n in _PLACES)}, trim(place)) AS location,
  CASE WHEN {_any(_EXP, terms.EXPERIENCE_NOT_REQUIRED)} THEN 'Not required'
       WHEN {_any(_EXP, terms.EXPERIENCE_UNDER)} THEN '< ' || {_YEARS}
       WHEN {_any(_EXP, terms.EXPERIENCE_OVER)} THEN '> ' || {_YEARS}
       ELSE {_YEARS} END AS experience_req,
  coalesce({_wrap((f"contains({_LEVEL}, {_lit(w)})", n) for n, ws in terms.LEVELS.items() for w in ws)},
           trim(level)) AS level_processed,
  CASE WHEN {_any(_TYPE, ("hybrid", "kết hợp"))} THEN 'Hybrid'
       WHEN {_any(_TYPE, ("remote", "từ xa"))} THEN 'Remote'
       WHEN {_any(_TYPE, ("onsite", "office", "văn phòng", "at office"))} THEN 'Onsite'
       ELSE trim(working_type) END AS working_type_std,
  {_SKILLS} AS skills_given,
  {_distinct(f"list_concat({_SKILLS}, {_TITLE_SKILLS})")} AS skills_array,
  coalesce({_wrap(("(" + " OR ".join(_word(_TITLE, w) for w in ws) + ")", n) for n, ws in terms.JOB_CATEGORIES.items())},
           'Others') AS job_category,
  CASE WHEN scale IS NULL OR NOT regexp_matches({_SIZE}, '[0-9]') THEN NULL
       WHEN regexp_extract({_SIZE}, '([0-9]+[+])', 1) <> '' THEN regexp_extract({_SIZE}, '([0-9]+[+])', 1)
       WHEN regexp_extract({_SIZE}, '([0-9]+\\s*[-–]\\s*[0-9]+)', 1) <> ''
       THEN regexp_replace(regexp_extract({_SIZE}, '([0-9]+\\s*[-–]\\s*[0-9]+)', 1), '\\s*[-–]\\s*', '-')
       ELSE trim(scale) END AS company_size_std,
  (job_url IS NOT NULL AND trim(job_url) <> '' AND job_title IS NOT NULL AND trim(job_title) <> ''
   AND company_name IS NOT NULL AND trim(company_name) <> '' AND trim(source) <> '') AS complete
FROM raw)))
"""

_NEWEST = "row_number() OVER (PARTITION BY job_id ORDER BY ingested_at DESC, posting_key DESC)"

_SILVER_COLUMNS = """job_id, source, job_url, job_title, job_category, company_id, company_name,
  CAST(NULL AS VARCHAR) AS company_link, CAST(NULL AS VARCHAR) AS company_address,
  company_industry, location, company_size_std, experience_req, level_processed,
  CAST(NULL AS VARCHAR) AS education, working_type_std, CAST(NULL AS VARCHAR) AS working_day,
  CAST(NULL AS VARCHAR) AS working_hour, skills_array, salary_raw, salary_min, salary_max,
  salary_currency, salary_band, deadline_date, CAST(NULL AS VARCHAR) AS inserted_at, ingested_at"""

_FACT_COLUMNS = """job_id, source, job_url, job_title, company_id, md5(location) AS location_id,
  md5(job_category) AS job_category_id, md5(level_processed) AS level_id, experience_req,
  education, working_type_std, working_day, working_hour, salary_min, salary_max,
  salary_currency, salary_band, deadline_date, inserted_at, ingested_at"""


def _dim(table: str, column: str, stem: str) -> str:
    return (
        f"SELECT DISTINCT {column} AS {stem}_name, md5({column}) AS {stem}_id "
        f"FROM {table} WHERE {column} IS NOT NULL"
    )


def _companies(table: str) -> str:
    return f"""SELECT company_id, company_name, company_industry, company_size_std, company_address,
  company_link FROM (SELECT *, row_number() OVER (PARTITION BY company_id
    ORDER BY ingested_at DESC, job_id DESC) AS rn FROM {table} WHERE company_id IS NOT NULL) WHERE rn = 1"""


def _links(table: str) -> str:
    return f"""SELECT *, md5(job_id || skill_id) AS bridge_id FROM (
  SELECT DISTINCT job_id, md5(skill_name) AS skill_id FROM (
    SELECT job_id, unnest(skills_array) AS skill_name FROM {table})
  WHERE skill_name IS NOT NULL AND trim(skill_name) <> '')"""


# Named intermediate results; each may use those before it.
_CTES = {
    "raw": RAW,
    "std": STD,
    "silver": f"""SELECT {_SILVER_COLUMNS} FROM (
        SELECT *, {_NEWEST} AS rn FROM std WHERE complete) WHERE rn = 1""",
    "every": f"SELECT {_SILVER_COLUMNS} FROM std",
    "update_batch": f"""SELECT * REPLACE (
          CASE WHEN source = 'site_a' THEN 'Moved' ELSE job_category END AS job_category,
          CASE WHEN source <> 'site_c' THEN company_industry END AS company_industry,
          ingested_at + INTERVAL 1 DAY AS ingested_at)
        FROM (SELECT {_SILVER_COLUMNS} FROM (SELECT *, {_NEWEST} AS rn FROM std) WHERE rn = 1)""",
    "dim_company": _companies("silver"),
    "dim_location": _dim("silver", "location", "location"),
    "dim_job_category": _dim("silver", "job_category", "job_category"),
    "dim_skill": """SELECT DISTINCT skill_name, md5(skill_name) AS skill_id FROM (
        SELECT unnest(skills_array) AS skill_name FROM silver) WHERE trim(skill_name) <> ''""",
    "dim_level": _dim("silver", "level_processed", "level"),
    "fact": f"SELECT {_FACT_COLUMNS} FROM silver",
    "bridge": _links("silver"),
    "every_fact": f"SELECT {_FACT_COLUMNS} FROM every",
    "every_bridge": _links("every"),
}


def _with(query: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in _CTES.items()) + "\n" + query


_AS_TEXT = "SELECT * REPLACE (array_to_string(skills_array, '|') AS skills_array)"


def _upserted(target: str, source: str, key: str, columns: Iterable[tuple[str, str]]) -> str:
    """Full outer join; ``columns`` gives the matched value of each column."""
    merged = ", ".join(
        f"CASE WHEN t.{key} IS NULL THEN s.{c} WHEN s.{key} IS NULL THEN t.{c} ELSE {value} END AS {c}"
        for c, value in columns
    )
    return (
        f"SELECT coalesce(t.{key}, s.{key}) AS {key}, {merged} "
        f"FROM {target} t FULL JOIN {source} s ON t.{key} = s.{key}"
    )


_GUARD = (
    "job_title", "job_category", "company_name", "location", "salary_raw",
    "deadline_date", "experience_req", "level_processed", "working_type_std",
)
_CHANGED = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in _GUARD)
_SILVER_UPDATED = (
    "job_url", "job_title", "job_category", "company_id", "company_name", "company_link",
    "company_address", "company_industry", "location", "company_size_std", "experience_req",
    "level_processed", "education", "working_type_std", "working_day", "working_hour",
    "skills_array", "salary_raw", "salary_min", "salary_max", "salary_currency", "salary_band",
    "deadline_date", "inserted_at",
)
_COMPANY = (
    "company_name", "company_industry", "company_size_std", "company_address", "company_link",
)
_FACT = (
    "source", "job_url", "job_title", "company_id", "location_id", "job_category_id", "level_id",
    "experience_req", "education", "working_type_std", "working_day", "working_hour", "salary_min",
    "salary_max", "salary_currency", "salary_band", "deadline_date", "inserted_at", "ingested_at",
)

_SEARCH = """SELECT f.*, c.company_name, l.location_name, v.level_name
  FROM fact f LEFT JOIN dim_company c ON f.company_id = c.company_id
  LEFT JOIN dim_location l ON f.location_id = l.location_id
  LEFT JOIN dim_level v ON f.level_id = v.level_id
  WHERE lower(f.job_title) LIKE '%data%' ORDER BY f.ingested_at DESC, f.job_id DESC LIMIT 100"""


def _salary_text() -> str:
    low, high = (f"format('{{:,.0f}}', salary_{side})" for side in ("min", "max"))
    return (
        "CASE WHEN salary_min <> 0 AND salary_max <> 0 "
        f"THEN {low} || ' - ' || {high} || ' ' || salary_currency "
        f"WHEN salary_min <> 0 THEN 'Từ ' || {low} || ' ' || salary_currency "
        f"WHEN salary_max <> 0 THEN 'Lên đến ' || {high} || ' ' || salary_currency "
        "ELSE 'Thỏa thuận' END"
    )


_SKILL_COUNTS = """SELECT s.skill_name, count(b.job_id) AS demand FROM bridge b
  JOIN dim_skill s ON b.skill_id = s.skill_id GROUP BY s.skill_name
  ORDER BY demand DESC, s.skill_name LIMIT 10"""


def _orphans(child: str, parent: str, key: str, name: str, null_tolerant: bool = True) -> str:
    tolerant = f" AND f.{key} IS NOT NULL" if null_tolerant else ""
    return (
        f"SELECT count(*) AS {name} FROM {child} f LEFT JOIN {parent} d ON f.{key} = d.{key} "
        f"WHERE d.{key} IS NULL{tolerant}"
    )


def _std(*columns: str) -> str:
    return f"SELECT posting_key, {', '.join(columns)} FROM std"


_FROM_STAR = {
    "snk_dlq_rows": f"{_AS_TEXT}, 'Missing mandatory fields' AS error_reason "
    f"FROM (SELECT {_SILVER_COLUMNS} FROM std WHERE NOT complete)",
    "snk_landing_roundtrip": """SELECT CAST(posting_key AS VARCHAR) AS posting_key, job_title,
        salary, place, array_to_string(string_split(skills, ','), '|') AS skills, job_url FROM raw""",
    "snk_retention": """SELECT posting_key, ingested_at FROM raw
        WHERE ingested_at >= TIMESTAMP '1998-08-02' - INTERVAL 30 DAY""",
    "flt_required_split": "SELECT posting_key, complete FROM std",
    "prj_conform_union": "SELECT posting_key, source, company_name, company_industry, scale FROM raw",
    "set_union_by_name": """SELECT posting_key, salary, NULL::VARCHAR AS level FROM raw
        WHERE source IN ('site_a', 'site_b') UNION ALL
        SELECT posting_key, NULL, level FROM raw WHERE source IN ('site_c', 'site_d')""",
    "std_salary": _std("salary_raw", "salary_min", "salary_max", "salary_currency"),
    "std_salary_band": _std("salary_band"),
    "std_deadline": _std("deadline_date"),
    "std_location": _std("location"),
    "std_experience": _std("experience_req"),
    "std_level": _std("level_processed"),
    "std_working_type": _std("working_type_std"),
    "std_skills_split": f"""SELECT posting_key, array_to_string({_SKILLS}, '|') AS from_text,
        array_to_string({_SPLIT.format("skills")}, '|') AS from_array FROM raw""",
    "std_skills_enrich": """SELECT posting_key, array_to_string(skills_array, '|') AS skills_array
        FROM std""",
    "std_job_category": _std("job_category"),
    "std_company_size": _std("company_size_std"),
    "std_job_id": _std("job_id"),
    "std_company_id": _std("company_id"),
    "dst_latest_per_key": f"""SELECT job_id, posting_key FROM (SELECT *, {_NEWEST} AS rn FROM std)
        WHERE rn = 1""",
    "srt_cap_per_source": """SELECT source, posting_key, ingested_at FROM (SELECT *, row_number() OVER (
        PARTITION BY source ORDER BY ingested_at DESC, posting_key DESC) AS rn FROM raw) WHERE rn <= 200""",
    "silver_postings": f"{_AS_TEXT} FROM silver",
    "silver_postings_dedup_first": f"""{_AS_TEXT} FROM (SELECT {_SILVER_COLUMNS} FROM (
        SELECT *, {_NEWEST} AS rn FROM std) WHERE rn = 1 AND complete)""",
    "gold_dim_company": "SELECT * FROM dim_company",
    "gold_dim_location": "SELECT * FROM dim_location",
    "gold_dim_job_category": "SELECT * FROM dim_job_category",
    "gold_dim_skill": "SELECT * FROM dim_skill",
    "gold_dim_level": "SELECT * FROM dim_level",
    "gold_fact": "SELECT * FROM fact",
    "gold_bridge": "SELECT * FROM bridge",
    "gold_bridge_distinct": "SELECT * FROM bridge",
    "ups_guarded": f"{_AS_TEXT} FROM ("
    + _upserted(
        "silver",
        "update_batch",
        "job_id",
        [("source", "t.source"), ("ingested_at", "t.ingested_at")]
        + [
            (c, f"CASE WHEN {_CHANGED} THEN coalesce(s.{c}, t.{c}) ELSE t.{c} END")
            for c in _SILVER_UPDATED
        ],
    )
    + ")",
    "ups_scd1": _upserted(
        "dim_company", f"({_companies('update_batch')})", "company_id", [(c, f"s.{c}") for c in _COMPANY]
    ),
    "ups_fact": _upserted(
        "fact",
        f"(SELECT {_FACT_COLUMNS} FROM update_batch)",
        "job_id",
        [(c, f"coalesce(s.{c}, t.{c})") for c in _FACT],
    ),
    "ups_insert_only": f"""SELECT * FROM bridge UNION ALL SELECT * FROM ({_links("update_batch")}) s
        WHERE NOT EXISTS (SELECT 1 FROM bridge t WHERE t.bridge_id = s.bridge_id)""",
    "srv_search": f"""SELECT job_title, company_name, salary_min, salary_max, salary_currency, job_url,
        location_name, deadline_date, inserted_at, level_name FROM ({_SEARCH})""",
    "srv_search_page": f"""SELECT job_id, CAST(ceil(rn / 5.0) AS INTEGER) AS page,
        CAST(ceil(n / 5.0) AS INTEGER) AS pages, coalesce(nullif(job_title, ''), 'Không rõ') AS job_title,
        coalesce(nullif(company_name, ''), 'Không rõ công ty') AS company_name,
        {_salary_text()} AS salary_text, coalesce(nullif(location_name, ''), 'Nhiều nơi') AS location_name,
        coalesce(nullif(job_url, ''), '#') AS job_url,
        coalesce(nullif(level_name, ''), 'Không yêu cầu') AS level_name,
        coalesce(CAST(deadline_date AS VARCHAR), 'Chưa rõ') AS deadline,
        substring(coalesce(nullif(inserted_at, ''), 'Chưa rõ'), 1, 10) AS posted
        FROM (SELECT *, row_number() OVER (ORDER BY ingested_at DESC, job_id DESC) AS rn,
        count(*) OVER () AS n FROM ({_SEARCH}))""",
    "srv_salary_text": f"SELECT job_id, {_salary_text()} AS salary_text FROM fact",
    "srv_stats_by_source": "SELECT source, count(*) AS count FROM fact GROUP BY source",
    "srv_stats_with_total": """SELECT source, count(*) AS count,
        CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM fact GROUP BY source""",
    "srv_top_skills": _SKILL_COUNTS,
    "srv_top_skills_ranked": f"""SELECT *, CAST(row_number() OVER (ORDER BY demand DESC, skill_name)
        AS INTEGER) AS rank FROM ({_SKILL_COUNTS})""",
    "srv_top_locations": """SELECT l.location_name, count(f.job_id) AS job_count FROM fact f
        JOIN dim_location l ON f.location_id = l.location_id GROUP BY l.location_name
        ORDER BY job_count DESC, l.location_name LIMIT 5""",
    "dq_completeness": """SELECT count(*) AS total_rows,
        CAST(sum(CASE WHEN job_title IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_titles,
        CAST(sum(CASE WHEN company_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_companies,
        CAST(sum(CASE WHEN location_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_locations,
        CAST(sum(CASE WHEN source IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_sources
        FROM every_fact""",
    "dq_dup_job_id": """SELECT job_id, count(*) AS duplicate_count FROM every_fact GROUP BY job_id
        HAVING count(*) > 1""",
    "dq_dup_company_id": """SELECT company_id, count(*) AS duplicate_count FROM every_fact
        GROUP BY company_id HAVING count(*) > 1""",
    "dq_dup_dim_keys": " UNION ALL ".join(
        f"SELECT '{key}' AS key, {key} AS id, count(*) AS duplicate_count FROM {dim} "
        f"GROUP BY {key} HAVING count(*) > 1"
        for key, dim in (
            ("company_id", "dim_company"),
            ("location_id", "dim_location"),
            ("skill_id", "dim_skill"),
        )
    ),
    "dq_orphans_company": _orphans("every_fact", "dim_company", "company_id", "orphaned_companies"),
    "dq_orphans_location": _orphans("every_fact", "dim_location", "location_id", "orphaned_locations"),
    "dq_orphans_category": _orphans(
        "every_fact", "dim_job_category", "job_category_id", "orphaned_categories"
    ),
    "dq_orphans_level": _orphans("every_fact", "dim_level", "level_id", "orphaned_levels"),
    "dq_bridge_orphan_jobs": _orphans("every_bridge", "fact", "job_id", "invalid_bridge_jobs", False),
    "dq_bridge_orphan_skills": _orphans(
        "every_bridge", "dim_skill", "skill_id", "invalid_bridge_skills", False
    ),
    "dq_orphans_parts": " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, {name} AS n FROM ("
        + _orphans(child, f"(SELECT * FROM {dim} WHERE {key} < '4')", key, name, skip_nulls)
        + ")"
        for child, dim, key, name, skip_nulls in (
            ("every_fact", "dim_company", "company_id", "orphaned_companies", True),
            ("every_fact", "dim_location", "location_id", "orphaned_locations", True),
            ("every_fact", "dim_job_category", "job_category_id", "orphaned_categories", True),
            ("every_fact", "dim_level", "level_id", "orphaned_levels", True),
            ("every_bridge", "dim_skill", "skill_id", "invalid_bridge_skills", False),
        )
    ),
    "run_day_counts": """SELECT 'bronze' AS name, count(*) AS n FROM std UNION ALL
        SELECT 'silver', count(*) FROM silver UNION ALL
        SELECT 'rejects', count(*) FROM std WHERE NOT complete UNION ALL
        SELECT 'facts', count(*) FROM silver""",
    "dq_salary_inverted": """SELECT job_id, salary_min, salary_max FROM every_fact
        WHERE salary_min > salary_max""",
    "dq_salary_negative": """SELECT job_id, salary_min, salary_max FROM every_fact
        WHERE salary_min < 0 OR salary_max < 0""",
    "dq_batch_metrics": """SELECT bronze_count, silver_count, bronze_count - silver_count AS dropped_count,
        rejected_count, bronze_count - silver_count - rejected_count AS repeat_count,
        round(1 - silver_count / greatest(bronze_count, 1), 4) AS drop_rate
        FROM (SELECT count(*) AS bronze_count, (SELECT count(*) FROM silver) AS silver_count,
        count(*) FILTER (WHERE NOT complete) AS rejected_count FROM std)""",
}

def _heading() -> str:
    """Text of the first h1: tags removed, entities resolved, "&amp;" last."""
    text = "regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '<[^>]*>', '', 'g')"
    for entity, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{entity};?', '{char}', 'g')"
    return f"trim({text})"


_FROM_TABLES = {
    "src_json_permissive": """SELECT event_id,
        CASE WHEN json_valid(t) THEN CAST(json_extract(t, '$.k') AS INTEGER) END AS k,
        CASE WHEN NOT json_valid(t) THEN t END AS _corrupt_record
        FROM (SELECT event_id, CASE WHEN event_type = 'error'
            THEN substring(props, 1, length(props) - 1) ELSE props END AS t FROM events)""",
    "snk_quarantine": """SELECT t AS _corrupt_record
        FROM (SELECT CASE WHEN event_type = 'error'
            THEN substring(props, 1, length(props) - 1) ELSE props END AS t FROM events)
        WHERE NOT json_valid(t)""",
    "snk_append": "SELECT *, CAST(ts AS DATE) AS ingest_date FROM events",
    "flt_day_slice": """SELECT * FROM events
        WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'""",
    "dq_salary_inverted_amounts": """SELECT * FROM (SELECT l_orderkey || '-' || l_linenumber AS job_id,
        l_quantity AS salary_min, l_extendedprice / 1000 AS salary_max FROM lineitem)
        WHERE salary_min > salary_max""",
    "dq_salary_negative_amounts": """SELECT * FROM (SELECT CAST(c_custkey AS VARCHAR) AS job_id,
        c_acctbal AS salary_min, c_acctbal + 100 AS salary_max FROM customer)
        WHERE salary_min < 0 OR salary_max < 0""",
    "web_links": """SELECT DISTINCT page_id,
        CASE WHEN href LIKE '/%' THEN 'https://jobs.example' || href ELSE href END AS link
        FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a[^>]* href="([^"]*)"', 1)) AS href
              FROM pages) WHERE contains(href, '/')""",
    "web_title": f"""SELECT * FROM (SELECT page_id, CASE WHEN contains(html, '<h1>') THEN {_heading()}
        END AS job_title FROM pages) WHERE job_title IS NOT NULL AND job_title <> ''""",
    "web_list_items": r"""SELECT page_id, array_to_string(list_filter(list_transform(
        regexp_extract_all(html, '<li>(.*?)</li>', 1),
        lambda x: trim(replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&amp;', '&'))),
        lambda x: x <> ''), '|') AS items FROM pages""",
    "web_label_values": """SELECT page_id,
        list_filter(regexp_extract_all(html, '\\blang="([^"]*)"', 1), lambda x: true)[-1] AS lang,
        regexp_extract_all(html, '\\bcharset="([^"]*)"', 1)[-1] AS charset,
        regexp_extract_all(html, '\\bclass="([^"]*)"', 1)[-1] AS last_class,
        regexp_extract_all(html, '\\bhref="([^"]*)"', 1)[-1] AS last_href FROM pages""".replace(
        "\\\\b", "\\b"
    ),
}

_ENTRY = "replace(unnest(regexp_extract_all(html, '<li><a href=\"[^\"]*\">([^<]*)</a>', 1)), '&amp;', '&')"
_FROM_TABLES["web_child_links"] = """SELECT page_id, 'https://jobs.example' || href AS link
    FROM (SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)"', 1)) AS href FROM pages)
    WHERE page_id % 2 = 0 AND NOT starts_with(href, '/a')"""
_FROM_TABLES["web_whole_items"] = f"""SELECT page_id,
    CASE WHEN count(word) = 0 THEN 'Before  after' ELSE 'Before ' || string_agg('See this ' || word, '' ORDER BY seat)
      || ' after|' || string_agg('See this ' || word, '|' ORDER BY seat) END AS items
    FROM (SELECT page_id, {_ENTRY} AS word,
          generate_subscripts(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1), 1) AS seat FROM pages)
    GROUP BY page_id"""
_FROM_STAR["web_grouped_values"] = """SELECT posting_key,
    trim(CASE WHEN level IS NULL THEN company_industry ELSE level END) AS level, trim(scale) AS scale,
    trim(place) AS place, CAST(NULL AS VARCHAR) AS "none" FROM raw"""

_FROM_STAR["run_day_and_stream"] = """SELECT job_title, company_name, place, salary, job_url,
    CASE WHEN posting_key % 2 = 0 THEN 'files' ELSE 'day' END AS brought_by FROM raw"""
_FROM_STAR["snk_split_write"] = "SELECT complete, source, count(*) AS n FROM std GROUP BY complete, source"

_DATED = "(SELECT *, DATE '{day}' AS changed_on FROM {table})"
_FROM_STAR["src_changed_day"] = _upserted(
    _DATED.format(day="2024-01-15", table="silver"),
    _DATED.format(day="2024-01-16", table="update_batch"),
    "job_id",
    [
        (c, f"CASE WHEN {_CHANGED} THEN coalesce(s.{c}, t.{c}) ELSE t.{c} END")
        for c in ("job_category", "company_industry", "changed_on")
    ],
)

_FROM_STAR["srv_stats_rolled_up"] = """SELECT source, location_name, salary_band, count(*) AS postings,
    GROUPING_ID(source, location_name, salary_band) AS level
    FROM fact f LEFT JOIN dim_location l ON f.location_id = l.location_id
    GROUP BY ROLLUP (source, location_name, salary_band)"""
_FROM_STAR["srv_every_page"] = """SELECT job_id, CAST(ceil(row_number() OVER (ORDER BY ingested_at DESC, job_id DESC) / 5.0)
    AS INTEGER) AS page, CAST(ceil(count(*) OVER () / 5.0) AS INTEGER) AS pages
    FROM fact WHERE lower(job_title) LIKE '%data%'"""
_FROM_STAR["srv_search_bound"] = _FROM_STAR["srv_search"]
_FROM_STAR["srv_search_indexed"] = _FROM_STAR["srv_search"]
_FROM_STAR["srv_search_indexed_wildcard"] = _FROM_STAR["srv_search"].replace("'%data%'", "'%d_ta%eng%'")
_FROM_STAR["dq_dup_dim_rows"] = " UNION ALL ".join(
    f"SELECT '{key}' AS key, {key} AS id, count(*) AS duplicate_count FROM every_fact "
    f"WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1"
    for key in ("company_id", "location_id", "level_id", "job_category_id")
)

_FROM_STAR["dq_orphans_carried"] = " UNION ALL ".join(
    f"SELECT '{name}' AS check_name, {name} AS n FROM ("
    + _orphans(f"({_FROM_STAR['ups_fact']})", f"(SELECT * FROM {dim} WHERE {key} < '8')", key, name)
    + ")"
    for name, dim, key in (
        ("orphaned_companies", "dim_company", "company_id"), ("orphaned_locations", "dim_location", "location_id"),
        ("orphaned_categories", "dim_job_category", "job_category_id"), ("orphaned_levels", "dim_level", "level_id"),
    )
)

# Tables written twice hold what the plain joins give.
_FROM_STAR["snk_upsert_table"] = _FROM_STAR["ups_guarded"]
_FROM_STAR["snk_append_new"] = _FROM_STAR["ups_insert_only"]

ORACLES = {**{name: _with(sql) for name, sql in _FROM_STAR.items()}, **_FROM_TABLES}
