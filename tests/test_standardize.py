"""Golden cases of the column standardizers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postlake.fixtures import raw_postings
from postlake.operators import standardize as std
from postlake.plans.silver import SILVER_COLUMNS, to_silver


def one_column(spark, name, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"n int, {name} string")


def outputs(df, *names):
    return [tuple(r[n] for n in names) for r in df.orderBy("n").collect()]


SALARIES = [
    ("Thoả thuận", None, None, None, "Negotiable"),
    ("10 - 20 triệu", 10.0, 20.0, "tr VND", "10tr - 20tr"),
    ("Tới 30 triệu", None, 30.0, "tr VND", "20tr - 30tr"),
    ("Từ 15 triệu", 15.0, None, "tr VND", "10tr - 20tr"),
    ("500 - 1500 USD", 500.0, 1500.0, "USD", "20tr - 30tr"),
    ("$500 - $1000", 500.0, None, "USD", "10tr - 20tr"),
    ("15,000,000 VND", 15.0, None, "tr VND", "10tr - 20tr"),
    ("1,000 - 2,000 USD", 1000.0, 2000.0, "USD", "> 30tr"),
    ("7,5 Tr - 9,5 Tr VND", 7.5, None, "tr VND", "< 10tr"),
    ("", None, None, "tr VND", "Negotiable"),
    ("25000000", 25000000.0, None, "tr VND", "20tr - 30tr"),
    (None, None, None, None, "Negotiable"),
    # Edges: prefix words, no digits, both thousands marks, a bare "to".
    ("from 20 - 25", 20.0, 25.0, "tr VND", "20tr - 30tr"),
    ("Up to 1,200.50 USD", None, 1200.0, "USD", "20tr - 30tr"),
    ("lương tốt", None, None, "tr VND", "Negotiable"),
    ("Cạnh tranh 5 - 10", None, None, None, "Negotiable"),
    ("total 12", None, 12.0, "tr VND", "10tr - 20tr"),
    ("10 – 12", 10.0, 12.0, "tr VND", "10tr - 20tr"),
]
SALARIES[8] = ("7,5 Tr - 9,5 Tr VND", 7.5, 9.5, "tr VND", "< 10tr")


def test_salary_and_band(spark):
    df = one_column(spark, "salary", [s[0] for s in SALARIES])
    out = std.enrich_salary_band(std.extract_salary(df))
    got = outputs(out, "salary_raw", "salary_min", "salary_max", "salary_currency", "salary_band")
    assert got == SALARIES


def test_band_without_amounts(spark):
    assert outputs(std.enrich_salary_band(one_column(spark, "x", ["a"])), "salary_band") == [
        ("Negotiable",)
    ]


LABELS = [
    (
        std.standardize_location,
        "place",
        "location",
        {
            "TP.HCM, Quận 1": "Hồ Chí Minh",
            " Hà Nội ": "Hà Nội",
            "Hồ Chí Minh & Hà Nội": "Hà Nội",
            "Technopark": "Hà Nội",
            "Đà Nẵng": "Đà Nẵng",
            " Huế": "Huế",
            "Oversea": "Oversea",
            "Can Tho, Ha Noi": "Hà Nội",
            "da nang / can tho": "Cần Thơ",
            "": "",
            None: None,
        },
    ),
    (
        std.standardize_experience,
        "experience",
        "experience_req",
        {
            "Không yêu cầu": "Not required",
            "Dưới 1 năm": "< 1 years",
            "Trên 5 năm": "> 5 years",
            "3 năm": "3 years",
            "Dưới một năm": None,
            "2 - 4 years": "2 years",
            "": None,
            "99999999999 years": None,
            "007": "7 years",
            None: None,
        },
    ),
    (
        std.standardize_level,
        "level",
        "level_processed",
        {
            "Nhân viên": "Junior",
            "Senior Lead": "Lead",
            "Trưởng phòng": "Manager",
            "Intern": "Intern",
            " Expert ": "Expert",
            "Giám đốc": "Director",
            "Fresher / Junior": "Junior",
            "Internal Audit": "Intern",
            None: None,
        },
    ),
    (
        std.standardize_working_type,
        "working_type",
        "working_type_std",
        {
            "Hybrid": "Hybrid",
            "Làm từ xa": "Remote",
            "At office": "Onsite",
            " Part time ": "Part time",
            "remote / hybrid": "Hybrid",
            None: None,
        },
    ),
    (
        std.standardize_company_size,
        "scale",
        "company_size_std",
        {
            "1.000+ nhân viên": "1000+",
            "25 - 99 nhân viên": "25-99",
            "100–499": "100-499",
            "Startup": None,
            "50 people": "50 people",
            "10 - 20, 500+": "500+",
            "A+ grade, 1 - 9": "1-9",
            "5.000-\n9.999": "5000-9999",
            " 1,234 staff ": "1,234 staff",
            None: None,
        },
    ),
    (
        std.standardize_job_category,
        "job_title",
        "job_category",
        {
            "Senior Data Engineer (Python, Spark)": "Backend Developer",
            "Data Engineer": "Data Engineer",
            "React Native Mobile Developer": "Mobile Developer",
            "QA Tester": "QA/QC / Tester",
            "AI Engineer": "AI Engineer",
            "C++ dev": "Others",
            "C++11 dev": "Backend Developer",
            "ASP.NET dev": "Backend Developer",
            ".NET dev": "Others",
            "Chuyên viên kiểm thử": "QA/QC / Tester",
            "Retail email chair": "Others",
            "big data analyst": "Data Analyst",
            None: "Others",
        },
    ),
]


@pytest.mark.parametrize("step,column,output,cases", LABELS, ids=[c[2] for c in LABELS])
def test_labels(spark, step, column, output, cases):
    df = one_column(spark, column, list(cases))
    assert outputs(step(df), column, output) == list(cases.items())
    absent = step(one_column(spark, "other", ["x"]))
    expected = "Others" if output == "job_category" else None
    assert outputs(absent, output) == [(expected,)]
    assert set(absent.columns) == {"n", "other", output}


def test_deadline(spark):
    cases = ["Còn 5 ngày", "30/06/2026", "Hết hạn", None]
    df = one_column(spark, "deadline", cases)
    with_ref = df.withColumn("ingested_at", F.lit("2026-01-01 23:00:00").cast("timestamp"))
    expected = [(dt.date(2026, 1, 6),), (dt.date(2026, 1, 31),), (None,), (None,)]
    assert outputs(std.parse_deadline(with_ref), "deadline_date") == expected
    as_text = df.withColumn("ingested_at", F.lit("2026-01-01"))
    assert outputs(std.parse_deadline(as_text), "deadline_date") == expected
    today = spark.range(1).select(F.current_date()).first()[0]
    without = outputs(std.parse_deadline(df), "deadline_date")
    assert without[0][0] in (today + dt.timedelta(days=5), today + dt.timedelta(days=6))


def test_skills_by_type(spark):
    text = one_column(spark, "skills", ["a, ,b,", " ", None])
    assert outputs(std.normalize_skills(text), "skills_array") == [(["a", "b"],), ([],), ([],)]
    lists = spark.createDataFrame(
        [(0, [" a ", "", None, "b"]), (1, None), (2, [])], "n int, skills array<string>"
    )
    assert outputs(std.normalize_skills(lists), "skills_array") == [(["a", "b"],), (None,), ([],)]
    number = spark.createDataFrame([(0, 1)], "n int, skills int")
    assert outputs(std.normalize_skills(number), "skills_array") == [([],)]
    assert outputs(std.normalize_skills(number.drop("skills")), "skills_array") == [([],)]


TITLES = {
    "Senior Data Engineer (Python, Spark)": ["Python", "Spark"],
    "React Native Mobile Developer": ["React", "React Native"],
    "DevOps Engineer AWS/GCP": ["AWS", "GCP"],
    "C++ dev": [],
    "C++11 dev": ["C++"],
    "spark python spark": ["Python", "Spark"],
    "CI/CD, JavaScript, golang": ["Javascript", "Golang", "CI/CD"],
    "javascripts gogo": [],
    "c#1 and nodejs": ["NodeJS", "C#"],
    None: [],
}


def test_title_skills(spark):
    df = one_column(spark, "job_title", list(TITLES)).withColumn(
        "skills_array", F.array(F.lit("Spark"), F.lit("spark"))
    )
    got = dict(outputs(std.enrich_skills_from_title(df), "job_title", "skills_array"))
    given = ["Spark", "spark"]
    assert got == {t: given + [s for s in names if s not in given] for t, names in TITLES.items()}
    null_list = df.withColumn("skills_array", F.lit(None).cast("array<string>"))
    assert {r[0] for r in outputs(std.enrich_skills_from_title(null_list), "skills_array")} == {None}
    assert std.enrich_skills_from_title(df.drop("job_title")).columns == ["n", "skills_array"]


def test_keys(spark):
    import hashlib

    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    df = spark.createDataFrame(
        [(0, "s", "u", " ACME Ñ "), (1, "s", None, None)],
        "n int, source string, job_url string, company_name string",
    )
    out = std.generate_company_id(std.generate_job_id(df))
    assert outputs(out, "job_id", "company_id") == [
        (md5("s||u"), md5("acme ñ")),
        (md5("s"), None),
    ]


def test_one_step_at_a_time_equals_the_chain(spark, sf_dir):
    from postlake.fixtures import raw_postings

    raw = raw_postings(spark, sf_dir)
    chain = to_silver(raw)
    df = raw
    for step in (
        std.extract_salary, std.enrich_salary_band, std.parse_deadline, std.standardize_location,
        std.standardize_experience, std.standardize_level, std.standardize_working_type,
        std.normalize_skills, std.enrich_skills_from_title, std.standardize_job_category,
        std.standardize_company_size, std.generate_company_id, std.generate_job_id,
    ):
        df = df.transform(step)
    single = df.select(*(c for c in SILVER_COLUMNS if c in df.columns))
    same = chain.select(*single.columns)
    assert chain.columns == list(SILVER_COLUMNS)
    assert single.exceptAll(same).isEmpty() and same.exceptAll(single).isEmpty()


def test_postings_are_dealt_over_tasks(spark, sf_dir):
    """A file of one row group is not standardized by one task."""
    tasks = raw_postings(spark, sf_dir).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 1
