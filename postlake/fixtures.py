"""Posting rows derived from the given ``orders`` and ``customer`` tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_POSTINGS = """
SELECT
  o.o_orderkey AS posting_key,
  CASE o.o_orderkey % 4 WHEN 0 THEN 'site_a' WHEN 1 THEN 'site_b' WHEN 2 THEN 'site_c' ELSE 'site_d' END AS source,
  CASE WHEN o.o_orderkey % 97 = 0 THEN NULL
       ELSE 'https://jobs.example/' || CAST(o.o_orderkey - CASE WHEN o.o_orderkey % 20 = 16 THEN 4 ELSE 0 END AS STRING) END AS job_url,
  CASE o.o_orderkey % 13
    WHEN 0 THEN 'Senior Data Engineer (Python, Spark)' WHEN 1 THEN 'Data Analyst' WHEN 2 THEN 'Data Scientist'
    WHEN 3 THEN 'Fullstack Developer' WHEN 4 THEN 'Java Backend Developer' WHEN 5 THEN 'React Native Mobile Developer'
    WHEN 6 THEN 'DevOps Engineer AWS/GCP' WHEN 7 THEN 'QA Tester' WHEN 8 THEN 'Product Manager'
    WHEN 9 THEN 'AI Engineer' WHEN 10 THEN 'Accountant' WHEN 11 THEN '   ' ELSE NULL END AS job_title,
  CASE WHEN o.o_custkey % 31 = 0 THEN NULL ELSE '  ' || c.c_name || ' ' END AS company_name,
  c.c_mktsegment AS company_industry,
  CASE o.o_custkey % 6 WHEN 0 THEN '1.000+ nhân viên' WHEN 1 THEN '25 - 99 nhân viên' WHEN 2 THEN '100–499'
    WHEN 3 THEN 'Startup' WHEN 4 THEN '50 people' ELSE NULL END AS scale,
  CASE o.o_custkey % 8 WHEN 0 THEN 'TP.HCM, Quận 1' WHEN 1 THEN ' Hà Nội ' WHEN 2 THEN 'Hồ Chí Minh & Hà Nội'
    WHEN 3 THEN 'Technopark' WHEN 4 THEN 'Đà Nẵng' WHEN 5 THEN ' Huế' WHEN 6 THEN 'Oversea' ELSE NULL END AS place,
  CASE o.o_orderkey % 7 WHEN 0 THEN 'Không yêu cầu' WHEN 1 THEN 'Dưới 1 năm' WHEN 2 THEN 'Trên 5 năm'
    WHEN 3 THEN '3 năm' WHEN 4 THEN 'Dưới một năm' WHEN 5 THEN '2 - 4 years' ELSE NULL END AS experience,
  CASE o.o_orderkey % 9 WHEN 0 THEN 'Nhân viên' WHEN 1 THEN 'Senior Lead' WHEN 2 THEN 'Trưởng phòng' WHEN 3 THEN 'Intern'
    WHEN 4 THEN ' Expert ' WHEN 5 THEN 'Giám đốc' WHEN 6 THEN 'Fresher / Junior' WHEN 7 THEN 'Middle' ELSE NULL END AS level,
  CASE o.o_orderkey % 5 WHEN 0 THEN 'Hybrid' WHEN 1 THEN 'Làm từ xa' WHEN 2 THEN 'At office' WHEN 3 THEN ' Part time ' ELSE NULL END AS working_type,
  CASE o.o_orderkey % 5 WHEN 0 THEN 'Python, SQL, ,java ' WHEN 1 THEN 'Excel' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE 'Docker,Docker, Kafka' END AS skills,
  CASE o.o_orderkey % 12
    WHEN 0 THEN 'Thoả thuận' WHEN 1 THEN '10 - 20 triệu' WHEN 2 THEN 'Tới 30 triệu' WHEN 3 THEN 'Từ 15 triệu'
    WHEN 4 THEN CAST(500 + o.o_custkey % 900 AS STRING) || ' - ' || CAST(1500 + o.o_custkey % 900 AS STRING) || ' USD'
    WHEN 5 THEN '$500 - $1000' WHEN 6 THEN '15,000,000 VND' WHEN 7 THEN '1,000 - 2,000 USD' WHEN 8 THEN '7,5 Tr - 9,5 Tr VND'
    WHEN 9 THEN '' WHEN 10 THEN '25000000' ELSE NULL END AS salary,
  CASE o.o_orderkey % 4 WHEN 0 THEN 'Còn ' || CAST(o.o_custkey % 45 AS STRING) || ' ngày' WHEN 1 THEN '30/06/2026' WHEN 2 THEN 'Hết hạn' ELSE NULL END AS deadline,
  o.o_orderdate AS ingested_at
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
"""


def _dealt(rows: DataFrame, *by: str) -> DataFrame:
    """Rows in as many tasks as a shuffle has: files of few row groups are read by few tasks,
    and what is done with the rows costs far more than reading them."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("orders", "customer")}
    orders = tables["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    return spark.sql(RAW_POSTINGS, orders=_dealt(orders, *orders.columns), customer=tables["customer"])
