"""Upsert laws, against a plain dictionary merge."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from postlake.operators.upsert import new_rows, require_unique, upsert

SCHEMA = "k string, a string, b string, src string"
COLUMNS = ("k", "a", "b", "src")

values = st.one_of(st.none(), st.sampled_from(["x", "y"]))
tables = st.dictionaries(st.sampled_from("pqrstu"), st.tuples(values, values, values), max_size=6)


def frame(spark, table):
    return spark.createDataFrame([(k, *v) for k, v in table.items()], SCHEMA)


def merged(target, source, set_null=False, guard=(), keep=(), insert_only=False):
    out = dict(target)
    for key, new in source.items():
        old = target.get(key)
        if old is None:
            out[key] = new
            continue
        old_row, new_row = dict(zip(COLUMNS[1:], old)), dict(zip(COLUMNS[1:], new))
        changed = not guard or any(old_row[g] != new_row[g] for g in guard)
        if insert_only or not changed:
            continue
        for name in COLUMNS[1:]:
            if name not in keep and (set_null or new_row[name] is not None):
                old_row[name] = new_row[name]
        out[key] = tuple(old_row[name] for name in COLUMNS[1:])
    return out


RULES = {
    "silver": {"guard": ("a",), "keep": ("src",)},
    "dimension": {"set_null": True},
    "fact": {},
    "bridge": {"insert_only": True},
}


@pytest.mark.parametrize("rule", RULES.values(), ids=RULES.keys())
@settings(
    max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(target=tables, source=tables)
def test_equals_dictionary_merge(spark, rule, target, source):
    out = upsert(frame(spark, target), frame(spark, source), "k", **rule)
    rows = [tuple(r) for r in out.collect()]
    assert len(rows) == len({r[0] for r in rows})
    assert {r[0]: r[1:] for r in rows} == merged(target, source, **rule)
    again = upsert(out, frame(spark, source), "k", **rule)
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_source_without_a_column(spark):
    target = frame(spark, {"p": ("x", "y", "z")})
    source = spark.createDataFrame([("p", "n"), ("q", "m")], "k string, a string")
    rows = {r.k: tuple(r) for r in upsert(target, source, "k", set_null=True).collect()}
    assert rows == {"p": ("p", "n", "y", "z"), "q": ("q", "m", None, None)}
    with pytest.raises(ValueError, match="not in the target"):
        upsert(source, target, "k")


def test_repeated_source_key_fails(spark):
    target = frame(spark, {"p": ("x", "y", "z")})
    source = frame(spark, {"p": ("1", "1", "1")})
    with pytest.raises(PySparkException, match="duplicate k in upsert source: p"):
        upsert(target, source.union(source), "k").collect()
    assert require_unique(source, "k").count() == 1


def test_new_rows(spark):
    target = frame(spark, {"p": ("x", "y", "z")})
    source = frame(spark, {"p": ("1", "1", "1"), "q": ("2", "2", "2")})
    assert [r.k for r in new_rows(target, source, "k").collect()] == ["q"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_target_is_not_shuffled(spark, tmp_path):
    from postlake.sinks.tables import publish_version

    rows = spark.range(200).select(
        F.col("id").cast("string").alias("k"), F.lit("a").alias("a"), F.lit("b").alias("b")
    )
    publish_version(rows, "bucketed_target", bucket_by="k", buckets=8)
    source = rows.filter("k < 5")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(upsert(spark.table("bucketed_target"), source, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SelectedBucketsCount: 8 out of 8" in plan or "Bucketed: true" in plan


def test_upserted_tables_keep_one_file_per_bucket(spark, tmp_path):
    from postlake.sinks.tables import upsert_table

    rows = spark.range(500).selectExpr("cast(id as string) k", "'a' a", "cast(id as string) b")
    upsert_table(rows, "keyed", "k", buckets=8)
    upsert_table(rows.filter("k < 20").withColumn("a", F.lit("z")), "keyed", "k", buckets=8)
    table = spark.table("keyed")
    assert table.count() == 500 and table.filter("a = 'z'").count() == 20
    files = [f.rsplit("/", 1)[-1] for f in table.inputFiles()]
    buckets = [f.split("_")[1].split(".")[0] for f in files]
    assert len(set(buckets)) == len(files) == 8
