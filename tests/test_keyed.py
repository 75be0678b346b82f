"""Keyed tables: what a batch touches, and what it leaves alone."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from postlake.operators import aggregate
from postlake.plans import quality
from postlake.session import store
from postlake.sinks import keyed, serving
from postlake.sources.tables import changed_parts, read_changed_day

PARTS = 8


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(spark, n, **columns):
    made = {name: F.expr(sql) for name, sql in columns.items()}
    return spark.range(n).select(F.col("id").cast("string").alias("k")).withColumns(made)


def files_of(spark, table):
    """Path and modification time of each file, by part."""
    out = {}
    for file in spark.table(table).inputFiles():
        path = file.removeprefix("file://")
        out.setdefault(int(path.split("key_part=")[1].split("/")[0]), []).append((path, os.stat(path).st_mtime_ns))
    return out


@pytest.fixture
def unhinted(spark):
    """No broadcast join: what is exchanged is then what the layout demands."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_untouched_parts_keep_their_files(spark):
    keyed.upsert_keyed(rows_of(spark, 500, a="'a'"), "kept_files", "k", parts=PARTS)
    before = files_of(spark, "kept_files")
    assert len(before) == PARTS and all(len(f) == 1 for f in before.values())
    batch = spark.createDataFrame([("7", "z"), ("new", "n")], "k string, a string")
    touched = keyed.upsert_keyed(batch, "kept_files", "k")
    assert touched == keyed.touched(batch, "k", PARTS) and 1 <= len(touched) <= 2
    after = files_of(spark, "kept_files")
    assert {p for p in before if before[p] != after[p]} == set(touched)
    table = spark.table("kept_files")
    assert table.count() == 501
    assert {tuple(r) for r in table.where("a <> 'a'").select("k", "a").collect()} == {("7", "z"), ("new", "n")}
    assert keyed.upsert_keyed(batch.limit(0), "kept_files", "k") == []
    assert files_of(spark, "kept_files") == after


def test_target_is_read_by_partition_and_not_exchanged(spark, unhinted):
    keyed.create(rows_of(spark, 500, a="'a'"), "pruned", "k", PARTS)
    plan = plan_of(keyed.parts_slice(spark, "pruned", [1, 3]))
    assert "PartitionFilters: [" in plan and "key_part" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert keyed.parts_slice(spark, "pruned", [1, 3]).inputFiles()
    batch = rows_of(spark, 5, a="'z'")
    merged = keyed.upsert(keyed.parts_slice(spark, "pruned", [1, 3]).drop("key_part"), batch, "k")
    assert plan_of(merged).count("Exchange hashpartitioning") == 1


def test_rows_lie_where_spark_puts_the_bucket(spark):
    keyed.create(rows_of(spark, 300, a="'a'"), "in_buckets", "k", PARTS)
    for part, files in files_of(spark, "in_buckets").items():
        buckets = {int(path.rsplit("_", 1)[1].split(".")[0]) for path, _ in files}
        assert buckets == {part}
    assert keyed.parts_of(spark, "in_buckets") == PARTS
    spark.range(1).write.saveAsTable("not_keyed")
    with pytest.raises(ValueError, match="not a keyed table"):
        keyed.parts_of(spark, "not_keyed")


def test_an_overwrite_that_was_cut_off_is_finished(spark):
    keyed.upsert_keyed(rows_of(spark, 100, a="'a'"), "cut_off", "k", parts=PARTS)
    batch = spark.createDataFrame([("7", "z")], "k string, a string")
    wanted = keyed.touched(batch, "k", PARTS)
    merged = keyed.upsert(keyed.parts_slice(spark, "cut_off", wanted).drop("key_part"), batch, "k")
    path = store(merged.withColumn("key_part", keyed.key_part("k", PARTS)), "merged")
    spark.sql(f"ALTER TABLE cut_off SET TBLPROPERTIES ('{keyed.PENDING}' = '{path}')")
    # The driver is lost after the old files are gone and before the new ones are there.
    spark.sql(f"ALTER TABLE cut_off DROP PARTITION (key_part = {wanted[0]})")
    assert spark.table("cut_off").count() < 100
    keyed.upsert_keyed(spark.createDataFrame([("new", "n")], "k string, a string"), "cut_off", "k")
    rows = {r.k: r.a for r in spark.table("cut_off").collect()}
    assert len(rows) == 101 and rows["7"] == "z" and rows["new"] == "n"
    assert not keyed.settle(spark, "cut_off", "k")


def test_only_keys_are_exchanged_to_check_them(spark, monkeypatch):
    checked, inner = [], keyed.require_unique

    def seen(rows, key, within=()):
        checked.append(rows.columns)
        return inner(rows, key, within)

    monkeypatch.setattr(keyed, "require_unique", seen)
    keyed.upsert_keyed(rows_of(spark, 50, a="'a'"), "narrow_check", "k", parts=PARTS)
    keyed.upsert_keyed(rows_of(spark, 9, a="'z'"), "narrow_check", "k")
    assert checked == [["k"], ["k"]]
    assert spark.table("narrow_check").where("a = 'z'").count() == 9
    with pytest.raises(Exception, match="duplicate k in upsert source: 3"):
        keyed.upsert_keyed(spark.createDataFrame([("3", "x"), ("3", "y")], "k string, a string"), "narrow_check", "k")
    assert spark.table("narrow_check").count() == 50


def test_stored_rows_are_put_in_place_without_an_exchange(spark, monkeypatch):
    keyed.upsert_keyed(rows_of(spark, 400, a="'a'"), "put_back", "k", parts=PARTS)
    frame = type(spark.range(1))
    monkeypatch.setattr(frame, "repartition", lambda *_: pytest.fail("rows that lie by part were exchanged"))
    keyed.upsert_keyed(rows_of(spark, 300, a="'z'"), "put_back", "k")
    monkeypatch.undo()
    for part, files in files_of(spark, "put_back").items():
        assert {int(path.rsplit("_", 1)[1].split(".")[0]) for path, _ in files} == {part}
    assert {r.a: r["count"] for r in spark.table("put_back").groupBy("a").count().collect()} == {"a": 100, "z": 300}


def test_upsert_of_all_kinds_of_rows(spark):
    keyed.upsert_keyed(rows_of(spark, 0, a="'a'"), "from_nothing", "k", parts=PARTS)
    assert spark.table("from_nothing").count() == 0
    odd = spark.createDataFrame([("", "e"), (None, "n"), ("é", "x")], "k string, a string")
    keyed.upsert_keyed(odd, "from_nothing", "k")
    keyed.upsert_keyed(odd.where("k = 'é'").withColumn("a", F.lit("y")), "from_nothing", "k")
    assert sorted(map(str, ((r.k, r.a) for r in spark.table("from_nothing").collect()))) == sorted(
        map(str, [("", "e"), (None, "n"), ("é", "y")])
    )


def test_change_feed(spark):
    first, second = dt.date(2026, 2, 1), dt.date(2026, 2, 2)

    def load(rows, day):
        stamped = rows.withColumn("updated_at", F.lit(f"{day} 01:02:03").cast("timestamp"))
        keyed.upsert_keyed(stamped, "fed", "k", parts=PARTS, feed_ts="updated_at", guard=("a",))

    load(rows_of(spark, 400, a="'a'"), first)
    again = spark.createDataFrame([("3", "z"), ("4", "a"), ("new", "n")], "k string, a string")
    for _ in range(2):  # a rerun notes a key again and changes nothing
        load(again, second)
    found = read_changed_day(spark, "fed", second)
    assert {(r.k, r.a) for r in found.collect()} == {("3", "z"), ("new", "n")}
    assert read_changed_day(spark, "fed", first).count() == 399
    parts = changed_parts(spark, "fed", second)
    assert len(parts) <= 2 and "key_part" in plan_of(found).split("PartitionFilters: [")[1].split("]")[0]
    assert read_changed_day(spark, "fed", dt.date(2026, 2, 3)).count() == 0
    assert changed_parts(spark, "kept_files", first) is None


def test_bridge_lies_with_its_facts(spark, unhinted):
    facts = rows_of(spark, 300, title="'t'").withColumnRenamed("k", "job_id")
    links = facts.select("job_id", F.explode(F.array(F.lit("s1"), F.lit("s2"))).alias("skill_id"))
    links = links.withColumn("bridge_id", F.md5(F.concat("job_id", "skill_id")))
    keyed.upsert_keyed(facts, "with_facts", "job_id", parts=PARTS)
    keyed.append_keyed(links, "with_links", "bridge_id", "job_id", parts=PARTS)
    keyed.append_keyed(links.where("job_id < 50"), "with_links", "bridge_id", "job_id")
    assert spark.table("with_links").count() == 600
    more = links.where("job_id = 7").unionByName(links.where("job_id = 8").withColumn("bridge_id", F.concat(F.lit("x"), "bridge_id")))
    fresh = keyed.unknown_rows(more, "with_links", "bridge_id", "job_id", PARTS, keyed.touched(more, "job_id", PARTS))
    plan = plan_of(fresh)
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    before = files_of(spark, "with_links")
    keyed.append_keyed(more, "with_links", "bridge_id", "job_id")
    assert spark.table("with_links").count() == 602
    after = files_of(spark, "with_links")
    assert all(set(before[p]) <= set(after[p]) for p in before)
    orphans = aggregate.orphans(spark.table("with_links"), spark.table("with_facts"), "job_id", "n", nulls_count=True)
    assert "hashpartitioning" not in plan_of(orphans) and orphans.first().n == 0
    with pytest.raises(Exception, match="duplicate bridge_id"):
        keyed.append_keyed(more.union(more), "with_links", "bridge_id", "job_id")


def test_layout_is_not_published(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(serving, "write_side_table", lambda df, *_, **__: sent.append(df.columns))
    monkeypatch.setattr(serving, "swap_in", lambda *_: None)
    keyed.upsert_keyed(rows_of(spark, 5, a="'a'"), "to_publish", "k", parts=PARTS)
    serving.publish_table(spark, "to_publish", "t", "url", {})
    assert sent == [["k", "a"]]


def test_orphans_are_carried_forward(spark):
    def facts(rows):
        return spark.createDataFrame(rows, "job_id string, company_id string")

    def dim(*keys):
        return {"orphaned_companies": (spark.createDataFrame([(k,) for k in keys], "company_id string"), "company_id")}

    def load(rows, dims, carried=True):
        touched = keyed.upsert_keyed(facts(rows), "orphan_facts", "job_id", parts=PARTS)
        quality.carry_orphans_forward(spark, "orphan_facts", dims, "orphan_state", touched if carried else None)
        table, (known, key) = spark.table("orphan_facts"), dims["orphaned_companies"]
        found = quality.carried_orphans(spark, "orphan_state", dims).collect()
        assert [tuple(r) for r in found] == [("orphaned_companies", aggregate.orphans(table, known, key, "n").first().n)]
        return found[0].n

    assert load([(str(i), f"c{i % 3}") for i in range(60)] + [("x", None)], dim("c0", "c1")) == 20
    assert load([("1", "c2"), ("2", "c0"), ("new", "gone")], dim("c0", "c1")) == 21
    assert load([("new", "c0")], dim("c0", "c1", "c2")) == 0
    assert load([("3", "gone")], dim("c0", "c1", "c2")) == 1
    assert load([], dim("c0", "c1", "c2")) == 1
    assert load([("3", "c1")], dim("c0", "c1", "c2"), carried=False) == 0
