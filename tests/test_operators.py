"""Filters, ranking, counting and web operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postlake.functions import text, tree
from postlake.operators import aggregate, columns, filters, ranking, web
from postlake.plans import gold
from postlake.plans import silver as silver_plan


def test_day_slice_keeps_the_last_fraction(spark):
    times = [
        "2026-01-01 23:59:59.9", "2026-01-02 00:00:00", "2026-01-02 23:59:59",
        "2026-01-02 23:59:59.5", "2026-01-03 00:00:00",
    ]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    day = dt.date(2026, 1, 2)
    for kind in ("timestamp", "timestamp_ntz"):
        typed = df.select(F.col("t").cast(kind).alias("ingested_at"))
        assert filters.day_slice(typed, day).count() == 3
        assert filters.day_slice(typed, day, to_the_second=True).count() == 2


def test_day_slice_prunes_and_pushes_down(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.sql(
        "SELECT id, timestamp'2026-01-01' + make_interval(0,0,0,cast(id as int)) AS ingested_at "
        "FROM range(5)"
    )
    with_day = df.withColumn("ingest_date", F.to_date("ingested_at"))
    with_day.write.partitionBy("ingest_date").parquet(path)
    stored = spark.read.schema(with_day.schema).parquet(path)
    out = filters.day_slice(stored, dt.date(2026, 1, 3))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
    assert "GreaterThanOrEqual(ingested_at" in plan
    assert [r.id for r in out.collect()] == [2]


def test_required_split_is_complete(spark):
    rows = [("u", "t", "c", "s"), ("u", "  ", "c", "s"), (None, "t", "c", "s"), ("u", "t", "", "s")]
    df = spark.createDataFrame(rows, "job_url string, job_title string, company_name string, source string")
    good, bad = filters.split_required(df)
    assert good.count() == 1 and bad.count() == 3


def test_like_wildcards(spark):
    df = spark.createDataFrame([("Data 100%",), ("Dxta",), (None,)], "job_title string")
    assert df.filter(filters.title_like("D_TA")).count() == 2
    assert df.filter(filters.title_like("data%100")).count() == 1
    assert df.filter(filters.title_contains("100%")).count() == 1
    assert df.filter(filters.title_contains("D_TA")).count() == 0


def test_retain(spark):
    df = spark.sql("SELECT timestamp'2026-01-01' t UNION ALL SELECT timestamp'2026-01-31'")
    assert filters.retain(df, "t", dt.date(2026, 2, 1), 30).count() == 1


def test_first_per_key_limits_before_the_exchange(spark):
    df = spark.range(1000).selectExpr("id % 3 k", "id v")
    out = ranking.first_per_key(df, ["k"], [F.col("v").desc()])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted(map(tuple, out.collect())) == [(0, 999), (1, 997), (2, 998)]


def test_row_hash_breaks_ties_the_same_way_always(spark):
    rows = [("k", i, f"x{i}") for i in range(50)]
    picks = set()
    for parts in (1, 3, 8):
        df = spark.createDataFrame(rows, "k string, i int, x string").repartition(parts)
        picks.add(ranking.first_per_key(df, ["k"], ranking.latest_first(df)).first().i)
    assert len(picks) == 1


def test_top_per_group_equals_plain_ranking(spark):
    df = spark.range(5000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id % 7 as string) END g", "id v")
    out = ranking.top_per_group(df, "g", [F.col("v").desc()], 20, slices=4)
    got = {}
    for g, v in out.collect():
        got.setdefault(g, []).append(v)
    rows = {}
    for g, v in df.collect():
        rows.setdefault(g, []).append(v)
    assert {g: sorted(vs) for g, vs in got.items()} == {g: sorted(vs)[-20:] for g, vs in rows.items()}


@pytest.mark.parametrize("n,pages", [(1, 1), (5, 1), (6, 2), (11, 3)])
def test_pages(spark, n, pages):
    out = ranking.paged(spark.range(n), [F.col("id")]).collect()
    assert {r.pages for r in out} == {pages}
    assert [r.page for r in sorted(out)] == [i // 5 + 1 for i in range(n)]


def test_orphans_with_null_keys(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("b",), (None,)], "k string")
    assert aggregate.orphans(child, parent, "k", "n").first().n == 2
    assert aggregate.orphans(child, parent, "k", "n", nulls_count=True).first().n == 3
    assert aggregate.orphans(child, child, "k", "n").first().n == 0


def test_count_by_name_counts_non_null_ids_of_known_keys(spark):
    facts = spark.createDataFrame([("1", "x"), (None, "x"), ("2", "y"), ("3", None)], "job string, k string")
    dim = spark.createDataFrame([("x", "X"), ("y", "Y"), ("z", "Z")], "k string, name string")
    out = aggregate.count_by_name(facts, dim, "k", "job", "name", "n")
    assert sorted(map(tuple, out.collect())) == [("X", 1), ("Y", 1)]


def test_batch_metrics_of_nothing(spark):
    empty = spark.createDataFrame([], "job_id string, complete boolean")
    assert tuple(aggregate.batch_metrics(empty, "job_id", "complete").first()) == (0, 0, 0, 0, 0, 1.0)


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("t",)], "y string")
    assert sorted(map(tuple, columns.union_by_name([a, b]).collect()), key=str) == [(1, None), (None, "t")]
    with pytest.raises(ValueError):
        columns.union_by_name([])


def test_dedup_order_decides_what_is_rejected(spark):
    rows = [("s", "u", "t", "c", "2026-01-01"), ("s", "u", None, "c", "2026-01-02")]
    df = spark.createDataFrame(
        rows, "source string, job_url string, job_title string, company_name string, ingested_at string"
    ).withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))
    good, bad = silver_plan.complete_postings, silver_plan.rejected_postings
    assert good(df).count() == 1 and bad(df).count() == 1
    assert good(df, dedup_first=True).count() == 0 and bad(df, dedup_first=True).count() == 1


def test_gold_from_a_source_with_few_columns(spark):
    df = spark.createDataFrame([("s", "u", "Python dev", "c")], "source string, job_url string, job_title string, company_name string")
    silver = silver_plan.to_silver(df)
    assert gold.dim_company(silver).count() == 1
    assert gold.dim_location(silver).count() == 0
    assert [r.skill_name for r in gold.dim_skill(silver).collect()] == ["Python"]
    assert gold.fact_job_postings(silver).columns == list(gold.FACT)


def test_bridge_without_exchange_equals_distinct(spark):
    df = spark.createDataFrame([("j", ["a", "b", "a", " ", None]), ("k", None), ("l", ["a"])], "job_id string, skills_array array<string>")
    one, many = gold.bridge_job_skills(df, one_row_per_job=True), gold.bridge_job_skills(df)
    assert sorted(one.collect()) == sorted(many.collect()) and one.count() == 3
    assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()


PAGE = (
    '<h3 class="a"><a href="/it-jobs/x">1</a></h3>'
    '<H3><b><a class="y" href="https://other.example/it-jobs/z">2</a></b><a href="/no">n</a></H3>'
    '<a href="/about">3</a><a href="/it-jobs/x">4</a><p class="title"><a href="/before">b</a></p>'
    '<a href="/vi/tim-viec-lam/dev.35ABCDEF.html">5</a>'
    '<a href="/vi/tim-viec-lam/dev.35ABCDEF.html">6</a>'
    '<a href="/nha-tuyen-dung/viec-lam/x.35ABCDEF.html">7</a>'
    '<a href="/job/long-enough-to-keep-jv">8</a><a href="/job/x">9</a>'
    '<div class="box body-box"><h2 class="title big">\n<a target="_blank" href="/in-box">10</a></h2>'
    '<p class="subtitle"><a href="/sub">11</a></p><p class="sub-title"><a href="/sub">12</a></p>'
    "<p class='title'><span><a href='/deep'>13</a></span></p>"
    "<p class='title'><a href='/later?a=1&amp;b=2'>14</a></p></div>"
)


def test_link_rules(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id int, html string")

    def found(site):
        return [r.link for r in web.links(pages, web.LINK_RULES[site]).collect()]

    assert found("itviec") == ["https://itviec.com/it-jobs/x", "https://other.example/it-jobs/z"]
    assert found("careerviet") == ["https://careerviet.vn/vi/tim-viec-lam/dev.35ABCDEF.html"]
    assert found("vietnamworks") == [
        "https://www.vietnamworks.com/nha-tuyen-dung/viec-lam/x.35ABCDEF.html",
        "https://www.vietnamworks.com/job/long-enough-to-keep-jv",
    ]
    assert found("topcv") == ["/in-box", "/later?a=1&b=2"]


def test_link_quoting(spark):
    html = (
        "<a data-href=\"/x\" href=\"/y?a=1&amp;b=2\">1</a><a href='/q'>2</a><a href=/n>3</a>"
        "<A class=z HREF = \"/u\">4</A><abbr href='/no'>5</abbr><a name=\"href\">6</a>"
    )
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert [r.link for r in web.links(pages, web.LinkRule()).collect()] == ["/y?a=1&b=2", "/q", "/n", "/u"]


def test_backslash_in_a_search(spark):
    titles = spark.createDataFrame([("dev c\\ x",), ("abc%",), ("a\\b",)], "job_title string")
    found = lambda keyword: [r.job_title for r in titles.where(filters.title_like(keyword)).collect()]
    assert found("c\\") == ["dev c\\ x"]
    assert found("a\\b") == ["a\\b"]
    assert found("b_%") == ["abc%"]


def test_decomposed_accents_are_letters(spark):
    import unicodedata

    titles = [unicodedata.normalize(form, t) for form in ("NFC", "NFD") for t in ("Gò vấp", "Bà rịa")]
    rows = spark.createDataFrame([(t,) for t in titles], "t string")
    pattern = rf"(?i)(?<!{text.WORD})(go|ba)(?!{text.WORD})"
    assert rows.where(F.col("t").rlike(pattern)).count() == 0


def test_fields_lists_and_labels(spark):
    html = (
        "<h1 class='t'>\n <b>A&amp;B</b> </h1><ul><li> x </li><li></li><li><i>y</i></li></ul>"
        "<dt>Level</dt><dd>Junior</dd><dt>Level</dt><dd>Senior</dd><dt>Size</dt><dd>9</dd>"
    )
    pages = spark.createDataFrame([(1, html), (2, "<p>no title</p>")], "page_id int, html string")
    assert [tuple(r) for r in web.titles(pages).collect()] == [(1, "A&B")]
    assert [r.items for r in web.list_items(pages).collect()] == [["x", "y"], []]
    nested = "<LI>a<ul><li>b &#233;&#x1F600;&#0;</li></ul></LI><li>c &#8211; &#39;d&#39<li>&amp;#65;"
    inner = spark.createDataFrame([(1, nested), (2, None)], "page_id int, html string")
    items = [r.items for r in web.list_items(inner).collect()]
    assert items == [["a", "b é\U0001f600\ufffd", "c – 'd'", "&#65;"], None]
    pairs = r"<dt>([^<]*)</dt><dd>([^<]*)</dd>"
    out = web.labelled_values(pages, pairs, {"level": "Level", "size": "Size", "none": "Other"})
    assert sorted(map(tuple, out.collect())) == [(1, "Senior", "9", None), (2, None, None, None)]


NESTED = [
    ("<li>a<ul><li>b</li></ul>c</li>", ["abc", "b"]),
    ("<ul><li><b>x<li>y<ul><li>z</ul>w<!-- <li>no -->&amp;</ul>tail<script>'<li>'</script>", ["x", "yzw&", "z"]),
    ("</ul></ul></li><li>q</li><LI> </LI><li/>r", ["q", "r"]),
    ("<ul>" * 70 + "<li>deep" + "</ul>" * 70 + "<li>flat<p>one<p>two</li>x", ["deep", "flatonetwo"]),
    ("no tag", []),
    ("", []),
    (None, None),
]


def test_items_by_nesting(spark):
    pages = spark.createDataFrame([(i, html) for i, (html, _) in enumerate(NESTED)], "page_id int, html string")
    found = {r.page_id: r["items"] for r in web.whole_items(pages.repartition(3)).collect()}
    assert [found[i] for i in range(len(NESTED))] == [want for _, want in NESTED]
    assert web.whole_items(pages.limit(0)).collect() == []


def test_running_depth_equals_a_loop(spark):
    import random

    draw = random.Random(7)
    lists = [[draw.choice((-1, 0, 1)) for _ in range(n)] for n in (0, 1, 31, 32, 33, 500)] + [[-1] * 40 + [1] * 40]

    def loop(steps):
        out, at = [], 0
        for by in steps:
            at = max(0, at + by)
            out.append(at)
        return out

    rows = spark.createDataFrame([(x,) for x in lists], "x array<int>").select("x", tree.running_depth(F.col("x")).alias("d"))
    assert all(r.d == loop(r.x) for r in rows.collect())


def test_children_of_an_element_are_links_in_any_place(spark):
    html = (
        "<p class='title'>see <i>x</i> <a href=/1>1</a><a href='/2'>2</a>"
        '<p class="title"><span><a href=/deep></a></span><br><a href=/4>'
        "<section class='in'><div class='title'><a href='/5'>5</a><div class='title'><a href='/6'></a></div></div>"
        "<div class='in'><h3 class='title'>t<a href='/7'></a></h3></div></section><h3 class='title'><a href='/8'></a></h3>"
    )
    pages = spark.createDataFrame([(1, html), (2, ""), (3, None)], "page_id int, html string")
    found = lambda rule: [r.link for r in web.links(pages, rule).orderBy("page_id").collect()]
    assert found(web.LinkRule(child_of="title")) == ["/1", "/2", "/4", "/5", "/6", "/7", "/8"]
    assert found(web.LinkRule(child_of="title", inside="in")) == ["/5", "/6", "/7"]


def test_labels_and_values_of_groups(spark):
    html = (
        "<div class='g'><div><span class='l'> Level </span></div><p class='v'>Sen<b>ior</b></p></div>"
        "<div class='g'><i class=\"l\">Size</i></div><div class='g'><p class='v'>no label</div>"
        "<div class='g'><p class='l'>Level in years<div class='v'>x<div>y</div>z</div></div>"
    )
    pages = spark.createDataFrame([(1, html), (2, ""), (3, None)], "pairs int, html string")
    wanted = {"level": "Level", "size": "Size"}
    whole = web.grouped_values(pages, "g", "l", "v", wanted)
    assert sorted(map(tuple, whole.collect())) == [(1, "Senior", None), (2, None, None), (3, None, None)]
    parts = web.grouped_values(pages, "g", "l", "v", wanted, part=True)
    assert sorted(map(tuple, parts.collect()))[0] == (1, "xyz", None)


def test_row_numbers_without_one_task(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), (F.col("id") % 3).alias("tie")).repartition(5)
    order = [F.col("tie").desc(), F.col("v")]
    found = ranking.row_numbers(rows, order)
    want = sorted(rows.collect(), key=lambda r: (-r.tie, r.v))
    assert [(r.v, r.tie) for r in sorted(found.collect(), key=lambda r: r["rank"])] == [(r.v, r.tie) for r in want]
    assert sorted(r["rank"] for r in found.collect()) == list(range(1, 1001))
    assert ranking.row_numbers(rows.limit(0), order).count() == 0
    same = ranking.row_numbers(spark.range(50).select(F.lit(1).alias("v")), [F.col("v")])
    assert sorted(r["rank"] for r in same.collect()) == list(range(1, 51))
    pages = ranking.all_paged(rows, order, 30).groupBy("page", "pages").count().collect()
    assert {(r.page, r.pages, r["count"]) for r in pages} == {(p, 34, 30 if p < 34 else 10) for p in range(1, 35)}


def test_rolled_up_tells_subtotals_from_nulls(spark):
    rows = spark.createDataFrame([("a", None, 2), ("a", "x", 3), (None, "x", 4)], "s string, p string, n long")
    found = {tuple(r) for r in aggregate.rolled_up(rows, ["s", "p"], "n").collect()}
    assert found == {("a", None, 2, 0), ("a", "x", 3, 0), (None, "x", 4, 0), ("a", None, 5, 1), (None, None, 4, 1), (None, None, 9, 3)}


def test_a_bound_keyword_is_no_sql(spark, sf_dir):
    from postlake.plans.serving import search, search_bound
    from postlake.registry.stage import StagedStar

    star = StagedStar(spark, sf_dir)
    for keyword in ("data", "DATA", "da%an", "' OR '1'='1", ""):
        assert search_bound(spark, star, keyword).collect() == search(star, keyword).collect()


def test_nesting_counts_only_the_levels_asked_for(spark):
    html = '<div>a<p>x &amp; y<p>z</div><A href="/q">l</a></i><b>t'
    rows = spark.createDataFrame([(html,), ("",), ("no tag",), (None,)], "html string")
    deep = rows.select(tree.nodes(F.col("html")).alias("n")).collect()
    flat = rows.select(tree.nodes(F.col("html"), deep=False).alias("n")).collect()
    assert [n and [x.asDict() for x in n] for (n,) in flat] == [
        n and [{k: v for k, v in x.asDict().items() if k != "depth"} for x in n] for (n,) in deep
    ]
    assert [x.name for x in flat[0].n] == ["div", "p", "p", "div", "a", "a", "i", "b"]
    assert [x.text for x in flat[0].n] == ["a", "x &amp; y", "z", "", "l", "", "", "t"]


def test_groups_equal_a_reading_by_spans(spark):
    import random

    draw = random.Random(3)
    opens = ["<div>", "<div class='g'>", "<p class='l'>", "<DIV class=\"x v\">", "<li class='g l'>", "<b>", "<img class='v'>", "<span>"]
    others = ["</div>", "</p>", "</span>", "</li>", "x ", "1 < 2", "a<b", "<a title='<i>'>", "&amp;", "<!-- <div> -->", "<style><p></style>"]
    pages = ["".join(draw.choice(opens + others) for _ in range(n)) for n in (0, 5, 20, 40, 80, 150) for _ in range(40)]
    # An element that goes on beyond every window of the search, and one that nothing ends.
    pages += [f"<div class='g'><p class='l'>a<b>{'<i>b</i>' * n}<div class='v'>{'<div>c</div>' * n}</div></div>d" for n in (3, 70, 1100)]
    pages += ["<div class='g'><i class='l'>" + "<br>" * 50]
    rows = spark.createDataFrame([(p,) for p in pages] + [(None,)], "html string").repartition(8)
    is_group, is_label, is_value = map(tree.has_class, ("g", "l", "v"))

    def first(part, wanted):
        span = F.get(tree.spans(part, wanted), F.lit(0))
        return tree.bound(span, lambda s: F.when(s.isNotNull(), tree._text(part, s)))

    def pair(part):
        return F.struct(first(part, is_label).alias("label"), first(part, is_value).alias("value"))

    def of_page(page):
        return F.transform(tree.spans(page, is_group), lambda s: tree.bound(tree._slice(page, s), pair))

    found = rows.select(
        tree.group_values(F.col("html"), is_group, is_label, is_value).alias("now"),
        tree.bound(tree.nodes(F.col("html"), deep=False), of_page).alias("want"),
    ).collect()
    assert len(found) == len(pages) + 1 and sum(len(r.now or ()) for r in found) > 300
    assert all(r.now == r.want for r in found)


def test_an_element_ends_at_the_first_tag_below_it(spark):
    """Far from its start too, and at the limit given if that comes first."""
    lengths = (1, 4, 5, 8, 9, 136, 137, 2300)
    rows = [(["div"] + ["i"] * n + ["/div", "br"], [1] * (n + 1) + [0, 0], n) for n in lengths]
    df = spark.createDataFrame(rows, "tags array<string>, block array<int>, n int")
    end = lambda most: tree._end(F.col("tags"), F.col("block"), F.lit(0), most, lambda i: F.lit(False))
    found = df.select("n", end(F.size("tags")).alias("end"), end(F.lit(3)).alias("cut")).collect()
    assert [(r.end, r.cut) for r in found] == [(r.n + 1, min(r.n + 1, 3)) for r in found]
