"""Edge values of the per-value rules, joins and variants on hand-made rows."""

import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from wareflow.operators import catalog, frontier, joins, ledger, pages, prices, rules, variants


def one(spark, column, **values):
    names = list(values) or ["x"]
    return spark.createDataFrame([tuple(values.values()) or (1,)], ", ".join(f"{n} {'string' if isinstance(v, str) or v is None else 'long'}" for n, v in (values or {"x": 1}).items())).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text,price", [("$3.12", 3.12), ("$1,234.50", 1234.5), ("EUR 1.234,56", 1234.56), ("$10 - $20", 10.0), ("1.2.3", 0.0), ("free", 0.0), ("", 0.0), (None, 0.0)])
def test_price(spark, text, price):
    assert one(spark, prices.format_price(F.col("t")), t=text) == price


@pytest.mark.parametrize("text,ok,stock", [("In Stock.", True, 5), ("Only 3 left in stock", True, 3), ("0 in stock", False, 5), ("Usually ships in 2 days", True, 5), ("Currently unavailable", False, 0)])
def test_stock(spark, text, ok, stock):
    a = prices.availability(F.col("t"))
    assert one(spark, F.struct(a.alias("a"), prices.stock(F.col("t"), a).alias("s")), t=text) == Row(a=ok, s=stock)


def test_capitalize(spark):
    assert one(spark, catalog.capitalize(F.col("t")), t="navy BLUE") == "Navy blue"


def test_references(spark):
    schema = "item_id string, item_type string, item_dd boolean, pos int"
    refs = spark.createDataFrame([("a", "t", True, 1), ("a", "t", False, 2), ("", "t", True, 3), (None, "t", True, 4), ("b", "t", True, 5)], schema)
    assert {(r.item_id, r.item_dd) for r in catalog.unique_references(refs).collect()} == {("a", True), ("b", True)}
    assert catalog.unique_references(refs, ("item_dd",)).count() == 2


@pytest.mark.parametrize(
    "url,arg,offset,path",
    [
        ("http://a.b/c", "http://a.b/c?page=2", "http://a.b/c?start=8", "http://a.b/c/page/2/"),
        ("http://a.b/c?x=1", "http://a.b/c?x=1&page=2", "http://a.b/c?x=1&start=7", "http://a.b/c/page/2/?x=1"),
        ("http://a.b/page/4/?page=9&start=5", "http://a.b/page/4/?page=10&start=5", "http://a.b/page/4/?page=9&start=12", "http://a.b/page/5/?page=9&start=5"),
    ],
)
def test_next_pages(spark, url, arg, offset, path):
    u = F.col("u")
    got = one(spark, F.struct(pages.next_page_arg(u, "page", 1), pages.next_page_offset(u, "start", 0, F.lit(7)), pages.next_page_path(u, "/page/", 1, "/")), u=url)
    assert tuple(got) == (arg, offset, path)


def test_embedded_state_of_odd_literals(spark):
    rows = spark.createDataFrame([("{v: 'USD100', a: [{n:'size', v:'10.5'}]}",), ("",), ("nonsense",)], "js string")
    got = [r.state for r in pages.embedded_state(rows, "js", "v string, a array<struct<n:string,v:string>>").collect()]
    assert got[0].v == "USD100" and got[0].a[0].v == "10.5"
    assert got[1].v is None


def test_finish_rule(spark):
    led = spark.createDataFrame([(1, 5, 5, 0, 0, 0, 0, 9), (2, 0, 1, 0, 0, 0, 0, 9), (3, 5, 1, 0, 0, 0, 0, 9), (4, 0, 0, 0, 0, 0, 0, 9)], "crawlid int, total long, crawled long, failed_pages long, failed_pipeline long, dropped long, start long, update long")
    assert [r.finished for r in ledger.finish_rule(led, 100).orderBy("crawlid").collect()] == [True, True, False, False]
    assert all(r.finished for r in ledger.finish_rule(led, 9 + 86400).collect())
    assert ledger.report(led.filter("crawlid = 4")).first().per_minute == 0.0


def test_mapping_prefers_ids(spark):
    names = spark.createDataFrame([("7",), ("x",), ("none",)], "name string")
    mapping = spark.createDataFrame([("x", 7), ("7", 9)], "code string, id int")
    got = {r.name: (r.code, r.id) for r in joins.resolve_mapping(names, mapping).collect()}
    assert got == {"7": ("x", 7), "x": (None, 7)}


def test_complement_keeps_unlisted_sizes(spark):
    p = spark.createDataFrame([(1, ["red"], ["S"], [("red", "XL", 2.0, 3)])], "product_id int, colors array<string>, sizes array<string>, stocked array<struct<color:string,size:string,price:double,stock:int>>")
    assert {tuple(r)[1:] for r in variants.complement_sizes(p).collect()} == {("red", "S", 0.0, 0), ("red", None, 2.0, 3)}


def test_options_meet_in_their_row(spark):
    """Nothing is shuffled; options that lack the other, repeated and null variants, null names and arrays, null product ids."""
    kind = "array<struct<variant:long,name:string>>"
    p = spark.createDataFrame(
        [(1, [(1, "red"), (2, "blue"), (None, "odd"), (4, None)], [(1, "S"), (1, "M"), (3, "L"), (None, "XL"), (4, "S")]), (2, [(1, "red"), None], []), (3, [(1, "red")], None), (4, None, [(1, "S")]), (5, [(1, "a"), (1, "b")], [(1, "S"), (1, None)]), (None, [(1, "red")], [(1, "S")])],
        f"product_id int, colors {kind}, sizes {kind}",
    )
    got = variants.merge_attributes(p)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, 1, "red", "S"), (1, 1, "red", "M"), (2, 1, "red", None), (2, None, None, None), (3, 1, "red", None), (5, 1, "a", "S"), (5, 1, "b", "S")], key=repr)
    assert "Exchange" not in got._jdf.queryExecution().sparkPlan().toString() and "Join" not in got._jdf.queryExecution().sparkPlan().toString()


def test_empty_axes(spark):
    p = spark.createDataFrame([(1, ["a", " "], []), (2, None, ["x"])], "product_id int, color array<string>, size array<string>")
    assert {(r.product_id, r.color, r.size) for r in variants.cartesian(p, ["color", "size"]).collect()} == {(1, "a", "default"), (2, "default", "x")}


def test_css_rules(spark):
    html = '<div class="box big"><a href="/1">one <b>two</b></a><a>no</a></div><p id="q">x&amp;y<br>z</p>'
    page = spark.createDataFrame([(1, "u", html), (2, "u", None), (3, "u", "")], "page_id int, url string, html string")
    rule = rules.Rule
    got = rules.extract(page, [rule("a", (("css", "div.box a[href]"),)), rule("h", (("css", "a::attr(href)"),)), rule("p", (("css", "#q"),)), rule("d", (("css", "i"),), default="-")]).orderBy("page_id").collect()
    assert tuple(got[0])[2:] == ("one two", "/1", "x&yz", "-")
    assert tuple(got[1])[2:] == tuple(got[2])[2:] == ("", "", "", "-")


def test_user_processor(spark):
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def shout(s):
        return s.str.upper()

    from wareflow.operators.messages import translate

    texts = spark.createDataFrame([(1, "a b"), (2, None)], "id int, text string")
    assert {r.id: r.text for r in translate(texts, None, function=shout).collect()} == {1: "A B"}


def test_user_function_shuffles_nothing(spark):
    """Segments go back to their text where they are: texts longer than a batch, empty ones, segments that the function has nothing for, small batches."""
    from pyspark.sql.functions import pandas_udf

    from wareflow.operators.messages import translate

    @pandas_udf("string")
    def some(s):
        return s.str.upper().where(s.str.len() > 1)

    texts = [(i, " ".join(f"{'w' * (j % 3)}{'x' if j % 3 else ''}" or "y" for j in range(i * 7))) for i in range(60)] + [(100, "ab " * 30_000 + "end"), (101, ""), (None, "no id"), (103, None)]
    df = spark.createDataFrame(texts, "id long, text string").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        found = translate(df, None, function=some)
        assert found._jdf.queryExecution().sparkPlan().toString().count("Exchange") == 1  # the repartition above
        assert {r.id: r.text for r in found.collect()} == {i: " ".join(w.upper() if len(w) > 1 else w for w in re.split("[ \n]+", t)) for i, t in texts if t is not None}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_closed_weekday(spark):
    due = spark.createDataFrame([(1, "s", 5), (1, "s", 4), (2, "", 4), (3, "t", 4)], "item_id int, site string, due long")
    friday = 4 * 86400  # 1970-01-05 was a Monday
    got = frontier.refresh_batches(due, 4 * 86400 + friday, {"t": 4}, 1).collect()
    assert [(r.item_id, r.site, r.due, r.chunk) for r in got] == [(1, "s", 4, 0)]


def test_endpoint_health_empty(spark):
    log = spark.createDataFrame([], "endpoint long, seq long, ok boolean")
    assert ledger.endpoint_health(log).count() == 0


def test_site_mapping_rules(spark):
    """Image rules, position and what a site does at the end."""
    m = variants.SiteMapping("s", sku_id="id", price="p", list_price="p", stock="q", is_main="url like '%-p-%'", image_type="regexp_extract(url, '-([a-z])-', 1)", position="9 - n", process=lambda df: df.filter("stock > 0"))
    images = spark.createDataFrame([("x-p-1", 1), ("x-q-1", 2), ("x", 3)], "url string, n int")
    assert {(r.url, r.is_main, r.kind, r.pos) for r in catalog.image_rows(images, m).collect()} == {("x-p-1", True, "p", 8), ("x-q-1", False, "q", 7), ("x", False, "MAIN", 6)}
    skus = spark.createDataFrame([(1, "a", 1.0, 0), (2, "b", 2.0, 3)], "product_id int, id string, p double, q int")
    assert [r.sku_id for r in variants.single_sku(skus, m).collect()] == ["b"]


def test_schedule_predicate(spark):
    """U4: rows that the predicate leaves out stay due."""
    due = spark.createDataFrame([("a", "x", 5), ("b", "y", 6), ("c", None, 7)], "item_id string, site string, due long")
    got = frontier.refresh_batches(due, 1706659200, {}, 10, lambda site, now: (site != "x") | (F.hour(now) >= 6))
    assert {(r.item_id, r.chunk) for r in got.collect()} == {("b", 0)}


def test_relational_windows(monkeypatch):
    """A5: half-open windows of ids, each with the filter, are what the database is asked for."""
    from wareflow import sources

    asked = {}
    reader = type("R", (), {"jdbc": lambda self, url, table, predicates, properties: asked.update(url=url, table=table, predicates=predicates, properties=properties)})()
    session = type("S", (), {"read": reader})()
    sources.read_relational(session, "jdbc:x", "t", "id", 0, 25_000, 10_000, "site = 3", {"user": "u"})
    assert asked["predicates"] == ["id >= 0 and id < 10000 and (site = 3)", "id >= 10000 and id < 20000 and (site = 3)", "id >= 20000 and id < 25000 and (site = 3)"]
    assert (asked["url"], asked["table"], asked["properties"]) == ("jdbc:x", "t", {"user": "u"})


def test_running_sums_over_buckets(spark):
    """Sums cross buckets and null keys, and rows of one time go by the rest of the order."""
    rows = spark.createDataFrame([(k, t, i, i) for k in ("a", None) for i, t in enumerate([-5, 3, 3, 99, 100, 250, 1000])], "k string, t long, i int, v int")
    got = ledger.running(rows, ["k"], "t", ["t", "i"], ["v"], 100).collect()
    assert {(r.k, r.i): r.run_v for r in got} == {(k, i): i * (i + 1) // 2 for k in ("a", None) for i in range(7)}
