"""More operator cases: URL resolution, first match, slug, idempotent
re-write, source listing, top-n per group, gold size."""

import contextlib
import io

from pyspark.sql import functions as F

from pumpline.operators import gold, html, nearby, silver
from pumpline.plans import snapshots, stream_registry
from pumpline.session import scratch_path
from pumpline.sinks import raw as rawsink
from pumpline.sources import raw as rawsrc, testdata
from tests.helpers import T0, obs, silver_df


def test_resolve_url_cases(spark):
    base = "https://site.example.com/a/b/page.html?x=1#top"
    cases = {
        "http://other.example.org/z": "http://other.example.org/z",
        "//cdn.example.net/s.js": "https://cdn.example.net/s.js",
        "/root/path": "https://site.example.com/root/path",
        "?q=2": "https://site.example.com/a/b/page.html?q=2",
        "#frag": "https://site.example.com/a/b/page.html?x=1#frag",
        "rel/file.js": "https://site.example.com/a/b/rel/file.js",
        "./here.js": "https://site.example.com/a/b/here.js",
        "../up.js": "https://site.example.com/a/up.js",
        "x/../../y": "https://site.example.com/a/y",
        "mailto:x@example.com": "mailto:x@example.com",
    }
    df = spark.createDataFrame([(base, k) for k in cases], "base string, link string")
    got = {r.link: r.out for r in df.select("link", html.resolve_url(F.col("base"), F.col("link")).alias("out")).collect()}
    assert got == cases
    bare = spark.createDataFrame([("https://h.example.com", "x.js")], "base string, link string")
    assert bare.select(html.resolve_url(F.col("base"), F.col("link"))).first()[0] == "https://h.example.com/x.js"


def test_page_links_first_position_and_dedup(spark):
    page = ('<html><script src="/a.js"></script><SCRIPT type="x" SRC=\'b.js\'></SCRIPT>'
            '<script src="/a.js"></script></html>')
    df = spark.createDataFrame([(1, "https://s.example.com/dir/p", page)], "page_id long, url string, html string")
    got = sorted((r.first_pos, r.link) for r in html.page_links(df, tag="script", attr="src").collect())
    assert got == [(0, "https://s.example.com/a.js"), (1, "https://s.example.com/dir/b.js")]


def test_first_match_order(spark):
    pages = spark.createDataFrame([
        (1, '<meta property="og:title" content="OG"><title>T</title><h1>H</h1>'),
        (2, "<title>T2</title><h1>H2</h1>"),
        (3, "<h1>H3</h1>"),
        (4, "<p>none</p>"),
    ], "page_id long, html string")
    got = {r.page_id: r.title for r in html.first_match_extract(pages).collect()}
    assert got == {1: "OG", 2: "T2", 3: "H3", 4: None}


def test_partition_slug(spark):
    df = spark.createDataFrame([("GASOLINA ADITIVADA/95",), ("a=b.c-d_e",)], "v string")
    assert [r[0] for r in df.select(rawsink.partition_slug("v")).collect()] == ["GASOLINA_ADITIVADA_95", "a=b.c-d_e"]


def test_rewriting_a_run_does_not_duplicate(spark, sf_small):
    obs_df = testdata.silver(spark, sf_small, with_obs_id=True)
    root = scratch_path(spark, "rewrite")
    recs = snapshots.raw_records(snapshots.snapshot_rows(obs_df))
    rawsink.write_raw_jsonl(recs, root)
    n = rawsrc.scan_raw(spark, root).count()
    rawsink.write_raw_jsonl(recs.filter(F.col("run_id").startswith("run-0000")), root)
    assert rawsrc.scan_raw(spark, root).count() == n


def test_snapshot_rows_cover_each_observation(spark, sf_small):
    obs_df = testdata.silver(spark, sf_small, with_obs_id=True)
    snap = snapshots.snapshot_rows(obs_df)
    per_obs = snap.groupBy("obs_id").count()
    assert per_obs.count() == obs_df.count()
    assert per_obs.agg(F.max("count")).first()[0] <= 2
    lag = F.col("collected_at") >= F.col("price_ts")
    within = F.col("collected_at") < F.col("price_ts") + F.expr("INTERVAL 72 HOURS")
    assert snap.filter(~(lag & within)).count() == 0


def test_snapshot_rows_of_some_collections(spark, sf_small):
    """Each range holds the rows of the whole, and leaves out other days' events where they are read."""
    obs_df = testdata.silver(spark, sf_small, with_obs_id=True)
    whole = snapshots.snapshot_rows(obs_df)
    newest, n = snapshots.collected_span(obs_df)
    assert n == whole.agg(F.max("collection")).first()[0] + 1
    for lo, hi in [(0, 0), (0, 4), (3, 7), (n - 2, n - 1), (0, n - 1), (n, n + 3)]:
        want = whole.filter(F.col("collection").between(lo, hi))
        for known in (newest, None):
            some = snapshots.snapshot_rows(obs_df, collections=(lo, hi), newest=known)
            assert some.exceptAll(want).count() == 0 and want.exceptAll(some).count() == 0
    some = snapshots.snapshot_rows(obs_df, collections=(3, 7), newest=newest)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        some.explain("formatted")
    assert "GreaterThan(ts," in buf.getvalue() and "LessThanOrEqual(ts," in buf.getvalue()


def test_rounds_deliver_each_run_once(spark, sf_small, tmp_path):
    """The rounds bring the runs of all collections, the oldest ones first."""
    seen, counts = set(), []
    for _ in stream_registry._delivered(spark, sf_small, str(tmp_path / "in")):
        runs = {r.run_id for r in rawsrc.scan_raw(spark, str(tmp_path / "in")).select("run_id").distinct().collect()}
        if seen:
            assert max(runs - seen) < min(seen)  # collection 0 is the newest
        seen = runs
        counts.append(len(runs))
    whole = snapshots.snapshot_rows(testdata.silver(spark, sf_small, with_obs_id=True))
    assert len(counts) == stream_registry.ROUNDS and counts == sorted(set(counts))
    assert seen == {r.run_id for r in whole.select("run_id").distinct().collect()}
    assert rawsrc.scan_raw(spark, str(tmp_path / "in")).count() == whole.count()


def test_source_listing_pages(spark):
    rows = [obs(i, 5.0 + i / 100, i % 80, lat=-12.97 + i / 1000, lng=-38.5) for i in range(60)]
    s = silver_df(spark, rows)
    p1 = nearby.source_listing(s, "GASOLINA", as_of=T0, hours=72, page=1, page_rows=25)
    p3 = nearby.source_listing(s, "GASOLINA", as_of=T0, hours=72, page=3, page_rows=25)
    total = p1.total()
    assert total == sum(1 for i in range(60) if i % 80 < 72)
    assert p1.items.count() == 25 and p3.items.count() == total - 50
    assert nearby.listing_totals(p1).first().total_pages == 3
    prices = [r.price_net for r in p1.items.collect()]
    assert prices == sorted(prices)


def test_best_per_group_and_gold_size(spark):
    rows = [obs(i, float(i % 5), i, city="A" if i % 2 else "B", code=f"P{i % 3}") for i in range(40)]
    s = silver_df(spark, rows)
    g = gold.gold_latest(s)
    assert g.count() == s.select("cnpj", "product_code").distinct().count()
    top = gold.best_per_group(g, n=2).collect()
    assert len(top) == 4 and {r.rank for r in top} == {1, 2}


def test_latest_as_of(spark):
    rows = [obs(1, 5.0, 10), obs(1, 6.0, 1)]
    s = silver_df(spark, rows)
    assert gold.latest_as_of(s, "2024-01-10 05:00:00").first().price_unit == 5.0
    assert gold.latest_as_of(s).first().price_unit == 6.0


def test_silver_validate_flags(spark):
    bad = [obs(1, -1.0, 1), obs(2, 5.0, 1, lat=95.0), obs(3, 5.0, -2, collected_hours_ago=0)]
    v = {r.rule: r.failed for r in silver.silver_validate(silver_df(spark, bad)).collect()}
    assert v["price_out_of_range"] == 1 and v["lat_out_of_range"] == 1 and v["ts_after_collection"] == 1


def test_resolve_url_matches_urljoin(spark):
    from urllib.parse import urljoin
    bases = ["https://s.example.com/a/b/c.html?x=1#f", "http://h.example.org", "http://h.example.org/",
             "https://h.example.net/a/b/"]
    links = ["../d", "../../d", "../../../../d", "./x/./y", "x/../y", "..", ".", "/a/./b/../c",
             "//cdn.example.com/p/../q", "?q=1", "#z", "http://o.example.com/a/../b", "z", "a/b/..", "a/.", "/../x"]
    df = spark.createDataFrame([(b, k) for b in bases for k in links], "base string, link string")
    got = df.select("base", "link", html.resolve_url(F.col("base"), F.col("link")).alias("u")).collect()
    assert [(r.base, r.link, r.u) for r in got if r.u != urljoin(r.base, r.link)] == []


def test_nearby_join_antimeridian_and_high_latitude(spark):
    from math import asin, cos, radians, sin, sqrt

    def hav(a, b, c, d):
        return 2 * 6371 * asin(sqrt(sin(radians(c - a) / 2) ** 2
                                    + cos(radians(a)) * cos(radians(c)) * sin(radians(d - b) / 2) ** 2))
    sites_rows = [(i, lat, lng) for i, (lat, lng) in enumerate(
        [(0.0, 179.95), (0.0, -179.95), (0.0, 179.2), (75.0, 178.0), (75.0, -177.0), (-80.0, 10.0),
         (-80.0, 60.0), (10.0, 10.0), (10.05, 10.05), (89.9, 0.0), (89.9, 180.0), (-12.9, -38.5)])]
    pts_rows = [(0, 0.0, -179.99), (1, 75.0, 179.9), (2, -80.0, 35.0), (3, 10.0, 10.02), (4, 89.95, 90.0),
                (5, -12.95, -38.45)]
    sites = spark.createDataFrame(sites_rows, "cnpj int, lat double, lng double")
    pts = spark.createDataFrame(pts_rows, "point_id int, p_lat double, p_lng double")
    for r in (5.0, 60.0, 150.0):
        got = {(x.point_id, x.cnpj) for x in nearby.nearby_join(pts, sites, r).collect()}
        want = {(p, s) for p, a, b in pts_rows for s, c, d in sites_rows if hav(a, b, c, d) <= r}
        assert got == want, r


def test_links_follow_the_attribute_grammar(spark):
    html_text = ("<area href='/no1'><a data-href='/no2'>x</a><abbr href='/no3'><A CLASS=\"x > y\" HREF = '/yes1'>"
                 "<a\n  title='a \"b\" c'\n  href=/yes2>z</a><a href=\"\">empty</a><a href=\"it's\">q</a>")
    df = spark.createDataFrame([(1, "https://h.example.com/d/p", html_text)], "page_id bigint, url string, html string")
    got = {r.link for r in html.page_links(df).collect()}
    assert got == {"https://h.example.com/yes1", "https://h.example.com/yes2", "https://h.example.com/d/it's"}


def test_titles_in_either_attribute_order(spark):
    pages = [(1, '<meta content="T1" property="og:title"><title>no</title>'), (2, "<meta property=og:title content='T2'>"),
             (3, "<title>T3</title>"), (4, "<h1 class=x>T4</h1>"), (5, "<p>none</p>")]
    df = spark.createDataFrame(pages, "page_id bigint, html string")
    assert {r.page_id: r.title for r in html.first_match_extract(df).collect()} == {1: "T1", 2: "T2", 3: "T3", 4: "T4", 5: None}


def test_long_and_unclosed_tags(spark):
    """Linear time and no deep recursion on tags of any length."""
    many = " ".join(f'data-a{i}="v{i} > x"' for i in range(10_000))
    pages = [(1, f"<a {many} href='/far'>x</a><a href=/near>"), (2, "<a " + "word " * 200_000), (3, '<a title="open ' + "word " * 200_000 + "<a href='/in'>"),
             (4, "<a " * 100_000 + "href=/last>"), (5, "<a href" + " " * 500_000 + "= '/spaced'>"), (6, '<a href="/once" href="/twice"><a href><a href=><a HREF=/up/>'),
             (7, "<title " * 50_000 + ">T</title>"), (8, None), (9, ""), (10, "<html lang=pt " + "x " * 100_000 + "><meta " + many + " charset=utf-8>")]
    df = spark.createDataFrame([(i, "https://h.example.com/", h) for i, h in pages], "page_id bigint, url string, html string")
    got = {}
    for r in html.page_links(df).collect():
        got.setdefault(r.page_id, {})[r.first_pos] = r.link.removeprefix("https://h.example.com")
    assert got == {1: {0: "/far", 1: "/near"}, 3: {0: "/in"}, 4: {0: "/last"}, 5: {0: "/spaced"}, 6: {0: "/once", 1: "/up/"}}
    fields = {r.page_id: (r.title, r.charset, r.lang) for r in html.first_match_extract(df).collect()}
    assert fields[7] == ("T", None, None) and fields[10] == (None, "utf-8", "pt") and fields[8] == (None, None, None)


def test_charset_in_the_content_of_a_meta_tag(spark):
    pages = [(1, "<meta http-equiv=x content='text/html; charset=ISO-8859-1'>"), (2, '<meta content="a"><meta content="b;CHARSET = x_1">'),
             (3, "<meta content='text/html'>"), (4, "<title></title><h1>H</h1>")]
    df = spark.createDataFrame(pages, "page_id bigint, html string")
    assert [(r.charset, r.title) for r in html.first_match_extract(df).orderBy("page_id").collect()] == [
        ("ISO-8859-1", None), ("x_1", None), (None, None), (None, "H")]


def test_means_use_prices_as_they_are(spark):
    """Prices with five and eight decimals are not rounded before the mean."""
    from pumpline.operators import gold as goldops, series
    from tests.helpers import obs, silver_df
    s = silver_df(spark, [obs(1, 1.00004, 3), obs(2, 1.00004, 2), obs(3, 4.12345678, 30)])
    day = {r.samples: r.avg_price_unit for r in series.timeseries_daily(s, "GASOLINA").items.collect()}
    assert abs(day[2] - 1.00004) < 1e-12 and abs(day[1] - 4.12345678) < 1e-12
    rolled = {r.samples: r.avg_price_unit for r in goldops.rollup_daily(goldops.timeseries_base(s)).collect()}
    assert all(abs(rolled[k] - day[k]) < 1e-12 for k in day)
