"""Worked examples and properties of the scalar functions."""

import hashlib
import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.functions import geo, hashing, html, jd, slugs, textscore, urls
from tidewell.sources import readers


def one(spark, rows, fn):
    df = spark.createDataFrame([(r,) for r in rows], "v string")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_url_key(spark):
    urls_ = ["HTTPS://Ex.com/A//b/?b=2&UTM_source=x&A=1#f", "https://ex.com/a/b?a=1&b=2#f", "no scheme", None, "", "https://ex.com/x%2f%aB", "https://ex.com/", "https://ex.com"]
    assert one(spark, urls_, urls.url_key) == ["https://ex.com/a/b?a=1&b=2#f", "https://ex.com/a/b?a=1&b=2#f", "no scheme", "", "", "https://ex.com/x%2F%AB", "https://ex.com/", "https://ex.com"]


def test_canonical_url(spark):
    given_ = ["https://jobs.ashbyhq.com/Acme/ID/?ref=a", "https://x.wd1.myworkdayjobs.com/en-US/Site/job/Ab", "HTTP://EX.com/A/?src=1&q=Z"]
    assert one(spark, given_, urls.canonical_url) == ["https://jobs.ashbyhq.com/acme/id", "https://x.wd1.myworkdayjobs.com/en-US/site/job/Ab", "http://ex.com/A/?q=Z"]


def test_key_properties(spark):
    paths = ["/a/B", "/x//y/", "/", "", "/q%2fz"]
    queries = ["", "?a=1", "?b=2&a=1", "?utm_x=1&a=B"]
    all_ = [f"https://H.com{p}{q}" for p in paths for q in queries]
    df = spark.createDataFrame([(u,) for u in all_], "u string").select("u", urls.url_key(F.col("u")).alias("k"), urls.url_key(urls.canonical_url(F.col("u"))).alias("c"))
    df = df.withColumn("kk", urls.url_key(F.col("k")))
    assert all(r["k"] == r["kk"] == r["c"] for r in df.collect())


def test_md5_shard(spark):
    keys = ["greenhouse|acme", "", "é", "x" * 100]
    assert one(spark, keys, lambda c: hashing.md5_shard(c, 7)) == [int(hashlib.md5(k.encode()).hexdigest(), 16) % 7 for k in keys]


def test_slug_title(spark):
    given_ = ["https://e.com/jobs/customer-success-manager-12345.html", "https://e.com/", "https://e.com/one", "https://e.com/a/0a1b2c3d4e-senior-dev"]
    assert one(spark, given_, urls.slug_title) == ["Customer Success Manager", "", "", "Senior Dev"]


def test_posting_slugs(spark):
    given_ = ["events-marketing-manager-job-description", "acme-12345", "senior-sales-manager", "acme-manager", "en-US", "logo.png", "acme"]
    assert one(spark, given_, slugs.is_real) == [False, False, False, True, False, False, True]


def test_sizes_and_salaries(spark):
    assert one(spark, ["1,001-5,000", "10000+", "", None, "small"], textscore.size_floor) == [1001, 10000, None, None, None]
    df = spark.createDataFrame([("1", "2", "EUR", "year"), (None, "2", "EUR", None), (None, None, "EUR", "year")], "a string, b string, c string, d string")
    assert [r[0] for r in df.select(textscore.salary(*[F.col(c) for c in "abcd"])).collect()] == ["1-2 EUR year", "?-2 EUR", ""]


def test_jd_score_agrees(spark):
    texts = ["Responsibilities: you will. Requirements. Apply now. Full-time, remote. Your team.", "Hello", "", "this position has been filled " * 3, "• a • b • c • d • e benefits you have your skills"]
    assert [round(x, 6) for x in one(spark, texts, textscore.jd_score)] == [round(jd.score(t), 6) for t in texts]


def test_hiring_and_closed(spark):
    assert one(spark, ["we're hiring", "one career only", "job and career", "", None], textscore.has_hiring_words) == [True, False, True, False, False]
    assert one(spark, ["This job has expired", "open", None], textscore.is_closed) == [True, False, None]


def test_countries():
    assert geo.countries_of(None) == [] and geo.countries_of("") == []
    assert geo.countries_of("Remote (British Columbia, CA)") == ["Canada"]
    assert geo.countries_of("San Jose, CA") == ["United States"]
    assert geo.countries_of("Mexico City, Mexico; New Mexico") == ["Mexico", "United States"]


PAGE = """<html><head><title>Dev - Acme</title><script type="application/ld+json">{"@graph":[{"@type":"JobPosting","title":"Dev &amp; Ops","url":"/j/1",
"jobLocation":{"address":{"addressLocality":"Paris","addressCountry":{"name":"France"}}},"hiringOrganization":{"name":"Acme"},"validThrough":"2030-01-01"}]}</script></head>
<body><nav><a href="/careers">Careers</a></nav><p>Hi<p>There<table><tr><td>a<td>b</table><a href="/jobs/dev-1">Developer</a> <a rel="next" href="?page=2">2</a>
<iframe src="https://boards.greenhouse.io/embed/job_board?for=acme"></iframe><a href="/apply">Apply now</a></body></html>"""


def test_pages():
    base = "https://ex.com/l"
    assert html.page_title("<h1>Hello there</h1>") == "Hello there" and html.page_title(PAGE) == "Dev"
    assert html.json_ld_jobs(PAGE, base, "2024-01-01") == [{"title": "Dev & Ops", "url": "https://ex.com/j/1", "location": "Paris, France", "company": "Acme", "description": "", "rung": 1}]
    assert html.json_ld_jobs(PAGE, base, "2031-01-01") == []
    assert html.postings(PAGE, base, "2031-01-01")[0]["url"] == "https://ex.com/jobs/dev-1"
    assert html.next_page(PAGE, base) == "https://ex.com/l?page=2"
    assert html.apply_url(PAGE, base) == "https://ex.com/apply"
    assert html.job_frames(PAGE, base) == ["https://boards.greenhouse.io/embed/job_board?for=acme"]
    assert ("https://ex.com/careers", 2) in html.listing_links(PAGE, base)
    assert "https://ex.com/jobs/dev-1" in html.candidate_urls(PAGE, base)
    assert html.visible_text(None) == "" and html.main_text("") == ("", 0)
    assert html.state_jobs('<script>window.x = {"a":[{"title":"T","url":"/u"},{"title":"S","url":"/v"}]};</script>', base)[1]["url"] == "https://ex.com/v"
    assert html.sitemap_urls("<loc> https://a/b?x=1&amp;y=2 </loc>") == ["https://a/b?x=1&y=2"]
    assert html.feed_jobs("<rss><item><title><![CDATA[A]]></title><link>/x</link></item></rss>", base)[0]["url"] == "https://ex.com/x"
    assert html.decode("é".encode("cp1252")) == "é" and html.decode(b"\xef\xbb\xbfa") == "a"
    assert html.clean_url("https://a.b/c).&quot;x") == "https://a.b/c" and html.clean_url("https://a/${x}") == ""


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="<>/ab pdiv='\"&;!-", max_size=60))
def test_parser_never_fails(text):
    html.visible_text(text), html.page_title(text), html.candidate_urls(text, "https://e.com")


def test_registry_layouts():
    flat = [{"platform": "Lever", "slug": "a"}, {"ats": "ashby", "token": "b", "enabled": False}]
    want = [{"ats": "lever", "slug": "a", "url": "", "name": ""}]
    assert readers.registry_entries(json.dumps(flat)) == want
    assert readers.registry_entries(json.dumps({"companies": flat}))[0]["slug"] == "a"
    assert readers.registry_entries(json.dumps({"lever": ["a"]})) == want
    assert readers.registry_entries("{") == []


def test_robots(spark):
    text = "User-agent: x\nDisallow: /x\nUser-agent: *\nDisallow: /private # no\nAllow: /\n"
    df = spark.createDataFrame([(text, "/private/a"), (text, "/x")], "t string, p string")
    assert [r[0] for r in df.select(readers.robots_allows(readers.robots_rules(F.col("t"), "bot"), F.col("p"))).collect()] == [False, True]


def test_deep_find():
    assert readers.deep_find({"a": {"Company-Name": "x"}, "b": 1}, ["company_name"]) == ["a", "Company-Name"]
    assert readers.deep_find({"a": {"b": {}}}, ["c"]) is None


def test_page_queries_take_whole_pages(spark, tmp_path):
    from tidewell.plans import page_queries

    page = "<body><p>" + "word " * 8000 + "last</p>" + "".join(f"<a href='/p{k}'></a>" for k in range(4500)) + "</body>"
    spark.createDataFrame([(1, "https://ex.com/", page)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    d = str(tmp_path)
    for query in (page_queries.strip_html, page_queries.main_text):
        assert query(spark, d).first()["text"] == "word " * 8000 + "last" and len(query(spark, d, 30_000).first()["text"]) == 30_000
    assert page_queries.links(spark, d).count() == 4500 and page_queries.links(spark, d, 4000).count() == 4000
