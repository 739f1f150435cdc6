"""Readers, writers and merges on small files."""

import zipfile

import pytest
from pyspark.sql import functions as F

from tidewell.operators import classify, identity, merge, reports
from tidewell.sources import readers, writers


def test_bulk_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('title,url,apply_url,is_remote,salary_min,salary_currency\nDev,,https://a/1,true,10,EUR\n,https://a/2,,,,\n"Q, ""x""",https://a/3,,no,,\n')
    (tmp_path / "b.csv").write_text("title,url,location\nOps,https://b/1,Oslo\n")
    got = readers.postings(readers.bulk_csv(spark, {"a": str(tmp_path / "a.csv"), "b": str(tmp_path / "b.csv")}))
    rows = {r["url"]: r for r in got.collect()}
    assert set(rows) == {"https://a/1", "https://a/3", "https://b/1"}
    assert rows["https://a/1"]["location"] == "Remote" and rows["https://a/1"]["salary"] == "10-? EUR" and rows["https://b/1"]["source_ats"] == "b"


def test_company_seed(spark):
    df = spark.createDataFrame([("A", "https://A.com/x", "fr"), ("B", "b.de", "de"), ("", "c.com", "fr"), ("D", "nodot", "fr")], "Company string, Website string, Country_Code string")
    assert [r["domain"] for r in readers.company_seed(df, ["France"], {"fr": "france"}).collect()] == ["a.com"]
    assert readers.company_seed(df.withColumn("Country_Code", F.lit("")), ["France"]).count() == 2


def test_ranks_and_bands(spark, tmp_path):
    (tmp_path / "r.tsv").write_text("#h\n1\t0.5\t1\t0.1\tcom.a\t1\n2\t0.4\t2\t0.1\tde.b.c\t1\n9\t0.1\t3\t0.1\tcom.z\t1\n")
    got = readers.domain_ranks(spark, str(tmp_path / "r.tsv"), 5).select("domain", reports.band(F.col("rank"), [("S", 1), ("A", 3)]).alias("b")).collect()
    assert [tuple(r) for r in got] == [("a.com", "S"), ("c.b.de", "A")]


def test_zip(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("a.csv", "n,c\n1,x\n2,y\n")
        z.writestr("b.json", '[{"n": 3}]')
        z.writestr("c.jsonl", '{"n": 4}\n{"n": 5}\n')
    got = readers.zipped(spark, str(tmp_path / "x.zip")).select("member", F.col("row")["n"].alias("n")).collect()
    assert sorted(tuple(r) for r in got) == [("a.csv", "1"), ("a.csv", "2"), ("b.json", "3"), ("c.jsonl", "4"), ("c.jsonl", "5")]


def test_registry_files(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"lever": ["a", ""], "ashby": ["b"]}')
    assert sorted(tuple(r) for r in readers.slug_map(spark, str(tmp_path / "m.json")).collect()) == [("ashby", "b"), ("lever", "a")]
    assert readers.registry_json(spark, str(tmp_path / "m.json")).count() == 2
    (tmp_path / "s.txt").write_text("# no\na\n\n b \n")
    assert [r[0] for r in readers.slug_lines(spark, str(tmp_path / "s.txt")).collect()] == ["a", "b"]


def test_technology_top(spark):
    df = spark.createDataFrame([("2024-01", "p1", 1, [("x",)]), ("2024-02", "p2", 2, [("x",), ("y",)]), ("2024-02", "p3", 1, [("x",)])], "date string, page string, rank int, technologies array<struct<technology:string>>")
    assert sorted(tuple(r) for r in readers.technology_top(df, 1, 1).collect()) == [("x", "p3"), ("y", "p2")]


def test_snapshots(spark, tmp_path):
    root = "file://" + str(tmp_path / "t")
    assert writers.latest_snapshot(spark, root) is None
    writers.write_snapshot(spark.range(2), root, 1)
    writers.write_snapshot(spark.range(5), root, 2)
    assert writers.latest_snapshot(spark, root).count() == 5
    with pytest.raises(Exception):  # noqa: B017
        writers.write_snapshot(spark.range(1), root, 2)


def test_merge_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, name string, n int")
    source = spark.createDataFrame([(2, 20), (3, 30)], "k int, n int")
    once = merge.snapshot_merge(target, source, ["k"], ["n"])
    twice = merge.snapshot_merge(once, source, ["k"], ["n"])
    want = [(1, "a", 1), (2, "b", 20), (3, None, 30)]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == want
    assert merge.snapshot_merge(target, source, ["k"], ["n"], insert=False).count() == 2


def test_identity_nulls_and_repeats(spark):
    df = spark.createDataFrame([(1, "k", "u"), (2, "k", "v"), (3, "", ""), (4, None, None)], "id int, key string, url string")
    assert identity.duplicate_groups(df, "key").collect()[0]["n"] == 2
    stored = spark.createDataFrame([], "key string, stored_url string")
    assert identity.known_and_new(df, stored, "url", "key", "id").count() == 3


def test_follow_links(spark):
    seeds = spark.createDataFrame([("d", "p")], "domain string, page string")
    links = spark.createDataFrame([("p", f"a{k}", k, k) for k in range(5)] + [("a4", "b1", 1, 0), ("a4", "a3", 9, 1)], "page string, target string, score int, pos int")
    got = {(r["page"], r["depth"]) for r in classify.follow_links(seeds, links).collect()}
    assert got == {("a4", 1), ("a3", 1), ("a2", 1), ("b1", 2)}


def test_expiry_defaults(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00",), ("nonsense",), ("2024",), (None,)], "at string")
    now = F.lit("2024-01-22").cast("timestamp")
    assert [r[0] for r in df.select(merge.expired(F.col("at"), now)).collect()] == [False, True, True, True]


def test_bins():
    assert reports.pack_bins([("a", 5), ("b", 4), ("c", 3)], 2) == [("a", 5, 0), ("b", 4, 1), ("c", 3, 1)]
