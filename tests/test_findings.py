"""What a reviewer found on odd inputs and larger tables: queries equal their SQL there too."""

import datetime as dt
import os

import duckdb

from tidewell.plans import registry


def same_as_sql(spark, folder, name, table):
    """Rows of a query and of its SQL over folder/table.parquet, a file or a folder of files, in order."""
    con = duckdb.connect()
    path = f"{folder}/{table}.parquet"
    con.sql(f"create view {table} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    sql = con.sql(registry.oracle_sql()[name])
    got = registry.queries()[name](spark, str(folder)).select(*sql.columns)
    return sorted(map(repr, map(tuple, got.collect()))), sorted(map(repr, sql.fetchall()))


def test_stream_ttl_files_out_of_time_order(spark, tmp_path):
    at = lambda day, user: (user, dt.datetime(2024, 1, 1) + dt.timedelta(days=day))
    days = [at(30, 1), at(19.5, 1), at(20, 2), at(9, 2), at(5, 1), at(0, 1), at(10, 1), at(0, 2), at(31, None), at(1, None), (3, None)]
    for row in days:  # one file each, a few in a trigger
        spark.createDataFrame([row], "user_id long, ts timestamp_ntz").coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    got, want = same_as_sql(spark, tmp_path, "stream_ttl", "events")
    assert got == want and len(got) == 4


def test_stream_ttl_without_events(spark, tmp_path):
    spark.createDataFrame([], "user_id long, ts timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got, want = same_as_sql(spark, tmp_path, "stream_ttl", "events")
    assert got == want == []


def test_page_title_references_without_semicolon(spark, tmp_path):
    heads = ["Cut&amp;&amp", "Salt &amp; more", "A&ampB&nbsp;C", "&quot;Ampersand&quot; &", "R&amp;amp;D", "&amp;nbsp", "Q&A &#38"]
    rows = [(k, f"<html><title>t | s</title><h1>{h}</h1><p>a&amp;b</p></html>") for k, h in enumerate(heads)]
    spark.createDataFrame([*rows, (99, None)], "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got, want = same_as_sql(spark, tmp_path, "page_title", "pages")
    assert got == want
