"""The pipeline against its stages' decisions, odd tables in every stage, and the subpackage's registry."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tidewell import llm

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == COLUMNS
        kept = out.count()
        assert kept == n if name == "line_dedup" else 0 < kept <= n
        n, docs = kept, out
    pieces = corpus_pipeline.run(spark, SF)
    assert pieces.select("doc_id").distinct().count() == n


CLASHING = "y int, score string, removed int, x double, h1 long, node string, label_id long, __text string, __id int, __t1 int, site string, line string, part int, ids int"


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_tables(spark, odd, empty, k):
    """Nulls in any column, empty and long texts, repeats, an empty table, and columns named as those that stages make."""
    name, stage = corpus_pipeline.STAGES[k]
    extra = {n: F.lit("1").cast(t) for n, t in (c.split() for c in CLASHING.split(", "))}
    docs = odd.select(*COLUMNS).withColumns({n: c for n, c in extra.items() if n not in COLUMNS})
    nulls = docs.unionByName(docs.limit(1).select(*[F.lit(None).cast(t).alias(c) for c, t in docs.dtypes]))
    got = stage(spark, nulls, SF).collect()
    if name == "packing":
        # Every row's document, the one without anything too: end ids alone.
        assert len({(r["doc_id"], r["sequence_id"], r["offset"]) for r in got}) == len(got) >= 11
        assert sum(r["length"] for r in got) == sum(r["doc_tokens"] for r in got if r["start"] == 0)
    else:
        assert stage(spark, nulls, SF).columns == COLUMNS and len(got) <= 11
        texts = {(r["doc_id"], r["text"]) for r in nulls.collect()}
        assert {(r["doc_id"], r["text"]) for r in got} <= texts
        if name == "line_dedup":
            assert len(got) == 11
        if name == "near_dedup":
            assert sorted(r["doc_id"] or 0 for r in got) == [0, 0, 3, 4, 5, 6, 7]  # the null and empty texts are one class, the other without id another
    assert stage(spark, empty, SF).count() == 0


def test_registry():
    names = list(llm.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert set(llm.oracle_sql()) <= set(names)


def test_oracle(spark):
    import duckdb

    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    for name, sql in llm.oracle_sql().items():
        got = llm.queries()[name](spark, SF)
        rel = con.sql(sql)
        order = [rel.columns.index(c) for c in got.columns]
        assert sorted(map(tuple, got.collect())) == sorted(tuple(r[k] for k in order) for r in rel.fetchall())
