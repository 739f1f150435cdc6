"""Line dedup by distinct-site spread, in SQL functions only.

Every distinct non-empty trimmed line, known by a 128-bit hash, has a HyperLogLog
sketch of the sites (sources) it stands on; sketches merge by aggregation. Lines whose
estimate is far above the threshold are boilerplate, those far below are not, and those
near it get exact distinct counts. Every document loses its boilerplate lines, however
many of its lines they are. A text that stands on so many sites as a whole, equal to
the letter, is a copied document, not boilerplate around one; it stays as it is, for
near-duplicate removal to judge.

Defined results: a null text stays null, an empty one empty. Lines are compared without
the white space around them; empty lines are never boilerplate, and kept lines stay as
they are. A null source is a site of its own. Repeated rows are each cleaned alike.
Further columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import common

QUERY = "op5_lines"

#: Sites from which on a line is boilerplate; bits of a sketch; margin around the threshold.
SITES, BITS, MARGIN = 10, 10, 0.25
#: Lines up to this number are broadcast (24 bytes each), more are joined by shuffle, a line's rows dealt into SALTS parts.
BROADCAST_LINES, SALTS = 200_000, 32


def key(line: Column) -> list[Column]:
    """Two independent 64-bit hashes of a trimmed line."""
    return [F.xxhash64(line), F.xxhash64(line, F.lit("second"))]


def trimmed(line: Column) -> Column:
    """A line without spaces, tabs and carriage returns around it."""
    return F.trim(line, F.lit(" \t\r"))


def lines_of(docs: DataFrame, *more: str) -> DataFrame:
    """(h1, h2, chars, *more) of every non-empty line."""
    split = docs.where(F.col("text").isNotNull()).select(*more, F.explode(F.split("text", "\n")).alias("line"))
    split = split.select(*more, trimmed(F.col("line")).alias("line")).where("line <> ''")
    h1, h2 = key(F.col("line"))
    return split.select(*more, h1.alias("h1"), h2.alias("h2"), F.length("line").alias("chars"))


def _small(df: DataFrame) -> bool:
    """Whether the checked number of rows is within the bound for a broadcast."""
    return df.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES


def among(rows: DataFrame, few: DataFrame, by: Column, how: str = "left_semi") -> DataFrame:
    """The rows whose (h1, h2) is in few, or rows joined with few; beyond a broadcast, a hash's rows are dealt by the column by."""
    if _small(few):
        return rows.join(F.broadcast(few), ["h1", "h2"], how)
    dealt = few.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(by, F.lit("salt")), F.lit(SALTS)).cast("int"))
    return salted.join(dealt, ["h1", "h2", "__salt"], how).drop("__salt")


def _site() -> Column:
    """A row's site; a null source is a site of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))


def boilerplate(docs: DataFrame, sites: int = SITES, margin: float = MARGIN) -> DataFrame:
    """(h1, h2) of the lines that stand on so many distinct sites."""
    lines = lines_of(docs.select("text", _site().alias("site")), "site")
    spread = lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.hll_sketch_agg("site", BITS).alias("sketch")).where(F.col("n") >= sites)
    found = spread.select("h1", "h2", F.hll_sketch_estimate("sketch").alias("estimate")).where(F.col("estimate") >= sites * (1 - margin))
    found = common.table(found, "spread")
    sure = found.where(F.col("estimate") > sites * (1 + margin)).select("h1", "h2")
    near = found.where(F.col("estimate") <= sites * (1 + margin)).select("h1", "h2")
    # A line's rows on a site become one before sites are counted.
    exact = among(lines, near, F.col("site")).groupBy("h1", "h2", "site").agg(F.count("*").alias("n"))
    exact = exact.groupBy("h1", "h2").agg(F.count("*").alias("sites")).where(F.col("sites") >= sites).select("h1", "h2")
    return common.table(sure.unionByName(exact), "boilerplate")


def copied(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """(h1, h2) of the whole texts that stand on so many distinct sites."""
    h1, h2 = key(F.col("text"))
    rows = docs.where("text <> ''").select(h1.alias("h1"), h2.alias("h2"), _site().alias("site"))
    spread = rows.groupBy("h1", "h2", "site").agg(F.count("*").alias("n")).groupBy("h1", "h2").agg(F.count("*").alias("sites"))
    return common.table(spread.where(F.col("sites") >= sites).select("h1", "h2"), "copied")


def clean(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """docs with text without boilerplate lines, and removed, the number of lines gone.

    A column n_chars follows the text, a column removed is replaced. Rows meet their
    hashes again by a hash of id and text, which spreads copies of one text.
    """
    docs = docs.drop("removed")
    bad = boilerplate(docs, sites)
    row = F.xxhash64(F.col("doc_id").cast("string"), F.col("text"))
    other = F.xxhash64(F.col("text"), F.col("doc_id").cast("string"))
    rows = docs.select("text", row.alias("__k1"), other.alias("__k2"))
    hit = among(lines_of(rows, "__k1", "__k2"), bad, F.col("__k1"))
    hit = hit.groupBy("__k1", "__k2").agg(F.collect_set(F.struct("h1", "h2")).alias("__bad"))
    joined = docs.withColumn("__k1", row).withColumn("__k2", other).join(hit, ["__k1", "__k2"], "left")
    parts = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("line"), trimmed(x).alias("t")))
    known = lambda t: F.array_contains(F.col("__bad"), F.struct(*[h.alias(n) for h, n in zip(key(t), ("h1", "h2"), strict=True)]))
    parts = F.transform(parts, lambda p: F.struct(p["line"].alias("line"), known(p["t"]).alias("bad")))
    some = joined.withColumn("__parts", F.when(F.col("__bad").isNotNull(), parts))
    h1, h2 = key(F.col("text"))
    whole = copied(docs, sites).withColumn("__copied", F.lit(True))
    inner = {c: f"__own_{c}" for c in docs.columns if c in ("h1", "h2")}  # the input's own columns of these names
    some = among(some.withColumnsRenamed(inner).withColumns({"h1": h1, "h2": h2}), whole, F.col("__k1"), "left").drop("h1", "h2")
    some = some.withColumnsRenamed({v: k for k, v in inner.items()})
    some = some.withColumn("__cut", F.col("__bad").isNotNull() & F.col("__copied").isNull())
    text = F.when(F.col("__cut"), F.array_join(F.transform(F.filter("__parts", lambda p: ~p["bad"]), lambda p: p["line"]), "\n")).otherwise(F.col("text"))
    removed = F.when(F.col("__cut"), F.size(F.filter("__parts", lambda p: p["bad"]))).otherwise(0)
    columns = [text.alias("text") if c == "text" else F.col(c) for c in docs.columns]
    out = some.select(*columns, removed.alias("removed"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return clean(docs).select("doc_id", "text", F.col("removed").cast("int").alias("removed"))


ORACLE_SQL = f"""
with docs as (select doc_id, text, coalesce('=' || source, 'null') as site from documents),
lines as (
  select doc_id, site, unnest(generate_series(1, len(string_split(text, chr(10))))) as place, unnest(string_split(text, chr(10))) as line
  from docs where text is not null
),
trimmed as (select *, trim(line, ' ' || chr(9) || chr(13)) as t from lines),
bad as (select t from trimmed where t <> '' group by t having count(distinct site) >= {SITES}),
marked as (select l.*, b.t is not null as is_bad from trimmed l left join bad b on l.t = b.t),
cut as (
  select doc_id, count(*) filter (where is_bad) as removed, string_agg(line, chr(10) order by place) filter (where not is_bad) as kept
  from marked group by doc_id
),
copied as (select text from documents where text <> '' group by text having count(distinct coalesce('=' || source, 'null')) >= {SITES})
select d.doc_id,
       case when c.removed > 0 and w.text is null then coalesce(c.kept, '') else d.text end as text,
       cast(case when w.text is null then coalesce(c.removed, 0) else 0 end as integer) as removed
from docs d left join cut c on d.doc_id = c.doc_id left join copied w on d.text = w.text
"""
