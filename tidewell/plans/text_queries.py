"""Queries over locations and texts, with their DuckDB SQL where RE2 can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import geo, textscore
from tidewell.plans.tables import read

#: (location, countries)
PLACES = (
    ("Remote (British Columbia, CA)", "Canada"),
    ("ON, CA", "Canada"),
    ("Poland, OH", "United States"),
    ("Sydney, New South Wales, Australia", "Australia"),
    ("US-NY-Malta", "United States"),
    ("CA-SK-Saskatoon", "Canada"),
    ("Albuquerque, New Mexico", "United States"),
    ("Berlin, Germany; Paris, France", "France|Germany"),
    ("Prague, Czechia", "Czech Republic"),
    ("Ontario, California", "United States"),
    ("join us in the uk", ""),
    ("London, UK", "United Kingdom"),
    ("Austin, TX", "United States"),
    ("Wilmington, DE", ""),
    ("Remote", ""),
    ("Lagos, Nigeria | Nairobi, Kenya", "Kenya|Nigeria"),
    ("Hartford, New England", "United States"),
)


def country_extract(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.createDataFrame([(p,) for p, _ in PLACES], "place string")
    return rows.select("place", F.array_join(geo.extract_countries("place"), "|").alias("countries"))


COUNTRIES = "select place, countries from (values " + ", ".join(f"('{p}', '{c}')" for p, c in PLACES) + ") v(place, countries)"


def continents(spark: SparkSession, d: str) -> DataFrame:
    """Continents of nations; names that are no country's have none."""
    found = geo.extract_countries(F.initcap("n_name"))
    return read(spark, d, "nation").select("n_nationkey", F.array_join(geo.continents(found), "|").alias("continents"))


NATIONS = (
    "select n_nationkey, coalesce(c, '') as continents from nation left join (values "
    + ", ".join(f"('{k.lower()}', '{v}')" for k, v in geo.CONTINENT_OF.items())
    + ") v(n, c) on lower(n_name) = n"
)


def jd_score(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.round(textscore.jd_score(F.col("text")), 6).alias("score"), textscore.is_job_description(F.col("text")).alias("is_jd"))


def hiring_vocab(spark: SparkSession, d: str) -> DataFrame:
    """Conversations and part names with words of work put in."""
    rows = read(spark, d, "part").select("p_partkey", F.concat_ws(" ", F.lit("we"), "p_name", F.when(F.col("p_size") % 3 == 0, "Careers and jobs").when(F.col("p_size") % 3 == 1, "Now Hiring").otherwise("career career")).alias("text"))
    return rows.select("p_partkey", textscore.has_hiring_words(F.col("text")).alias("hiring"))


HIRING = "select p_partkey, p_size % 3 <> 2 as hiring from part"


def closed_posting(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", F.when(F.col("p_size") % 4 == 0, "This position has been filled").when(F.col("p_size") % 4 == 1, "no longer accepting applications").otherwise("open")).alias("text"))
    return rows.select("p_partkey", textscore.is_closed(F.col("text")).alias("closed"))


CLOSED = "select p_partkey, p_size % 4 < 2 as closed from part"


def size_and_salary(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part")
    size = textscore.size_floor(F.concat(F.lit("1,"), F.lpad(F.col("p_size").cast("string"), 3, "0"), F.lit("-5,000 employees")))
    pay = textscore.salary(F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")), F.when(F.col("p_size") % 3 == 0, F.col("p_partkey").cast("string")), F.lit("EUR"), F.when(F.col("p_size") % 5 == 0, "year"))
    return p.select("p_partkey", size.alias("size_floor"), pay.alias("salary"))


SIZES = """select p_partkey, cast(1000 + p_size as integer) as size_floor, case when p_size % 2 <> 0 and p_size % 3 <> 0 then '' else
  case when p_size % 2 = 0 then cast(p_size as varchar) else '?' end || '-' || case when p_size % 3 = 0 then cast(p_partkey as varchar) else '?' end || ' EUR' || case when p_size % 5 = 0 then ' year' else '' end end as salary from part"""


def quality_index(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem")
    signs = {"org_schema": F.col("l_quantity") > 25, "corp_links": F.col("l_discount") > 0.05, "martech": F.col("l_tax") > 0.04, "compliance": F.col("l_returnflag") == "R"}
    points, names = textscore.quality_index(signs)
    return li.select("l_orderkey", "l_linenumber", points.alias("points"), F.array_join(names, ",").alias("signs"), (points >= textscore.QUALITY_ENOUGH).alias("enough"))


QUALITY = """select l_orderkey, l_linenumber, points, signs, points >= 35 as enough from (select l_orderkey, l_linenumber,
  cast(case when l_quantity > 25 then 15 else 0 end + case when l_discount > 0.05 then 15 else 0 end + case when l_tax > 0.04 then 15 else 0 end + case when l_returnflag = 'R' then 5 else 0 end as integer) as points,
  concat_ws(',', case when l_quantity > 25 then 'org_schema' end, case when l_discount > 0.05 then 'corp_links' end, case when l_tax > 0.04 then 'martech' end, case when l_returnflag = 'R' then 'compliance' end) as signs from lineitem)"""

QUERIES = {
    "country_extract": (country_extract, COUNTRIES.replace("Cote d'Ivoire", "Cote d''Ivoire")),
    "continents": (continents, NATIONS),
    "jd_score": (jd_score, None),
    "hiring_vocab": (hiring_vocab, HIRING),
    "closed_posting": (closed_posting, CLOSED),
    "size_and_salary": (size_and_salary, SIZES),
    "quality_index": (quality_index, QUALITY),
}
