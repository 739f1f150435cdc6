"""Document fingerprints: threshold-scaled sketches, in SQL functions only.

A text's shingles are its runs of five words (the whole text, if shorter), hashed to 64
bits. The sketch keeps every hash below a fixed fraction of the range. The sketch of a
union is the union of sketches, so sketches merge, and the share of one sketch's hashes
found in another estimates containment between texts of very unequal length.

A text none of whose hashes is below the threshold keeps its least hash, so that no
text with a word has an empty sketch (merging drops such a hash again if any other
text has hashes below the threshold).

Likeness is containment of the smaller sketch in the larger one: equal texts have 1,
two texts without words have 1, a text without words and another have 0.

Defined results: a null text is an empty text. Rows of one doc_id are ordered by their
text; null doc_ids come first. The next document of the last is the first (for a
single row, itself). Further columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.llm import common

QUERY = "op1_fingerprints"

#: Words of a shingle, and the fraction of the hash range that a sketch keeps.
WORDS, FRACTION = 5, 1 / 8
#: Rows of a bucket of neighbouring ids aimed at; a window holds a bucket at a time, spilling to disk.
BUCKET_ROWS = 20_000


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def shingle_hashes(text: Column) -> Column:
    """Distinct 64-bit hashes of the shingles of a text, as an array of longs."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    several = lambda h: F.transform(
        F.slice(h, F.lit(1), F.size(h) - (WORDS - 1)), lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WORDS)])
    )
    return let(hashed, lambda h: F.when(F.size(h) >= WORDS, several(h)).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>")))


def _bound(fraction: float) -> int:
    """The hash below which the fraction of the signed range lies."""
    return min((1 << 63) - 1, -(1 << 63) + int(fraction * (1 << 64)))


def sketch(text: Column, fraction: float = FRACTION) -> Column:
    """The kept hashes of a text's shingles, sorted."""
    bound = F.lit(_bound(fraction))
    kept = let(shingle_hashes(text), lambda h: let(F.filter(h, lambda x: x < bound), lambda k: F.when((F.size(k) > 0) | (F.size(h) == 0), k).otherwise(F.array(F.array_min(h)))))
    return F.array_sort(F.array_distinct(kept))


def merged(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """Sketch of two texts' union, from their sketches."""
    bound = F.lit(_bound(fraction))
    both = F.array_union(a, b)
    return let(both, lambda u: let(F.filter(u, lambda x: x < bound), lambda k: F.array_sort(F.when((F.size(k) > 0) | (F.size(u) == 0), k).otherwise(F.array(F.array_min(u))))))


def likeness(a: Column, b: Column) -> Column:
    """Containment of the smaller sketch in the larger."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise((F.size(a) == F.size(b)).cast("double"))


def written(s: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(s, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def neighbours(docs: DataFrame):
    """docs (doc_id, text) dealt into buckets, and the window in which lead() finds the next document's values; the last's next is the first.

    Buckets of neighbouring ids are cut at quantiles that are ids themselves. Each
    bucket's first rows go to the bucket before it as well, so that a window inside
    each bucket finds every next row and no task sees all rows; copies have copy = 1.
    """
    spark = docs.sparkSession
    whole = docs.agg(F.count("*").alias("n"), F.min("doc_id").alias("least")).collect()[0]
    n = whole["n"]
    wanted = min(10_000, max(3 * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / BUCKET_ROWS)))
    wanted = max(1, min(wanted, n // 2))
    cuts: list[int] = []
    if wanted > 1 and whole["least"] is not None:
        found = docs.agg(F.percentile_approx("doc_id", [k / wanted for k in range(1, wanted)], 10 * wanted).alias("q")).collect()[0]["q"]
        cuts = sorted({q for q in found if q > whole["least"]})
    # A binary search of the cuts: bucket k holds ids from cut k - 1 on, nulls are in bucket 0.
    bucket = _bucket(F.col("doc_id"), cuts)
    last = len(cuts)
    first_ids = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<bigint>")
    is_first = F.col("doc_id").eqNullSafe(F.when(F.col("bucket") == 0, F.lit(whole["least"])).otherwise(F.get(first_ids, F.col("bucket") - 1)))
    # Of bucket 0 the nulls come first, if there are any.
    nulls = docs.where(F.col("doc_id").isNull()).limit(1).count() if n else 0
    if nulls:
        is_first = F.when(F.col("bucket") == 0, F.col("doc_id").isNull()).otherwise(is_first)
    before = F.when(F.col("bucket") == 0, F.lit(last)).otherwise(F.col("bucket") - 1)
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("copy"))
    copy = F.struct(before.alias("bucket"), F.lit(1).alias("copy"))
    dealt = docs.withColumn("bucket", bucket).withColumn("to", F.explode(F.when(is_first, F.array(own, copy)).otherwise(F.array(own))))
    dealt = dealt.select("doc_id", "text", F.col("to.bucket").alias("bucket"), F.col("to.copy").alias("copy")).repartition("bucket")
    return dealt, Window.partitionBy("bucket").orderBy("copy", "doc_id", "text")


def _bucket(id_: Column, cuts: list[int]) -> Column:
    """Number of cuts that are at most the id: a comparison tree of logarithmic depth."""
    if not cuts:
        return F.lit(0)
    array = F.array(*[F.lit(c) for c in cuts])

    def halve(span: int):
        return lambda p: F.when((p + span <= len(cuts)) & (F.get(array, p + (span - 1)) <= id_), p + span).otherwise(p)

    # The number of cuts up to the id, found bit by bit.
    place, span = F.lit(0), 1 << len(cuts).bit_length()
    while span := span >> 1:
        place = let(place, halve(span))
    return F.coalesce(F.when(id_.isNull(), F.lit(0)).otherwise(place), F.lit(0)).cast("int")


def fingerprint(docs: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, sketch, edited_sketch, near_edited, near_next) of every text."""
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    dealt, window = neighbours(source)
    own = dealt.withColumn("sketch", sketch(F.col("text"), fraction)).withColumn("n_chars", F.length("text").cast("long"))
    pairs = own.withColumn("next_text", F.lead("text").over(window)).withColumn("next_sketch", F.lead("sketch").over(window)).where("copy = 0")
    edited = F.expr("concat(left(text, cast(n_chars - n_chars div 4 as int)), left(next_text, cast(n_chars div 4 as int)))")
    pairs = pairs.select("doc_id", "n_chars", "sketch", "next_sketch", edited.alias("edited"))
    pairs = pairs.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).withColumn("edited_sketch", sketch(F.col("edited"), fraction))
    return pairs.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "sketch",
        "edited_sketch",
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprint(common.read(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        written(F.col("sketch")).alias("fingerprint"),
        written(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
