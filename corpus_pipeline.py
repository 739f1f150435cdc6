"""The corpus pipeline: five of the operators, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import common, lines, neardup, packing, quality, toxicity


def _columns(df: DataFrame) -> DataFrame:
    """The columns of documents."""
    return df.select("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    docs = _columns(docs)
    net = toxicity.learn(docs, toxicity.train_labels(spark, sf_dir))
    kept = toxicity.score(docs, net, keep=tuple(docs.columns))
    return _columns(kept.where(F.col("score") < 0.5))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    docs = _columns(docs)
    model = quality.fit_texts(docs, quality.train_labels(spark, sf_dir))
    return _columns(quality.score_texts(docs, model).where(F.col("score") >= quality.THRESHOLD))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand on many sites, however many of a document's they are."""
    return lines.clean(_columns(docs)).drop("removed")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return neardup.deduplicate(_columns(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    import public_tokenizers

    return packing.digest(packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

#: The network, the discriminant, the alignment and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each writes its result, which the next reads."""
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
