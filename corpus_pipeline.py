"""Documents to training batches: quality rules, near-dedup, personal data, mixture, packing.

Every stage takes all rows that the one before it kept, and returns the columns of ``documents``; the
last returns the batches. A null or empty text fails the quality rules. An extra column of any name
goes through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.files import remove
from contrail.llm import mixing, packing, pii
from contrail.llm.common import fresh, table
from contrail.llm.near_dedup import groups
from contrail.llm.quality_rules import quality_rules
from contrail.scratch import materialise, new_path, temporary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality rules pass."""
    verdict = fresh(docs, "quality")
    return quality_rules(docs).filter(F.col(f"{verdict}.kept")).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies, the one of the least id; a row without an id comes
    after all others. The verdict is on rows: of two texts with one id each goes or stays by its own
    group, and of rows that repeat an id and a text one stays. Texts without a word have no group."""
    missing, number, digest = (fresh(docs, c) for c in ("missing_id", "number", "digest"))
    text = F.md5(F.coalesce(F.col("text"), F.lit("")))
    marked = docs.withColumns(
        {
            missing: F.col("doc_id").isNull(),
            digest: text,
            # Stands for an id that is missing. It need not be unique, for rows are told by all three.
            number: F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)),
        }
    )
    row = [missing, number, digest]
    found = groups(marked.select(F.col(number).alias("doc_id"), "text", missing, digest), [missing, digest])
    found = materialise(found.withColumnRenamed("doc_id", number), "groups")
    best = found.filter("`group` IS NOT NULL").groupBy("group").agg(F.min(F.struct(*row)).alias("row"))
    kept = best.select("row.*").union(found.filter("`group` IS NULL").select(row)).distinct()
    return marked.dropDuplicates(row).join(kept, row, "left_semi").select(docs.columns)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; ``n_chars`` follows where a text changed."""
    model = pii.train(docs)
    before = fresh(docs, "before")
    clean = pii.redact(docs.withColumn(before, F.col("text")), model)
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    same = F.col("text").eqNullSafe(F.col(before))
    changed = clean.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(length))
    return changed.select(docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents by probabilities raked to the target shares."""
    chosen = fresh(docs, "mixing")
    return mixing.mix(docs).filter(F.col(f"{chosen}.sampled")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("quality rules", quality),
    ("near-dedup", one_of_each),
    ("personal data", private),
    ("mixture", mixture),
    ("packing", packed),
]

# MinHash links and learned spans have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage is written and read again. What a stage has written on its way, and the rows that
    it started from, are removed once its result is written; only the last result stays, also after
    a failure, which leaves that of the stage before."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        label = name.replace(" ", "-")
        path = new_path(spark, label)
        with temporary(spark):
            docs = materialise(stage(spark, docs, sf_dir), label, path=path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
