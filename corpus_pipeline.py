"""A training corpus from ``documents``: five stages, each one operator of ``lodestar.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's result as Parquet in the shared checkpoint folder and reads it as the next stage's
``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import pattern_packing, secret_scan, simhash_vp, string_tiling, toxicity
from lodestar.llm.common import cut, key_filter, table, unused
from lodestar.llm.queries import word_tokenizer
from lodestar.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, fitted on the labelled ones, does not call toxic.  Rows are judged by their
    text alone: null and empty texts carry no sign and stay, repeated rows stay or go together, null ids are no matter."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash neighbours: the one that names the component.

    A row takes part under its id.  Rows without an id, and all rows of an id that stands
    on several, take part under a stand-in made from id and text, larger than real ids:
    rows with equal id and text are copies of each other, different texts of one id are
    documents of their own.  Null and empty texts have a fingerprint like any other.  The texts of
    documents that stay are not moved: a filter on the keys that go leaves those alone for an exact join.
    """
    key = unused(docs, "_key")
    repeated = cut(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 and doc_id is not null").select(F.col("doc_id").alias(key)))
    own, keyed = F.col("doc_id"), docs
    if not repeated.isEmpty():
        keyed = docs.join(repeated, docs.doc_id == repeated[key], "left")
        own = F.when(F.col(key).isNull(), F.col("doc_id"))
    stand_in = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2) + F.lit(1 << 62)
    keyed = keyed.withColumn(key, F.coalesce(own, stand_in))
    found = simhash_vp.near_duplicates(keyed, id_col=key, shingle=3, max_bits=2)
    first = (F.col("doc_id") == F.col("component_id"))
    # keys that go, and keys whose rows are copies of each other: few against those that just stay
    marked = cut(found.groupBy("doc_id").agg(F.count("*").alias("n"), F.bool_and(first).alias("first"))
                 .where("n > 1 or not first").select(F.col("doc_id").alias(key), "first"))
    if marked.isEmpty():
        return docs
    likely = key_filter(marked, key)
    stay, look = keyed.where(~likely(F.col(key))), keyed.where(likely(F.col(key)))  # only the latter are shuffled
    out = stay.union(look.join(marked, key, "left_anti").select(*stay.columns))
    copies = marked.where("first").select(key)
    if not copies.isEmpty():
        out = out.union(look.join(copies, key, "left_semi").select(*stay.columns).dropDuplicates([key, "doc_id", "text"]))
    return out.select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.  Rows are judged by their text alone: null and empty texts stay, repeated
    rows stay or go together, null ids are no matter; an empty benchmark removes nothing."""
    return string_tiling.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mask and ``n_chars`` counted anew where a text changed; null and
    empty texts, repeated rows and null ids stay as they are."""
    return secret_scan.redact(docs, secret_scan.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens; a null or empty text is one piece (its end token),
    repeated rows and null ids are packed row by row."""
    return pattern_packing.pack(docs, word_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack),
]

#: The trained models, Karp-Rabin tiling and tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
