"""Header-less delimited scans with declared schemas.

The reference reads tab/comma separated files without headers, attaches names
from a side file or a literal list, drops one row by 1-based position and
splits each record into an input vector and a label vector.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.ranking import with_line_numbers

# Column layout of the steel-plates faults file (27 inputs then
# 7 one-hot fault labels) and of the letter-recognition file.
FAULT_LABELS = ["Pastry", "Z_Scratch", "K_Scatch", "Stains", "Dirtiness", "Bumps",
                "Other_Faults"]
FAULT_INT_INPUTS = 14  # the first 14 inputs are integers, the other 13 doubles
LETTERS_NAMES = ["Letter", "Xbox", "Ybox", "Width", "Height", "OnPix", "Xbar", "Ybar",
                 "X2bar", "Y2bar", "XYbar", "X2Ybar", "XY2bar", "Xedge", "XedgeXY",
                 "Yedge", "YedgeYX"]
FAULTS_OUTLIER_ROW = 392


def read_names(spark: SparkSession, path: str) -> list[str]:
    """Column names, one per line (S2). ``read.text`` strips CR/LF.

    A names file has one line per column, so it is small by construction.
    """
    rows = with_line_numbers(spark.read.text(path), name="pos").orderBy("pos").collect()
    return [r["value"].strip() for r in rows if r["value"].strip()]


def schema_of(names: Sequence[str], types: Sequence[T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in zip(names, types)])


def read_headerless(spark: SparkSession, path: str, sep: str, schema: T.StructType,
                    with_ids: bool = True) -> DataFrame:
    """Headerless scan with a declared schema (S1, S3); ``id`` = 1-based line number.

    Line numbers follow the file order (paths ascending, then lines): counts per
    split give its offset, so no row ever leaves its task.
    """
    df = spark.read.csv(path, sep=sep, header=False, schema=schema, mode="FAILFAST")
    if not with_ids:
        return df
    return with_line_numbers(df)


def faults_schema(names: Sequence[str]) -> T.StructType:
    types = ([T.IntegerType()] * FAULT_INT_INPUTS +
             [T.DoubleType()] * (27 - FAULT_INT_INPUTS) + [T.IntegerType()] * 7)
    return schema_of(names, types)


def read_faults(spark: SparkSession, data_path: str, names_path: str,
                drop_row: int | None = FAULTS_OUTLIER_ROW) -> DataFrame:
    """Steel faults → ``(id, <34 named columns>)`` minus the outlier row."""
    names = read_names(spark, names_path)
    df = read_headerless(spark, data_path, "\t", faults_schema(names))
    if drop_row is not None:
        df = df.filter(F.col("id") != drop_row)
    return df


def split_inputs_labels(df: DataFrame, inputs: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Record → (id, x ARRAY<DOUBLE>, y ARRAY<DOUBLE>)."""
    return df.select("id", F.array(*[F.col(c).cast("double") for c in inputs]).alias("x"),
                     F.array(*[F.col(c).cast("double") for c in labels]).alias("y"))


def faults_features(df: DataFrame) -> DataFrame:
    """Faults frame → Features(id, x, label) with the one-hot labels decoded."""
    inputs = [c for c in df.columns if c != "id" and c not in FAULT_LABELS]
    s = split_inputs_labels(df, inputs, FAULT_LABELS)
    names = F.array(*[F.lit(n) for n in FAULT_LABELS])
    return s.select("id", "x", F.element_at(names, F.array_position("y", 1.0).cast("int"))
                    .alias("label"))


def letters_schema() -> T.StructType:
    return schema_of(LETTERS_NAMES, [T.StringType()] + [T.IntegerType()] * 16)


def read_letters(spark: SparkSession, path: str) -> DataFrame:
    """Letter recognition CSV with literal names (S3)."""
    return read_headerless(spark, path, ",", letters_schema())


def letters_features(df: DataFrame) -> DataFrame:
    return df.select("id", F.array(*[F.col(c).cast("double") for c in LETTERS_NAMES[1:]])
                     .alias("x"), F.col("Letter").alias("label"))


def read_space_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Space-separated numeric rows → (id, x) (F5: split + numeric parse)."""
    lines = with_line_numbers(spark.read.text(path))
    return (lines.filter(F.length(F.trim("value")) > 0)
            .select("id", F.split(F.trim("value"), r"\s+").cast("array<double>").alias("x")))


def number_at(c, start: int, length: int):
    """The integer written at 1-based position ``start`` of a text column (F2 substring,
    F3 string to int); null when those characters are no integer."""
    return F.substring(c, start, length).try_cast("int")


def materialize(df: DataFrame) -> tuple[DataFrame, int]:
    """Persist and count in one pass."""
    from pyspark import StorageLevel
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    return df, df.count()
