"""Token counts (operator 1): separator scan of flat, unindexed token files.

Files hold fixed-width little-endian token ids one after another, each document ended by a
separator id, with no index.  Blocks of equal size are searched in parallel: the ids
of a block are one numpy array, compared with the separator at once.  A document that
crosses blocks is stitched by a prefix scan of per-block summaries (last separator,
separators so far), done in two levels so that no task holds all blocks of a large file.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.llm.common import cut, map_arrow, record_batch, shuffle_width, text_slices, texts_of
from lodestar.session import ensure_checkpoint_dir

BLOCK_TOKENS = 1 << 20     # tokens per block
GROUP_BLOCKS = 1024        # blocks per group of the scan
SLICE = 4 << 20


def write_flat(docs: DataFrame, folder: str, ranks: str, separator: int, width: int = 2, text_col: str = "text", pattern: str | None = None) -> None:
    """Tokenise whole texts with a tiktoken rank file and write flat token files.

    Spark's text writer ends every row with the separator's bytes, so a file is exactly
    ids and separators and a failed task leaves nothing behind.  Null texts are empty.
    """
    import public_tokenizers
    pattern = pattern or public_tokenizers.PATTERN
    kind = {2: "<u2", 4: "<u4"}[width]

    def run(batches):
        import base64
        import tiktoken
        with open(ranks, "rb") as f:
            table = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        encode = tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary
        for b in batches:
            col = b.column("text")
            for lo, hi in text_slices(col, SLICE):
                ids = [np.array(encode(t.decode("utf-8", "replace")), dtype=kind).tobytes() for t in texts_of(col.slice(lo, hi - lo))]
                yield record_batch(ids=pa.array(ids, pa.binary()))

    end = int(separator).to_bytes(width, "little").decode("latin-1")
    (map_arrow(docs.select(F.col(text_col).alias("text")), run, "ids binary").select(F.col("ids").cast("string").alias("value"))
     .write.option("lineSep", end).option("encoding", "ISO-8859-1").text(folder))


def _read(uri: str, start: int, size: int) -> bytes:
    """A byte range of a file, by the store that its URI names."""
    from urllib.parse import urlparse
    from pyarrow import fs
    at = urlparse(uri)
    store, path = (fs.LocalFileSystem(), at.path) if at.scheme in ("", "file") else fs.FileSystem.from_uri(uri.replace("s3a://", "s3://"))
    with store.open_input_file(path) as f:
        return f.read_at(size, start)


def blocks(spark: SparkSession, folder: str, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, block, start, tokens): the blocks of all files of a folder, from their sizes alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select(
        F.col("path").alias("file"), (F.col("length") / width).cast("long").alias("all"))
    per = F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("all") / block_tokens) - 1, F.lit(0).cast("long")))
    return files.select("file", "all", F.explode(per).alias("block")).select(
        "file", "block", (F.col("block") * block_tokens).alias("start"), F.least(F.lit(block_tokens), F.col("all") - F.col("block") * block_tokens).alias("tokens"),
        (F.col("block") == F.ceil(F.col("all") / block_tokens) - 1).alias("final")).where("tokens > 0")


def _searched(work: DataFrame, separator: int, width: int) -> DataFrame:
    """Every block with the positions (in the file) of its separators."""
    kind = {2: "<u2", 4: "<u4"}[width]

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = np.frombuffer(_read(r["file"], r["start"] * width, r["tokens"] * width), dtype=kind)
                if len(ids) != r["tokens"]:
                    raise OSError(f"{r['file']} is shorter than it was")
                ends = np.flatnonzero(ids == separator) + r["start"]
                yield record_batch(file=[r["file"]], block=[r["block"]], start=[r["start"]], tokens=[r["tokens"]], final=[r["final"]],
                                   ends=pa.array([ends], pa.list_(pa.int64())))

    return map_arrow(work, run, "file string, block long, start long, tokens long, final boolean, ends array<long>")


def _carried(found: DataFrame) -> DataFrame:
    """(file, block, since, before): where the block's first document starts and how many
    separators the file has before the block; the prefix scan over blocks."""
    part = found.select("file", "block", F.floor(F.col("block") / GROUP_BLOCKS).alias("grp"), F.size("ends").cast("long").alias("n"),
                        F.array_max("ends").alias("last"))
    inner = Window.partitionBy("file", "grp").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    near = part.select("file", "grp", "block", F.max("last").over(inner).alias("last_in"), F.coalesce(F.sum("n").over(inner), F.lit(0)).alias("n_in"))
    outer = Window.partitionBy("file").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    groups = part.groupBy("file", "grp").agg(F.max("last").alias("last"), F.sum("n").alias("n"))
    far = groups.select("file", "grp", F.max("last").over(outer).alias("last_out"), F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("n_out"))
    return near.join(far, ["file", "grp"]).select(
        "file", "block", (F.coalesce("last_in", "last_out", F.lit(-1)) + 1).alias("since"), (F.col("n_in") + F.col("n_out")).alias("before"))


def count_tokens(spark: SparkSession, folder: str, separator: int, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per document: file, doc (its number in the file, from 0), start (token), tokens
    (without the separator), ended.

    Two separators side by side hold an empty document.  Ids after the last separator are
    a document that is not ``ended``.  An empty file has none; bytes short of one id at
    a file's end are no token.
    """
    work = blocks(spark, folder, width, block_tokens)
    found = cut(_searched(work.repartition("file", "block"), separator, width))
    full = found.join(_carried(found), ["file", "block"]).repartition(shuffle_width(spark), "file", "block")  # packed blocks unfold into many rows
    starts = F.concat(F.array("since"), F.transform("ends", lambda e: e + 1))
    stops = F.when(F.col("final") & (F.element_at(starts, -1) < F.col("start") + F.col("tokens")),
                   F.concat("ends", F.array(F.col("start") + F.col("tokens")))).otherwise(F.col("ends"))
    docs = F.arrays_zip(F.slice(starts, F.lit(1), F.size(stops)).alias("start"), stops.alias("stop"))
    narrow = full.select("file", "before", F.size("ends").alias("n"), docs.alias("docs"))  # no array stands beside the unfolded rows
    return narrow.select("file", "before", "n", F.posexplode("docs").alias("k", "own")).select(
        "file", (F.col("before") + F.col("k")).alias("doc"), F.col("own.start").alias("start"),
        (F.col("own.stop") - F.col("own.start")).alias("tokens"), (F.col("k") < F.col("n")).alias("ended"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's name in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4()}"
