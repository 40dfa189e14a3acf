"""Small helpers of the operators: the shared folder, checked broadcasts, Arrow blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon import session

#: Rows up to which a narrow table (a few numbers a row) is sent to all executors.
BROADCAST_ROWS = 200_000

#: Bytes of text that one step of a task holds as arrays at a time.
BLOCK_BYTES = 1 << 21
BLOCK_ROWS = 1 << 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage by a written table in the folder of ``spark.checkpoint.dir``.

    Read again from its files, a table has its true size for Spark's choice of joins; the estimate of a
    checkpointed plan multiplies with every join of a loop.
    """
    return scratch_table(df, "step")


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when the counted rows stay below the limit; else Spark shuffles."""
    return F.broadcast(df) if rows <= limit else df


def once(df: DataFrame, keep, **columns) -> DataFrame:
    """The kept columns and new ones, which are computed once for each row.

    As generated columns they are neither copied into later expressions nor into filters that Spark
    moves or infers, where a lambda would work them out again for every element.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def packed(docs: DataFrame) -> DataFrame:
    """All columns as one struct ``row``, so that no name of the input meets one added later."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def without(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows whose key is not among ``gone`` (one narrow column); rows without a key stay."""
    gone = checkpoint(gone.toDF("gone").distinct())
    gone = broadcast_if_small(gone, gone.count())
    return packed(docs).join(gone, F.col("row")[key] == F.col("gone"), "left_anti").select("row.*")


def in_fold(doc_id, modulus: int, remainder: int):
    """Whether crc32 of the id as text has this remainder; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def text_blocks(batch: pa.RecordBatch, column: str = "text", limit: int = BLOCK_BYTES):
    """Slices of a batch whose text stays below the limit, or holds one row; 32,768 rows at most.

    Yields (slice, bytes of all texts as an array, row offsets into it). A null text is empty.
    """
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(max(end, at + 1), at + BLOCK_ROWS, len(texts))
        yield batch.slice(at, end - at), data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write as Parquet into the shared folder and read it again."""
    path = session.scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sampled(rows: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` rows at most, chosen by a hash of the key, to fit a classifier on."""
    total = rows.count()
    if total <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) < int((1 << 30) * most / total))
