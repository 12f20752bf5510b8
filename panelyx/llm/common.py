"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zlib

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word separators everywhere in this subpackage: space and the controls \x09-\x0D.
WHITE = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_checkpoints(spark: SparkSession) -> None:
    """Use the folder that the session names in spark.checkpoint.dir; a temporary one where none is set and all runs on one machine."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))


def opened(address: str) -> tuple[pafs.FileSystem, str]:
    """The store that an address names, and the path there."""
    return pafs.FileSystem.from_uri(address if "://" in address else address.replace("file:", "file://", 1) if address.startswith("file:") else f"file://{address}")


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from there."""
    shared_checkpoints(df.sparkSession)
    return df.checkpoint()


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Keep Arrow batches of whole texts small, so that Python workers hold few long documents at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without_white(text: Column) -> Column:
    """text without word separators; chained byte searches are far cheaper than a pattern."""
    for c in WHITE:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo modulus."""
    return F.crc32(doc_id.cast("string")).cast("long") % modulus


def words_of(text: str | None) -> list[bytes]:
    """bytes.split() cuts at exactly the six characters of WHITE."""
    return (text or "").encode("utf-8", "surrogatepass").split()


UPPER = bytes(range(65, 91))
LOWER_ASCII = bytes.maketrans(UPPER, bytes(range(97, 123)))


def lower_words_of(text: str | None) -> list[bytes]:
    """Words after lower-casing A-Z only."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER_ASCII).split()


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two multiplications, three shifts)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def word_codes32(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
