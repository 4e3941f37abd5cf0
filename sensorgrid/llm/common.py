"""Shared helpers of the training-data operators: columns, digests, shared-folder tables.

Conventions used by every operator here:

- internal columns start with ``__llm_`` and never reach a result; an operator's own output
  columns replace input columns of the same name;
- a row is identified by a 128-bit digest of its id and its text (:func:`with_row_key`), so
  null and repeated ids need no special case: identical rows share a key, and every operator
  treats what it knows about a key as a set;
- lineage is cut by tables written to the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorgrid.session import ensure_checkpoint_dir, scratch_path

#: ASCII white space: the separators between words in most contracts.
WS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["__llm_k1", "__llm_k2"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stash(df: DataFrame, name: str, *partition_by: str, large_rows: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later jobs start from files that
    every executor reads, so a lost executor costs a re-read and not a recomputation.
    ``large_rows``: rows of a megabyte or so; row groups, which readers hold, then end in time."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, f"llm-{name}")
    w = df.write.mode("error").option("compression", "zstd")
    if large_rows:
        w = w.option("parquet.block.size", str(32 << 20)).option("parquet.page.size.row.check.min", "1")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character kept (``lower`` would fold all of Unicode)."""
    return F.translate(c, UPPER, LOWER)


def text_of(c: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(c), F.lit(""))


def word_count(c: Column) -> Column:
    """Number of runs of characters that are not ASCII white space."""
    parts = F.split(c, WS + "+")
    head = (F.element_at(parts, 1) == "").cast("long")
    tail = ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("long")
    return F.size(parts).cast("long") - head - tail


def with_row_key(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two 64-bit digests of (id, text). Equal rows share them; others never do in practice."""
    return df.withColumns({KEY[0]: F.xxhash64(F.col(id_col), F.col(text_col)),
                           KEY[1]: F.xxhash64(F.lit(7), F.col(text_col), F.col(id_col))})


def pack_hash(df: DataFrame) -> Column:
    """Digest of every hashable column: the last tie-break between rows."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields
                        if "map" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()])


def small_batches(spark: SparkSession, rows: int = 512, size: int = 32 << 20) -> None:
    """Bound what one Arrow batch of whole texts holds, in rows and in bytes. For frames that are
    returned and run later, so the session keeps the settings; tighter ones of its own stay."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        own = spark.conf.get(key)
        now = int(own) if own.isdigit() else None
        if now is None or not 0 < now <= most:
            spark.conf.set(key, str(most))


@contextmanager
def batches_of(spark: SparkSession, size: int = 32 << 20):
    """Around a job that runs inside: an Arrow batch ends once it holds ``size`` bytes, however
    long its texts are. The session's own setting comes back afterwards."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def utf8(column) -> list:
    """An Arrow string column as a list of UTF-8 bytes; null as empty."""
    import pyarrow as pa
    return [b"" if x is None else x for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]
