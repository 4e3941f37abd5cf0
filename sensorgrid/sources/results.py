"""Score-table (result CSV) sources and sinks.

A results folder holds one CSV table per suite, each with its own columns.
Tables are listed on the driver (file names only, through the Hadoop
FileSystem API, so any cluster filesystem works) and read by one text scan,
each line under its own file's header, then normalised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorgrid.operators.leaderboard import SCORE_COLS, TUNED_PATTERNS, contains_any, normalize_scores
from sensorgrid.session import cut_lineage

SKIP_NAME = "tuned_tree_results"  # fixed value: file-name marker of tuned tables, skipped by the merge


def path_exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def list_tables(spark: SparkSession, folder: str, suffix: str = ".csv") -> list[str]:
    """Sorted paths of entries under ``folder`` whose name ends with ``suffix``."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if name.endswith(suffix) and not name.startswith(("_", ".")):
            out.append(st.getPath().toString())
    return sorted(out)


BOM = "\ufeff"


def read_csv_table(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with every column as string (types are applied by ``normalize_scores``).
    A UTF-8 byte-order mark on the first header name is dropped."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    if df.columns and df.columns[0].startswith(BOM):
        df = df.withColumnRenamed(df.columns[0], df.columns[0][len(BOM):])
    return df


#: Files up to which their header lines are broadcast (some hundred bytes each).
BROADCAST_FILES = 100_000


def _csv_fields(line, n: int):
    """The fields of a CSV line as an array of ``n`` strings (missing ones NULL)."""
    row = F.from_csv(line, ", ".join(f"c{i} string" for i in range(n)))
    return F.array(*[row.getField(f"c{i}") for i in range(n)])


def scan_tables(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    """(rows, headers) = ((__file, __names, __values), (__file, __names)): the lines of many header CSV files with unlike columns, in one
    plan: one text scan, every line beside its own file's header. A first job over the same scan
    finds each file's header (its first line that is not blank) and the widest one."""
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__row"), F.regexp_replace("value", f"^{BOM}", "").alias("value"))
    lines = lines.where(F.trim("value") != "")
    heads = cut_lineage(lines.groupBy("__file").agg(F.min_by("value", F.struct("__start", "__row")).alias("__head")))
    # every comma counts, so quoted ones only add fields that stay empty
    width, files = heads.agg(F.max(F.length("__head") - F.length(F.replace("__head", F.lit(","), F.lit(""))) + 1), F.count("*")).first()
    width = width or 1
    names = heads.select("__file", "__head", _csv_fields(F.col("__head"), width).alias("__names"))
    beside = F.broadcast(names) if files <= BROADCAST_FILES else names
    rows = (lines.join(beside, "__file").where(F.col("value") != F.col("__head"))
            .select("__file", "__names", _csv_fields(F.col("value"), width).alias("__values")))
    return rows, names.select("__file", "__names")


def _named(*names):
    """The value under the first of ``names`` that the line's header has, else NULL."""
    out = F.lit(None).cast("string")
    for n in reversed(names):
        at = F.array_position("__names", F.lit(n)).cast("int")
        out = F.when(at > 0, F.get("__values", at - 1)).otherwise(out)
    return out


#: Other headings a required column may have (fixed values).
OTHER_NAMES = {"MAPE(%)": ("MAPE",), "horizon_h": ("horizon",)}


def read_result_tables(spark: SparkSession, folder: str, required=SCORE_COLS, skip_name: str = SKIP_NAME,
                       keep_extra=("run_id",), missing: str = "null") -> DataFrame:
    """Union of every usable results table in ``folder``, as one scan however many tables there are.

    * files whose name contains ``skip_name`` are skipped;
    * a table lacking a required column after renaming gets it as NULL (``missing="null"``,
      the merge's rule) or is skipped (``missing="skip"``, the report readers' rule);
    * a column of ``keep_extra`` that no table has is left out;
    * rows without model / pollutant / horizon_h / R2 are dropped;
    * rows whose model name contains 'tuned' are dropped.
    """
    paths = [p for p in list_tables(spark, folder) if not (skip_name and skip_name in p.rsplit("/", 1)[-1])]
    if not paths:
        raise RuntimeError(f"no usable result tables under {folder}")
    rows, heads = scan_tables(spark, paths)
    has = lambda c: F.arrays_overlap("__names", F.array(*[F.lit(n) for n in (c, *OTHER_NAMES.get(c, ()))]))
    if missing == "skip":
        whole = F.coalesce(F.array_min(F.array(*[F.coalesce(has(c), F.lit(False)) for c in required])), F.lit(True))
        rows, heads = rows.where(whole), heads.where(whole)
    found = heads.agg(F.count("*").alias("n"), *[F.bool_or(F.coalesce(has(c), F.lit(False))).alias(f"e{i}") for i, c in enumerate(keep_extra)]).first()
    if missing == "skip" and not found["n"]:
        raise RuntimeError(f"no usable result tables under {folder}")
    extra = [c for i, c in enumerate(keep_extra) if found[f"e{i}"]]
    out = normalize_scores(rows.select(*[_named(c, *OTHER_NAMES.get(c, ())).alias(c) for c in [*required, *extra]]), required)
    if "run_id" in out.columns:
        out = out.withColumn("run_id", F.col("run_id").try_cast("bigint"))
    out = out.where(F.col("model").isNotNull() & F.col("pollutant").isNotNull() & F.col("horizon_h").isNotNull()
                    & F.col("R2").isNotNull())
    return out.where(~contains_any("model", TUNED_PATTERNS))


def write_result_table(df: DataFrame, path: str, mode: str = "overwrite", bom: bool = False) -> str:
    """CSV sink with a header row.

    ``bom=True`` writes the 'utf-8-sig' layout: one file whose header starts with a
    byte-order mark (for spreadsheet tools). Use it only for small report tables — it
    funnels the table into a single writer task."""
    if bom:
        first = df.columns[0]
        df = df.withColumnRenamed(first, BOM + first).coalesce(1)
    df.write.mode(mode).option("header", True).csv(path)
    return path
