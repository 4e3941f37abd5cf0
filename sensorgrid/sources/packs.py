"""Feature-pack sink/source: parquet partitioned by split, plus integrity checks.

``split`` is a partition column, so ``load_pack(split='train')`` reads only
the train folder (partition pruning) instead of reading everything and
selecting row positions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sensorgrid.operators.common import q

PACK_KINDS = ("trees", "nn")


SPLITS = ("train", "val", "test", None)


def write_pack(df: DataFrame, base: str, kind: str = "trees", mode: str = "overwrite",
               split_col: str = "split", cluster_by=(), row_group_bytes: int | None = None) -> str:
    """Write one pack (``trees`` raw scale or ``nn`` standardised) under ``base/features/<kind>``.

    Rows without a split are written to the ``__HIVE_DEFAULT_PARTITION__`` folder
    and never returned by ``load_pack(split=...)``.

    ``cluster_by`` (series and time, say) deals the rows by ranges of these columns and sorts them, so
    that a file and each of its row groups covers a narrow range: reads of a few series or weeks skip the
    rest by the footers' minima and maxima. It costs a shuffle, and one more run of ``df``'s plan for
    the range bounds: give it a written table. ``row_group_bytes`` sets the size of the row groups.
    """
    path = f"{base.rstrip('/')}/features/{kind}"
    if cluster_by:
        order = [q(split_col), *[q(c) for c in cluster_by]]
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    w = df.write.mode(mode).partitionBy(split_col)
    if row_group_bytes:
        w = w.option("parquet.block.size", row_group_bytes)
    w.parquet(path)
    return path


@dataclass
class PackReport:
    """What a written pack holds, counted by the job that wrote it: split -> (rows, rows with a
    missing feature, bad labels)."""
    path: str
    by_split: dict

    @property
    def rows(self) -> int:
        return sum(n for n, _, _ in self.by_split.values())

    def as_frame(self, spark: SparkSession) -> DataFrame:
        """As :func:`validate_pack` has it."""
        return spark.createDataFrame([(s, *counts) for s, counts in self.by_split.items()],
                                     "split string, n_rows long, n_bad_feature_rows long, n_bad_labels long")

    def require(self) -> "PackReport":
        """Raise for an empty pack, missing features or bad labels."""
        if not self.rows:
            raise RuntimeError(f"{self.path}: no rows")
        bad = {s: c for s, c in self.by_split.items() if c[1] or c[2]}
        if bad:
            raise RuntimeError(f"{self.path}: (rows, rows with a missing feature, bad labels) by split: {bad}")
        return self


def write_checked_pack(df: DataFrame, base: str, features, kind: str = "trees", label: str | None = "target_cls", split_col: str = "split",
                       splits=SPLITS, n_classes: int = 3, **how) -> PackReport:
    """:func:`write_pack`, with :func:`validate_pack`'s counts as metrics of the writing job itself, so
    that nothing is read again. ``splits`` are the splits that may occur; rows of any other one raise
    once they are written. Without a ``label`` no labels are bad."""
    bad_feature, bad_label = _bad_rows(features, label, n_classes)
    seen = Observation()
    counts = []
    for i, s in enumerate(splits):
        here = q(split_col).eqNullSafe(F.lit(s))
        counts += [F.count_if(here).alias(f"n{i}"), F.count_if(here & bad_feature).alias(f"f{i}"), F.count_if(here & bad_label).alias(f"l{i}")]
    path = write_pack(df.observe(seen, F.count(F.lit(1)).alias("n"), *counts), base, kind, split_col=split_col, **how)
    got = seen.get
    report = PackReport(path, {s: (got[f"n{i}"], got[f"f{i}"], got[f"l{i}"]) for i, s in enumerate(splits) if got[f"n{i}"]})
    if report.rows != got["n"]:
        raise RuntimeError(f"{path}: {got['n'] - report.rows} rows of a split other than {', '.join(map(str, splits))}")
    return report


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def load_pack(spark: SparkSession, base: str, kind: str = "trees", split: str | None = "train",
              columns=None, split_col: str = "split", entities=None, start=None, end=None, key: str = "entity_id", ts: str = "ts") -> DataFrame:
    """Rows of one split (pruned at the folder level), optionally only some columns, some series
    (``entities``) and the time from ``start`` up to before ``end``: plain comparisons, which reach the
    scan and skip row groups of a clustered pack."""
    if kind not in PACK_KINDS:
        raise ValueError(f"pack must be one of {PACK_KINDS}")
    df = spark.read.parquet(f"{base.rstrip('/')}/features/{kind}")
    if split is not None:
        df = df.where(q(split_col) == split)
    if entities is not None:
        df = df.where(q(key).isin(list(entities)))
    if start is not None:
        df = df.where(q(ts) >= F.lit(start))
    if end is not None:
        df = df.where(q(ts) < F.lit(end))
    if columns:
        df = df.select(*[q(c) for c in columns])
    return df


def check_pack(df: DataFrame, name: str, required=()) -> int:
    """Schema has the required columns and the frame is not empty (one job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise RuntimeError(f"{name}: missing columns {missing}")
    n = df.limit(1).count()
    if n == 0:
        raise RuntimeError(f"{name}: no rows")
    return n


def _bad_rows(features, label: str | None, n_classes: int):
    """Whether a row has a NULL/NaN feature, and whether its label is outside 0..n-1 or NULL."""
    bad_feat = F.lit(False)
    for c in features:
        x = q(c).cast("double")
        bad_feat = bad_feat | x.isNull() | F.isnan(x)
    bad_lab = F.lit(False) if label is None else q(label).isNull() | (q(label) < 0) | (q(label) >= n_classes)
    return bad_feat, bad_lab


def validate_pack(df: DataFrame, features, label: str = "target_cls", by="split", n_classes: int = 3) -> DataFrame:
    """Per split: rows, rows with a NULL/NaN feature, rows with a label outside 0..n-1 or NULL.

    One aggregation pass; callers raise when a count is non-zero.
    """
    bad_feat, bad_lab = _bad_rows(features, label, n_classes)
    return df.groupBy(q(by)).agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.count_if(bad_feat).alias("n_bad_feature_rows"),
                                 F.count_if(bad_lab).alias("n_bad_labels"))
