"""Quality classifier: histogram gradient-boosted trees over document statistics.

:func:`statistics` turns a whole text into a fixed row of numbers, :class:`Boosted` bins them
by quantiles, grows depth-wise trees from gradient histograms and flattens all trees into five
arrays, which are traversed for all rows and trees at once in numpy.

The fit takes at most :data:`FIT_ROWS` labelled rows, those of smallest id digest, and never
one whose crc32(doc_id as text) mod 3 is 1: these are held out. Only statistics of the text
are inputs.

Scale: the fit's sample is bounded (its labels, 16 bytes a row, are broadcast to the texts;
its statistics, 20 numbers a row, come to the driver). Scoring is one pass without a shuffle;
a task sends nothing but its rows.

Defined cases: null or empty text scores by its statistics, all zero; null labels or ids are
not learned from; without both labels the score is the share of label 1, or 0.5; a null
doc_id is not held out; repeated rows score alike; very long texts are counted whole; an empty table gives an empty result;
input columns named like an output are replaced.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorgrid.llm.common import small_batches, text_of, utf8
from sensorgrid.llm.quality import Doc

#: Bound on the labelled rows of a fit.
FIT_ROWS = 20_000
TREES, DEPTH, RATE, BINS, MIN_LEAF, RIDGE = 60, 4, 0.2, 64, 5, 1.0
_CLASSES = {"capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "stops": b".?", "exclaims": b"!", "commas": b",;:",
            "bars": b"|", "marks": b"#*$%&", "brackets": b"<>[]{}()", "at": b"@/\\"}
_DROP = {k: bytes(c for c in range(256) if c not in v) for k, v in _CLASSES.items()}
STATISTICS = ("n_words", "n_lines", "word_length", "line_words", "distinct_words", "top_word", "repeat_words", "dup_lines",
              "not_ascii", "short_words", "long_words", *_CLASSES)


def statistics(text: bytes) -> list[float]:
    """Numbers about one whole text, in the order of :data:`STATISTICS`."""
    d = Doc(text)
    n, chars = max(1, d.n_words), max(1, d.word_chars)
    freq = Counter(d.words)
    lengths = Counter(map(len, d.words))
    return [float(np.log1p(d.n_words)), float(np.log1p(d.n_lines)), d.word_chars / n, d.n_words / max(1, d.n_lines),
            len(freq) / n, max(freq.values(), default=0) / n, d.n_repeat_words / n, d.n_dup_lines / max(1, d.n_lines),
            (len(text) - d.word_chars) / max(1, len(text)),
            sum(v for k, v in lengths.items() if k <= 2) / n, sum(v for k, v in lengths.items() if k > 15) / n,
            *[len(text.translate(None, keep)) / chars for keep in _DROP.values()]]


@dataclass
class Boosted:
    """Trees as arrays: a node holds a feature, the largest value that goes left, both
    children and a value; a leaf is its own child, so every row takes ``depth`` steps."""

    feature: np.ndarray
    upper: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, trees=TREES, depth=DEPTH, rate=RATE, bins=BINS, min_leaf=MIN_LEAF, ridge=RIDGE) -> Boosted:
        """Logistic loss, second-order gains; splits lie on quantiles of each feature."""
        n = len(y)
        share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if n else 0.5
        base = float(np.log(share / (1 - share)))
        feature, upper, left, right, value, roots = [], [], [], [], [], []
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(x.shape[1])] if n else []
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1) if n else None
        score = np.full(n, base)

        def node() -> int:
            i = len(value)
            feature.append(0), upper.append(0.0), left.append(i), right.append(i), value.append(0.0)
            return i

        for _ in range(trees if n and 0 < y.mean() < 1 else 0):
            p = 1 / (1 + np.exp(-score))
            g, h = p - y, p * (1 - p)
            roots.append(node())
            level = {roots[-1]: np.arange(n)}
            for step in range(depth + 1):
                nxt = {}
                for i, rows in level.items():
                    gs, hs = g[rows].sum(), h[rows].sum()
                    value[i] = float(-rate * gs / (hs + ridge))
                    best = (1e-6, None, None)
                    for f in range(x.shape[1] if step < depth and len(rows) >= 2 * min_leaf else 0):
                        b, m = binned[rows, f], len(cuts[f]) + 1
                        if m < 2:
                            continue
                        gl, hl, cl = (np.cumsum(np.bincount(b, w, m))[:-1] for w in (g[rows], h[rows], None))
                        gain = gl ** 2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs ** 2 / (hs + ridge)
                        gain[(cl < min_leaf) | (len(rows) - cl < min_leaf)] = 0
                        at = int(np.argmax(gain))
                        if gain[at] > best[0]:
                            best = (gain[at], f, at)
                    if best[1] is None:
                        score[rows] += value[i]
                        continue
                    feature[i], upper[i] = best[1], float(cuts[best[1]][best[2]])
                    left[i], right[i] = node(), node()
                    low = binned[rows, best[1]] <= best[2]
                    nxt[left[i]], nxt[right[i]] = rows[low], rows[~low]
                level = nxt
        as_int = lambda v: np.array(v, np.int64)
        return cls(as_int(feature), np.array(upper, float), as_int(left), as_int(right), np.array(value, float), as_int(roots), base, depth)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1: all rows walk all trees a level at a time."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth if len(self.roots) else 0):
            low = x[rows, self.feature[at]] <= self.upper[at]
            at = np.where(low, self.left[at], self.right[at])
        total = self.base + (self.value[at].sum(axis=1) if len(self.roots) else np.zeros(len(x)))
        return 1 / (1 + np.exp(-total))


def held_out() -> Column:
    """crc32(doc_id as text) mod 3 is 1: never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> Boosted:
    """Fit on the labelled rows that are not held out, at most ``rows`` of them."""
    small_batches(docs.sparkSession)
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
    some = known.select("doc_id", F.col(label).cast("double").alias("__llm_y")).orderBy(F.xxhash64("doc_id"), "doc_id", "__llm_y").limit(rows)
    texts = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(some), "doc_id")
    sample = texts.select("__llm_y", F.xxhash64("doc_id").alias("__llm_h"), F.xxhash64("text").alias("__llm_t"), "text")

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([statistics(t) for t in utf8(b.column(3))], pa.list_(pa.float64()))], ["y", "h", "t", "x"])

    # repeated ids could make more rows than labels; numbers, not texts, meet in the last step
    got = sample.mapInArrow(run, "y double, h long, t long, x array<double>").orderBy("h", "t", "y").limit(rows).collect()
    x = np.array([r.x for r in got], float).reshape(len(got), len(STATISTICS))
    y = np.array([r.y for r in got], float)
    order = np.lexsort([*x.T, y])  # the fit does not depend on the order in which rows came
    return Boosted.fit(x[order], y[order])


def score(docs: DataFrame, model: Boosted) -> DataFrame:
    """``docs`` with held_out, score and predicted."""
    small_batches(docs.sparkSession)
    docs = docs.drop("held_out", "score", "predicted").withColumn("held_out", held_out())
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            x = np.array([statistics(t) for t in utf8(b.column(at))], float).reshape(b.num_rows, len(STATISTICS))
            p = model.predict(x)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32))], [*b.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))
