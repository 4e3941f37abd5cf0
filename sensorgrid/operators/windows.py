"""Statistics of all full windows of many series at once, for tasks that get rows as Arrow batches.

Spark's sliding frames add up every frame from its first row, one row and aggregate at a time; here each of the
``size`` additions is made for all windows of a batch together, in the same order and so with the same doubles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def summaries(batches, carried, n_features: int, size: int, horizons, fields):
    """One row per full window, from rows that come series by series in order, ``__pos`` their place in the series
    from 1: the ``carried`` columns of the window's last row, last value, mean and deviation of each feature
    ``__x<i>``, and ``__label`` each of ``horizons`` rows later in the series. A task holds a batch and the rows
    around it that windows and labels reach to, never a series."""
    ahead, kept = max(horizons, default=0), None
    done = 0  # rows of ``kept`` whose windows are out
    for batch in batches:
        t = pa.Table.from_batches([batch])
        rows = t if kept is None else pa.concat_tables([kept, t]).combine_chunks()
        end = max(rows.num_rows - ahead, done)
        yield from _windows(rows, done, end, carried, n_features, size, horizons, fields)
        first = max(end - size + 1, 0)
        kept, done = rows.slice(first), end - first
    if kept is not None:
        yield from _windows(kept, done, kept.num_rows, carried, n_features, size, horizons, fields)


def _windows(rows: pa.Table, lo: int, hi: int, carried, n_features, size, horizons, fields):
    """The windows whose last row is one of ``lo`` to ``hi``."""
    pos = rows.column("__pos").to_numpy()
    if not ((pos[1:] == pos[:-1] + 1) | (pos[1:] == 1)).all():
        raise ValueError("rows of a series do not follow each other")
    at = np.flatnonzero(pos[lo:hi] >= size) + lo
    if not len(at):
        return
    x = np.stack([rows.column(f"__x{i}").to_numpy() for i in range(n_features)])
    known = np.stack([rows.column(f"__x{i}").is_valid().to_numpy() for i in range(n_features)])
    n, mean, std = sliding_stats(x[:, :hi], known[:, :hi], size)
    w, ends = at - size + 1, rows.take(at)
    out = [ends.column(c) for c in carried]
    for i in range(n_features):
        out += [ends.column(f"__x{i}"), pa.array(mean[i, w], mask=n[i, w] < 1), pa.array(std[i, w])]
    label, last = rows.column("__label"), len(pos) - 1
    for h in horizons:
        to = np.minimum(at + h, last)
        out.append(label.take(pa.array(to, mask=pos[to] != pos[at] + h)))
    yield from pa.table(out, names=fields).combine_chunks().to_batches()


def sliding_stats(x: np.ndarray, known: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features x windows) number, mean and sample deviation of the known values of every ``size`` rows that
    follow each other, as Spark's ``avg`` and ``stddev_samp`` over the frame; with less than two the deviation is 0."""
    m = max(x.shape[1] - size + 1, 0)
    n, total, mean, m2 = np.zeros((4, len(x), m))
    whole = bool(known.all())
    part = np.empty_like(mean)
    with np.errstate(all="ignore"):
        for k in range(size if m else 0):
            v = x[:, k:k + m]
            if whole:
                delta = v - mean
                np.divide(delta, k + 1, out=part)
                total += v
            else:
                ok = known[:, k:k + m]
                n += ok
                delta = np.where(ok, v - mean, 0.0)
                np.divide(delta, np.maximum(n, 1), out=part)
                total += np.where(ok, v, 0.0)
            mean += part
            np.subtract(delta, part, out=part)
            part *= delta
            m2 += part
        if whole:
            n += size
        return n, total / np.maximum(n, 1), np.where(n > 1, np.sqrt(m2 / np.maximum(n - 1, 1)), 0.0)
