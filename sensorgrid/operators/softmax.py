"""Multinomial logistic regressions of several labels on the same rows, fitted at the same time.

MLlib's ``LogisticRegression`` reads the rows once per label for the moments and once per label and step of
its gradient search. Here the rows lie in blocks, one matrix of some thousand rows each, in the shared folder,
and a pass adds up, for all labels, the loss, the gradient and the second derivatives over each partition's
blocks (``mapInArrow``, one row of sums a partition); Newton's method on these sums needs a handful of passes.
The objective is MLlib's: mean log loss plus ``reg / 2`` times the squared coefficients of the features scaled
to unit sample deviation, all classes alike, intercepts free; coefficients and intercepts are centred.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgrid.operators.common import as_list, q

BLOCK_SCHEMA = "split string, n long, incomplete long, x binary, y binary"
#: A step that promises less than this share of the first loss is the last one.
TOL = 1e-9


def to_blocks(df: DataFrame, features, labels) -> DataFrame:
    """:func:`pack` of the rows of ``df``."""
    features, labels = as_list(features), as_list(labels)
    rows = df.select("split", *[q(c).cast("double").alias(c) for c in features], *[q(c).cast("int").alias(c) for c in labels])
    return rows.mapInArrow(lambda batches: pack(batches, features, labels), BLOCK_SCHEMA)


def pack(batches, features, labels, splits=("train", "test")):
    """One row per Arrow batch and split: rows, rows with a missing feature, and for ``splits`` the features
    (float64, feature by feature) and the labels (int32, label by label, -1 for none) as bytes."""
    for b in batches:
        x = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in features])  # nulls come as NaN
        y = np.stack([b.column(c).fill_null(-1).to_numpy() for c in labels]).astype(np.int32)
        of = b.column("split").dictionary_encode("encode")
        place, out = of.indices.to_numpy(), []
        for i, s in enumerate(of.dictionary.to_pylist()):
            at = slice(None) if len(of.dictionary) == 1 else np.flatnonzero(place == i)
            xs, ys, full = x[:, at], y[:, at], s in splits
            out.append((s, xs.shape[1], int(np.isnan(xs).any(axis=0).sum()), xs.tobytes() if full else b"", ys.tobytes() if full else b""))
        cols = list(zip(*out))
        if cols:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                                             names=["split", "n", "incomplete", "x", "y"])


def _matrices(batches, n_labels: int):
    """(features x rows, labels x rows) of every block."""
    for b in batches:
        for x, y, n in zip(b.column("x"), b.column("y"), b.column("n")):
            n = n.as_py()
            yield np.frombuffer(x.as_buffer()).reshape(-1, n), np.frombuffer(y.as_buffer(), dtype=np.int32).reshape(n_labels, n)


def _partials(blocks: DataFrame, n_labels: int, add) -> list:
    """``add(sums, x, y) -> sums`` over the blocks of each partition, from None; one object a partition."""
    def run(batches):
        sums = None
        for x, y in _matrices(batches, n_labels):
            sums = add(sums, x, y)
        if sums is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(sums)], pa.binary())], names=["sums"])
    return [pickle.loads(r.sums) for r in blocks.select("n", "x", "y").mapInArrow(run, "sums binary").collect()]


def _merge_moments(a, b):
    """(n, means, sums of squared deviations, class counts) of two sets of rows together."""
    if a is None or b[0] == 0:
        return a or b
    n, d = a[0] + b[0], b[1] - a[1]
    classes = {c: a[3].get(c, 0) + b[3].get(c, 0) for c in {*a[3], *b[3]}}
    return n, a[1] + d * (b[0] / n), a[2] + b[2] + d * d * (a[0] * b[0] / n), classes


def moments(blocks: DataFrame, n_labels: int) -> list:
    """Per label over the rows that have it: (n, means, sums of squared deviations, {class: rows})."""
    def add(sums, x, y):
        sums = sums or [None] * n_labels
        for i, lab in enumerate(y):
            xs = x[:, lab >= 0]
            n = xs.shape[1]
            mean = xs.mean(axis=1) if n else np.zeros(len(x))
            classes = {int(c): int(k) for c, k in zip(*np.unique(lab[lab >= 0], return_counts=True))}
            sums[i] = _merge_moments(sums[i], (n, mean, ((xs - mean[:, None]) ** 2).sum(axis=1), classes))
        return sums
    out = [None] * n_labels
    for part in _partials(blocks, n_labels, add):
        out = [_merge_moments(a, b) for a, b in zip(out, part)]
    return out


def _loss_sums(a, lab, classes, beta):
    """Loss, gradient and second derivatives of one block; the last class has no coefficients of its own."""
    k, p = beta.shape
    z = beta @ a
    top = np.maximum(z.max(axis=0), 0.0)
    e = np.exp(z - top)
    total = e.sum(axis=0) + np.exp(-top)
    prob = e / total
    w = (lab >= 0).astype(float)
    hit = np.stack([lab == c for c in classes[:-1]]).astype(float)
    loss = float(w @ (top + np.log(total)) - np.vdot(z, hit))
    grad = (prob * w - hit) @ a.T
    hess = np.empty((k, p, k, p))
    for i in range(k):
        for j in range(i, k):
            v = w * prob[i] * ((1.0 if i == j else 0.0) - prob[j])
            hess[i, :, j, :] = (a * v) @ a.T
            hess[j, :, i, :] = hess[i, :, j, :].T
    return [loss, grad, hess]


def newton_sums(blocks: DataFrame, n_labels: int, centre, scale, tasks: dict) -> dict:
    """{label: [loss, gradient, second derivatives]} over all blocks at ``tasks`` = {label: (classes, beta)}."""
    def add(sums, x, y):
        a = np.concatenate([np.ones((1, x.shape[1])), (x - centre[:, None]) / scale[:, None]])
        got = {i: _loss_sums(a, y[i], classes, beta) for i, (classes, beta) in tasks.items()}
        return got if sums is None else {i: [s + g for s, g in zip(sums[i], got[i])] for i in got}
    out = None
    for part in _partials(blocks, n_labels, add):
        out = part if out is None else {i: [s + g for s, g in zip(out[i], part[i])] for i in part}
    return out


def fit(blocks: DataFrame, n_labels: int, max_iter: int = 100, reg: float = 0.0) -> list:
    """Per label (coefficients: classes x features, intercepts) on all rows of ``blocks`` that have it. Classes
    are 0 to the highest; one without rows has zeros and the intercept minus infinity."""
    stats = moments(blocks, n_labels)
    if any(s is None or s[0] == 0 for s in stats):
        raise ValueError("no training rows with a label")
    dev = [np.sqrt(s[2] / max(s[0] - 1, 1)) for s in stats]
    # one centre and scale for all labels keeps the sums well conditioned; the penalty goes by each label's own
    centre, scale = stats[0][1], np.where(dev[0] > 0, dev[0], 1.0)
    p = len(centre) + 1
    state = {}
    for i, s in enumerate(stats):
        classes = sorted(s[3])
        k = len(classes) - 1
        beta = np.zeros((k, p))
        beta[:, 0] = [np.log(s[3][c] / s[3][classes[-1]]) for c in classes[:-1]]
        r = np.concatenate([[0.0], reg * (dev[i] / scale) ** 2])
        pen = np.kron(np.eye(k) - 1.0 / (k + 1), np.diag(r))
        state[i] = {"classes": classes, "beta": beta, "pen": pen, "n": s[0], "loss": None, "step": None, "done": k == 0}
    for _ in range(max_iter):
        # ``at``: the point to try; the sums there judge the last step and give the next
        open_ = {i: (t["classes"], t["beta"] if t["step"] is None else t["beta"] - t["step"]) for i, t in state.items() if not t["done"]}
        if not open_:
            break
        sums = newton_sums(blocks, n_labels, centre, scale, open_)
        for i, (_, at) in open_.items():
            t = state[i]
            flat = at.ravel()
            loss = sums[i][0] / t["n"] + 0.5 * flat @ t["pen"] @ flat
            if t["loss"] is not None and not loss <= t["loss"] + 1e-12 * t["first"]:
                t["step"] = t["step"] / 2  # too far: half the way from the last point
                continue
            grad = sums[i][1].ravel() / t["n"] + t["pen"] @ flat
            hess = sums[i][2].reshape(len(flat), len(flat)) / t["n"] + t["pen"]
            step = np.linalg.lstsq(hess, grad, rcond=1e-12)[0]
            t.setdefault("first", loss)
            t.update(beta=at, loss=loss, step=step.reshape(at.shape))
            if 0.5 * grad @ step <= TOL * t["first"]:
                t.update(beta=at - t["step"], done=True)
    return [_model(state[i], centre, np.where(dev[i] > 0, scale, np.inf)) for i in range(n_labels)]


def _model(t: dict, centre, scale) -> tuple:
    """Coefficients of the features as they are, centred over the classes that have rows."""
    full = np.vstack([t["beta"], np.zeros((1, len(centre) + 1))])
    full = full - full.mean(axis=0)
    coef = full[:, 1:] / scale
    intercept = full[:, 0] - coef @ centre
    n_classes = t["classes"][-1] + 1
    out = np.zeros((n_classes, len(centre))), np.full(n_classes, -np.inf)
    out[0][t["classes"]], out[1][t["classes"]] = coef, intercept - intercept.mean()
    return out


def confusion_counts(blocks: DataFrame, models: list) -> DataFrame:
    """(label, y_true, y_pred, n) over all blocks: a row's class is that of its highest margin, the lowest of equals."""
    def count(batches):
        total = {}
        for x, y in _matrices(batches, len(models)):
            for i, (coef, intercept) in enumerate(models):
                ok = y[i] >= 0
                pred = (coef @ x + intercept[:, None]).argmax(axis=0)[ok]
                for (t, g), n in zip(*_pairs(y[i][ok], pred)):
                    total[i, t, g] = total.get((i, t, g), 0) + n
        if total:
            cols = list(zip(*[(*k, n) for k, n in total.items()]))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()),
                                              pa.array(cols[3], pa.int64())], names=["label", "y_true", "y_pred", "n"])
    rows = blocks.select("n", "x", "y").mapInArrow(count, "label int, y_true int, y_pred int, n long")
    return rows.groupBy("label", "y_true", "y_pred").agg(F.sum("n").alias("n"))


def _pairs(a, b):
    base = int(b.max(initial=0)) + 1
    code, n = np.unique(a.astype(np.int64) * base + b, return_counts=True)
    return [(int(c) // base, int(c) % base) for c in code], [int(v) for v in n]
