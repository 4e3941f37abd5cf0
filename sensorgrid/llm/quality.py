"""Quality rules as a short-circuit cascade.

Every document gets its base counts (:class:`Doc`); those that fail the base go. The others
pass through :data:`RULES` one after the other until one rejects them. The order of the rules
is not fixed: :func:`plan_order` runs every rule on a sample of the documents, measures what
share it rejects and what it costs, and sorts by rejection per cost. A document is kept if no
rule rejects it, so the order changes the cost only, never the verdict.

Scale: one pass over the texts without a shuffle. The sample is the rows, about :data:`SAMPLE`,
whose digest is below a bar set by the row count; each task measures its own, and a few sums
a rule come together. It orders the rules and nothing else.

Defined cases: null or empty text has no words and fails the base; repeated rows get the same
verdict; very long texts are counted whole; an empty table gives an empty result; input columns named like an output are replaced.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorgrid.llm.common import pack_hash, small_batches, text_of, utf8

#: Documents on which the rules' cost and selectivity are estimated.
SAMPLE = 400
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOL = bytes(c for c in range(256) if c not in _SYMBOLS)
_NOT_UPPER = bytes(c for c in range(256) if not 65 <= c <= 90)
_CONTINUATION = bytes(range(0x80, 0xC0))
_SPACE = b" \t\n\r\x0b\x0c"


class Doc:
    """A text's UTF-8 bytes and the counts of the base. Counts of characters are counts of
    bytes that begin one."""

    def __init__(self, text: bytes):
        self.text = text
        self.words = words = text.split()
        self.n_words = len(words)
        self.word_chars = len(text.translate(None, _CONTINUATION + _SPACE))
        self.n_symbols = len(text.translate(None, _NOT_SYMBOL))
        lines = [x for x in text.split(b"\n") if x.strip()]
        self.n_lines = len(lines)
        self.n_dup_lines = len(lines) - len(set(lines))
        self.n_repeat_words = self._repeat_words()

    def _repeat_words(self) -> int:
        """Words inside 3-word windows that are found twice or more."""
        if self.n_words < 4:
            return 0
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for w in self.words], np.int64)
        # number the pairs first: a key of three ids could outgrow 64 bits
        pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
        _, window, seen = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
        hit = np.zeros(self.n_words, bool)
        again = seen[window] > 1
        for k in range(3):
            hit[k:len(ids) - 2 + k] |= again
        return int(hit.sum())

    @property
    def base_failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Doc], bool]


def _top_word(d: Doc) -> int:
    return max(Counter(d.words).values(), default=0)


#: Integer comparisons, so that SQL states them exactly.
RULES = (
    Rule("symbols", lambda d: 10 * d.n_symbols > d.n_words),
    Rule("dup_lines", lambda d: 2 * d.n_dup_lines > d.n_lines),
    Rule("long_words", lambda d: d.word_chars > 15 * d.n_words),
    Rule("capitals", lambda d: 10 * len(d.text.translate(None, _NOT_UPPER)) > 3 * d.word_chars),
    Rule("exclamations", lambda d: 10 * d.text.count(b"!") > 3 * d.n_words),
    Rule("one_word", lambda d: 10 * _top_word(d) > 3 * d.n_words),
    Rule("digits", lambda d: 2 * len(re.findall(rb"[0-9]", d.text)) > d.word_chars),
)


def measure(rules, docs: list[Doc]) -> list[tuple[str, float, float]]:
    """(name, share rejected, seconds a document) of each rule on ``docs``."""
    out = []
    for r in rules:
        t = time.perf_counter()
        rejected = sum(r.rejects(d) for d in docs)
        out.append((r.name, rejected / max(1, len(docs)), (time.perf_counter() - t) / max(1, len(docs))))
    return out


def order_rules(rules, measured: list[tuple[str, float, float]]) -> tuple:
    """Most rejection per cost first; ties keep their place."""
    gain = {name: share / max(cost, 1e-9) for name, share, cost in measured}
    return tuple(sorted(rules, key=lambda r: -gain.get(r.name, 0.0)))


def plan_order(docs: DataFrame, rules=RULES, sample: int = SAMPLE) -> tuple:
    """The rules in the order that the sample suggests; measured on the executors."""
    n = docs.count()
    if not n:
        return tuple(rules)
    # about ``sample`` rows by digest of the id (of the whole row without one), read where they lie
    bar = (2 ** 63 - 1) * min(sample, n) // n
    some = docs.withColumn("__llm_h", F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(pack_hash(docs))).filter(F.shiftrightunsigned("__llm_h", 1) <= bar).select(text_of().alias("text"))

    def run(batches):
        docs = [d for b in batches for d in map(Doc, utf8(b.column(0))) if not d.base_failed]
        if docs:
            name, rejected, spent = zip(*[(m[0], m[1] * len(docs), m[2] * len(docs)) for m in measure(rules, docs)])
            yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(rejected, pa.float64()), pa.array(spent, pa.float64()), pa.array([len(docs)] * len(name), pa.int64())], ["name", "rejected", "spent", "n"])

    got = (some.mapInArrow(run, "name string, rejected double, spent double, n long").groupBy("name")
           .agg((F.sum("rejected") / F.sum("n")).alias("share"), (F.sum("spent") / F.sum("n")).alias("cost")).collect())
    return order_rules(rules, [tuple(r) for r in got])


def verdict(d: Doc, rules) -> str | None:
    """The first rule that rejects, None if none does; later rules are not run."""
    return next((r.name for r in rules if r.rejects(d)), None)


def judge(docs: DataFrame, rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with the base counts, base_failed and kept."""
    small_batches(docs.sparkSession)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    docs = docs.drop(*counts, "base_failed", "kept")
    ordered = plan_order(docs, rules, sample)
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            got = []
            for t in utf8(b.column(at)):
                d = Doc(t)
                got.append([getattr(d, c) for c in counts] + [d.base_failed, not d.base_failed and verdict(d, ordered) is None])
            cols = list(zip(*got)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *[pa.array(c, pa.int64()) for c in cols[:5]], *[pa.array(c, pa.bool_()) for c in cols[5:]]],
                [*b.schema.names, *counts, "base_failed", "kept"])

    added = [T.StructField(c, T.LongType()) for c in counts] + [T.StructField(c, T.BooleanType()) for c in ("base_failed", "kept")]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))
