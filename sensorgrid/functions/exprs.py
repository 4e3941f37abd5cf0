"""Column expression builders.

Each function returns a ``Column`` built only from ``pyspark.sql.functions``
so it stays inside whole-stage codegen. Nothing here triggers a job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# Status-class cut points (low, mid) on the next-hour CO reading.
CLASS_THRESHOLDS = (1.5, 2.5)
# Raw timestamp formats, tried in this order: "10/03/2004 18.00.00", then "10/03/2004 18:00:00".
TS_FORMATS = ("d/M/yyyy H.m.s", "d/M/yyyy H:m:s")
# Model-family keywords (lower-case substring tests), checked in this order:
#   RNN:            lstm, gru
#   Tree:           randomforest, gbdt, xgboost, lightgbm, catboost, extratrees, extra trees
#   Linear/Kernel:  svr, linear, ridge, lasso, elastic
#   Tree (generic): forest, boost, tree
#   otherwise:      Other
FAMILY_RULES = (
    ("RNN", ("lstm", "gru")),
    ("Tree", ("randomforest", "gbdt", "xgboost", "lightgbm", "catboost", "extratrees", "extra trees")),
    ("Linear/Kernel", ("svr", "linear", "ridge", "lasso", "elastic")),
    ("Tree", ("forest", "boost", "tree")),
)
# The older mapper of the same notebook (it sends DecisionTree / lightgbm to Other):
#   Tree:           randomforest, extratrees, xgboost, gbdt, gradientboost
#   Linear/Kernel:  ridge, lasso, elastic, svr, linear, kernel, enet
#   RNN:            lstm, gru
#   otherwise:      Other
FAMILY_RULES_OLD = (
    ("Tree", ("randomforest", "extratrees", "xgboost", "gbdt", "gradientboost")),
    ("Linear/Kernel", ("ridge", "lasso", "elastic", "svr", "linear", "kernel", "enet")),
    ("RNN", ("lstm", "gru")),
)
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round6(x, places: int = 6) -> Column:
    """Round a double for oracle comparison (HALF_UP, like DuckDB's round)."""
    return F.round(_c(x), places)


def null_if_nan(x) -> Column:
    """Spark keeps NaN as a value; the reference treats NaN as missing."""
    return F.nanvl(_c(x), F.lit(None).cast("double"))


def try_double(x) -> Column:
    """Numeric coercion where unparsable input becomes NULL (ANSI-safe)."""
    return _c(x).try_cast("double")


def european_double(x) -> Column:
    """'1,5' -> 1.5 ; blanks and junk -> NULL."""
    return F.regexp_replace(F.trim(_c(x).cast("string")), ",", ".").try_cast("double")


def parse_two_formats(date_col, time_col, formats=TS_FORMATS) -> Column:
    """Date + Time strings -> timestamp_ntz, trying each format in turn.

    ``concat`` (not ``concat_ws``) so a NULL part yields NULL, like the
    reference's string concatenation of a missing value.
    """
    joined = F.concat(_c(date_col), F.lit(" "), _c(time_col))
    tries = [F.try_to_timestamp(joined, F.lit(fmt)) for fmt in formats]
    return F.coalesce(*tries).cast("timestamp_ntz")


def to_hour(ts) -> Column:
    """Truncate a timestamp_ntz to the hour, staying timestamp_ntz."""
    return F.date_trunc("hour", _c(ts)).cast("timestamp_ntz")


def hours_between(later, earlier) -> Column:
    """Whole hours between two timestamps (bigint)."""
    return F.timestamp_diff("HOUR", _c(earlier), _c(later))


def weekday_mon0(ts) -> Column:
    """Day of week with Monday = 0 (``dayofweek`` would give Sunday = 1)."""
    return F.weekday(_c(ts))


def threshold_class(x, low: float = CLASS_THRESHOLDS[0], mid: float = CLASS_THRESHOLDS[1]) -> Column:
    """NULL -> NULL, x <= low -> 0, x <= mid -> 1, else 2."""
    x = _c(x)
    return (F.when(x.isNull(), F.lit(None).cast("int"))
            .when(x <= F.lit(low), F.lit(0))
            .when(x <= F.lit(mid), F.lit(1))
            .otherwise(F.lit(2)))


def argmax_class(class_scores) -> Column:
    """Class (place from 0) of the highest score in an array; ties go to the lowest class, NULL and
    NaN scores never win, and an array without a score gives NULL."""
    known = F.transform(_c(class_scores), null_if_nan)
    return (F.array_position(known, F.array_max(known)) - 1).cast("int")


def _family_chain(name, rules) -> Column:
    n = F.lower(_c(name).cast("string"))
    expr = None
    for fam, keys in rules:
        cond = None
        for k in keys:
            t = n.contains(k)
            cond = t if cond is None else (cond | t)
        expr = F.when(cond, F.lit(fam)) if expr is None else expr.when(cond, F.lit(fam))
    return expr.otherwise(F.lit("Other"))


def model_family(name) -> Column:
    """Model name -> RNN / Tree / Linear/Kernel / Other (first matching rule wins)."""
    return _family_chain(name, FAMILY_RULES)


def family_of(name) -> Column:
    """The notebook's older family mapper (kept because its plots use it)."""
    return _family_chain(name, FAMILY_RULES_OLD)


def class_label(cls) -> Column:
    """Class id -> label name (0 low, 1 mid, 2 high)."""
    c = _c(cls)
    return (F.when(c == 0, F.lit("low")).when(c == 1, F.lit("mid"))
            .when(c == 2, F.lit("high")))
