"""Scalar column expressions (all JVM-side built-ins, no Python UDFs)."""

from sensorgrid.functions.exprs import (  # noqa: F401
    CLASS_THRESHOLDS,
    class_label,
    european_double,
    family_of,
    hours_between,
    model_family,
    null_if_nan,
    parse_two_formats,
    round6,
    threshold_class,
    to_hour,
    try_double,
    weekday_mon0,
)
from sensorgrid.functions.columns import (  # noqa: F401
    drop_by_regex,
    numeric_columns,
    pick_target_column,
    pollutant_candidates,
    priority_features,
)
