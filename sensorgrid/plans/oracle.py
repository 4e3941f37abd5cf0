"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The SQL is generated from the same parameters as the Spark plans (sensor
list, lags, widths, split boundary) so the two cannot drift apart. Doubles
are rounded with ``r6``: DuckDB's ``round`` on DOUBLE differs from Spark's
HALF_UP-on-decimal rounding at exact ties, so the value goes through its
shortest decimal text first, which makes both engines agree.
"""

from __future__ import annotations

from statistics import NormalDist

from sensorgrid.operators.features import LAGS, ROLLS, min_periods
from sensorgrid.operators.leaderboard import FAMILIES, POLLUTANTS
from sensorgrid.functions.exprs import FAMILY_RULES, FAMILY_RULES_OLD
from sensorgrid.operators.metrics import QQ_PROBS
from sensorgrid.sources.testdata import ADAPTER_SQL, SENSORS

W = "PARTITION BY entity_id ORDER BY ts"


def r6(e: str, places: int = 6) -> str:
    x = f"({e})"
    return (f"CAST(round(CAST(CAST({x} + sign({x}) * CAST(1e-9 AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), "
            f"{places}) AS DOUBLE)")


def qi(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def flag(c: str) -> str:
    return qi(f"{c}__was_missing")


def sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else repr(v) for v in values) + "]"


# ----------------------------------------------------------------------------- cleaning chain

def cte_readings() -> str:
    return f"readings AS ({ADAPTER_SQL['readings']})"


def cte_sentinel(src="readings", name="sentinel", sensors=SENSORS) -> str:
    cols = ", ".join(f"CASE WHEN {c} = -200 THEN NULL ELSE CAST({c} AS DOUBLE) END AS {c}" for c in sensors)
    return (f"{name} AS (SELECT entity_id, ts, {cols} FROM {src} "
            f"WHERE entity_id IS NOT NULL AND ts IS NOT NULL)")


def cte_flags(src="sentinel", name="flagged", sensors=SENSORS) -> str:
    cols = ", ".join(f"CAST({c} IS NULL AS TINYINT) AS {flag(c)}" for c in sensors)
    return f"{name} AS (SELECT *, {cols} FROM {src})"


def cte_impute(src="flagged", name="imputed", sensors=SENSORS) -> str:
    cols = ", ".join(f"coalesce({c}, quantile_cont({c}, 0.5) OVER (PARTITION BY entity_id)) AS {c}"
                     for c in sensors)
    return f"{name} AS (SELECT * REPLACE ({cols}) FROM {src})"


def cte_winsor(src="imputed", name="winsorized", sensors=SENSORS, k: float = 3.0) -> str:
    qs = ", ".join(f"quantile_cont({c}, 0.25) OVER (PARTITION BY entity_id) AS __q1_{c}, "
                   f"quantile_cont({c}, 0.75) OVER (PARTITION BY entity_id) AS __q3_{c}" for c in sensors)
    clip = ", ".join(f"least(greatest({c}, __q1_{c} - {k} * (__q3_{c} - __q1_{c})), "
                     f"__q3_{c} + {k} * (__q3_{c} - __q1_{c})) AS {c}" for c in sensors)
    drop = ", ".join(f"__q1_{c}, __q3_{c}" for c in sensors)
    return (f"{name}_q AS (SELECT *, {qs} FROM {src}), "
            f"{name} AS (SELECT * EXCLUDE ({drop}) REPLACE ({clip}) FROM {name}_q)")


def cte_grid(src="winsorized", name="gridded", sensors=SENSORS, with_flags=True) -> str:
    vals = ", ".join(f"s.{c}" for c in sensors)
    flags = (", " + ", ".join(f"CAST(coalesce(s.{flag(c)}, 0) AS TINYINT) AS {flag(c)}" for c in sensors)
             if with_flags else "")
    return (f"{name}_b AS (SELECT entity_id, min(ts) AS lo, max(ts) AS hi FROM {src} GROUP BY entity_id), "
            f"{name}_g AS (SELECT entity_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM {name}_b), "
            f"{name} AS (SELECT g.entity_id, g.ts, {vals}{flags}, "
            f"CAST(CASE WHEN s.entity_id IS NULL THEN 1 ELSE 0 END AS TINYINT) AS __gap "
            f"FROM {name}_g g LEFT JOIN {src} s ON g.entity_id = s.entity_id AND g.ts = s.ts)")


def cte_ffill(src="gridded", name="cleaned", sensors=SENSORS) -> str:
    cols = ", ".join(f"last_value({c} IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
                     for c in sensors)
    return f"{name} AS (SELECT * REPLACE ({cols}) FROM {src})"


def clean_chain(sensors=SENSORS) -> list[str]:
    return [cte_readings(), cte_sentinel(sensors=sensors), cte_flags(sensors=sensors),
            cte_impute(sensors=sensors), cte_winsor(sensors=sensors), cte_grid(sensors=sensors),
            cte_ffill(sensors=sensors)]


def supplier_chain() -> list[str]:
    """Daily grid and forward fill of the supplier series, ending in ``cleaned``."""
    fill = ", ".join(f"last_value({c} IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}" for c in ("qty10", "price"))
    return [f"sup AS ({ADAPTER_SQL['supplier']})",
            "sup_b AS (SELECT entity_id, min(ts) AS lo, max(ts) AS hi FROM sup GROUP BY entity_id)",
            "sup_g AS (SELECT entity_id, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS ts FROM sup_b)",
            "sup_f AS (SELECT g.entity_id, g.ts, s.qty10, s.price, CAST(CASE WHEN s.entity_id IS NULL THEN 1 ELSE 0 END AS TINYINT) AS __gap "
            "FROM sup_g g LEFT JOIN sup s ON g.entity_id = s.entity_id AND g.ts = s.ts)",
            f"cleaned AS (SELECT * REPLACE ({fill}) FROM sup_f)"]


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# ----------------------------------------------------------------------------- features

def lag_sql(c: str, L: int) -> str:
    return f"lag({c}, {L}) OVER ({W}) AS {qi(f'{c}__lag{L}')}"


def roll_sql(c: str, width: int, fn: str, name: str) -> str:
    fr = f"({W} ROWS BETWEEN {width - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({c}) OVER {fr} >= {min_periods(width)} THEN {fn}({c}) OVER {fr} END AS {qi(name)}"


def feature_cols(c: str, lags=LAGS, rolls=ROLLS) -> list[tuple[str, str]]:
    """(sql, name) for the lag / rolling features of one column."""
    out = [(lag_sql(c, L), f"{c}__lag{L}") for L in lags]
    out += [(roll_sql(c, w, "avg", f"{c}__roll_mean{w}"), f"{c}__roll_mean{w}") for w in rolls]
    out += [(roll_sql(c, w, "stddev_samp", f"{c}__roll_std{w}"), f"{c}__roll_std{w}") for w in rolls]
    return out


CALENDAR = [
    ("CAST(hour(ts) AS INTEGER) AS hour", "hour", False),
    ("CAST(isodow(ts) - 1 AS INTEGER) AS dow", "dow", False),
    ("CAST(month(ts) AS INTEGER) AS month", "month", False),
    ("CAST(isodow(ts) >= 6 AS TINYINT) AS is_weekend", "is_weekend", False),
    ("CAST(__gap AS TINYINT) AS gap_flag", "gap_flag", False),
]


def class_sql(x: str, low: float = 1.5, mid: float = 2.5) -> str:
    return (f"CASE WHEN ({x}) IS NULL THEN NULL WHEN ({x}) <= {low} THEN 0 "
            f"WHEN ({x}) <= {mid} THEN 1 ELSE 2 END")


def split_sql(test_start: str, val_fraction: float = 0.2) -> tuple[str, str]:
    """(pre-CTE columns, split expression) for the date-boundary chrono split."""
    fit = f"(ts < TIMESTAMP '{test_start}')"
    pre = (f"sum(CAST({fit} AS INTEGER)) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS __pos, "
           f"sum(CAST({fit} AS INTEGER)) OVER (PARTITION BY entity_id) AS __nfit")
    expr = (f"CASE WHEN {fit} AND __pos <= floor(CAST({1.0 - val_fraction!r} AS DOUBLE) * __nfit) THEN 'train' "
            f"WHEN {fit} THEN 'val' WHEN ts >= TIMESTAMP '{test_start}' THEN 'test' END")
    return pre, expr


def pack_ctes(features, target: str, test_start: str, lags=LAGS, rolls=ROLLS, sensors=SENSORS,
              name="pack") -> tuple[list[str], list[tuple[str, bool]]]:
    """CTEs ending in ``name`` (the feature pack) and its (column, is_double) list."""
    pre, split = split_sql(test_start)
    cols = [("entity_id", False), ("ts", False), ("split", False)]
    sel = ["entity_id", "ts", f"{split} AS split"]
    for c in features:
        sel.append(c)
        cols.append((c, True))
    for c in features:
        for s, n in feature_cols(c, lags, rolls):
            sel.append(s)
            cols.append((n, True))
    for s, n, _ in CALENDAR:
        sel.append(s)
        cols.append((n, False))
    lead = f"lead({target}, 1) OVER ({W})"
    sel += [f"{lead} AS target_reg", f"{class_sql(lead)} AS target_cls", f"row_number() OVER ({W}) AS __rn"]
    cols += [("target_reg", True), ("target_cls", False)]
    ctes = clean_chain(sensors) + [
        f"{name}_s AS (SELECT *, {pre} FROM cleaned)",
        f"{name}_w AS (SELECT {', '.join(sel)} FROM {name}_s)",
        f"{name} AS (SELECT * EXCLUDE (__rn) FROM {name}_w WHERE __rn > {max(lags)})",
    ]
    return ctes, cols


def final(cols, src: str, where: str = "") -> str:
    parts = [f"{r6(qi(c))} AS {qi(c)}" if dbl else qi(c) for c, dbl in cols]
    return f"SELECT {', '.join(parts)} FROM {src}" + (f" WHERE {where}" if where else "")


# ----------------------------------------------------------------------------- families

def family_sql(col: str = "model", rules=FAMILY_RULES) -> str:
    s = f"lower({col})"
    parts = []
    for fam, keys in rules:
        cond = " OR ".join(f"contains({s}, '{k}')" for k in keys)
        parts.append(f"WHEN {cond} THEN '{fam}'")
    return "CASE " + " ".join(parts) + " ELSE 'Other' END"


def family_old_sql(col: str = "model") -> str:
    return family_sql(col, FAMILY_RULES_OLD)


def scores_cte() -> str:
    return f"scores AS ({ADAPTER_SQL['scores']})"


def daily_cte() -> str:
    return f"daily AS ({ADAPTER_SQL['daily']})"


def best_rows(src: str, keys, order: str, name: str) -> str:
    """Best row per key group: row_number over an explicit total order."""
    return (f"{name}_r AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) AS __k "
            f"FROM {src}), {name} AS (SELECT * EXCLUDE (__k) FROM {name}_r WHERE __k = 1)")


NAIVE_RNN_FILTER = ("NOT (contains(lower(model), 'naive') OR contains(lower(model), 'baseline') "
                    "OR contains(lower(model), 'lstm') OR contains(lower(model), 'gru'))")
RNN_FILTER = "NOT (contains(lower(model), 'lstm') OR contains(lower(model), 'gru'))"

QQ_NORMAL = [NormalDist().inv_cdf(p) for p in QQ_PROBS]

__all__ = ["r6", "qi", "with_", "clean_chain", "pack_ctes", "final", "family_sql", "family_old_sql",
           "scores_cte", "daily_cte", "best_rows", "FAMILIES", "POLLUTANTS", "QQ_NORMAL", "QQ_PROBS"]
