"""DataFrame -> DataFrame operators.

Every operator is lazy; the few that need a driver-side value (a global
statistic, a validity count) say so in their docstring. Windows over a series
use ``series_window(key, ts)`` = ``partitionBy(key).orderBy(ts)``, so all
per-series work of one query shares a single exchange and sort.
"""
