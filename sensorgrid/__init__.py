"""sensorgrid: Spark-native hourly sensor forecasting (cleaning, grid, features, splits,
metrics, leaderboards and Spark ML per target x horizon)."""

__version__ = "0.1.0"
