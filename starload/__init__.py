"""starload: a Spark-native star-schema load of a daily surveillance series
and monthly weather series, with data-quality checks and BI aggregates."""

__version__ = "0.1.0"
