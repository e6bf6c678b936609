"""Spark-native recurring-revenue analytics: fiscal calendar, ARR movements,
revenue waterfall, cohort NRR, close reports and data-quality checks."""

__version__ = "0.1.0"
