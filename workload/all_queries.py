"""Importing this module registers every query."""
from workload import backtest, prices, records, reports, stores  # noqa: F401
