"""giftlens: donor analytics on Spark DataFrames.

Operators are plain functions ``DataFrame -> DataFrame``; they build lazy
Catalyst plans and never collect data to the driver.
"""

from giftlens.config import AnalysisParams, ColumnMap, ModelParams, Settings, DEFAULT  # noqa: F401

__version__ = "0.1.0"
