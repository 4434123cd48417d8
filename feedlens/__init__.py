"""feedlens: dictionary-based entity analytics over text feeds, on Spark.

Everything is a lazy DataFrame: sources produce DataFrames, operators map
DataFrames to DataFrames, and only the handful of guard decisions (is the
subscription file valid, is the dictionary small enough to broadcast) run a
tiny action on the driver.
"""

__version__ = "0.1.0"

from feedlens.plans.analysis import AnalysisResult, EntityReport, analyze_posts, run_analysis  # noqa: E402,F401
