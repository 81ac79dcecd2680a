"""tablelens: Spark-native profiling, classification evaluation and run history.

Every operator takes DataFrames and returns DataFrames; rules are column
expressions so one job can serve many datasets, segments or runs.
"""

from tablelens.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
