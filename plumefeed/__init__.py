"""A content-feed engine on Spark DataFrames and Structured Streaming."""

import sys

from pyspark import cloudpickle

from .config import FeedSettings, drop_work, materialize, session, work_path

# Arrow functions travel to the executors with their helpers, so a cluster needs no copy
# of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["FeedSettings", "drop_work", "materialize", "session", "work_path"]
