"""Document curation and hybrid retrieval on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from loomdex.session import build_session

# Functions that run in tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session"]
__version__ = "0.1.0"
