"""pagefold: document ingestion, cleaning, splitting, indexing and question answering on Spark."""

import sys

from pyspark import cloudpickle

from pagefold.session import get_session
from pagefold.settings import Settings

# Task code travels with the job, so the executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Settings", "get_session"]
