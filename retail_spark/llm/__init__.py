"""Training-data operators: filtering, de-identification, de-duplication,
mixing, packing and vector search, each as Spark jobs.

Nothing else in the library imports this subpackage. Functions that run in
Python workers are pickled by value, so executors need no copy of the
repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
