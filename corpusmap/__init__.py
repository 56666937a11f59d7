"""Document-corpus mapping on Spark: articles in, a labelled tree of topics out."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers with the task, so that executors need no
# installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
