"""Corpus preparation, packing, evaluation and run analysis as Spark jobs."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the Python workers with the job, so the workers need no installation
cloudpickle.register_pickle_by_value(sys.modules[__name__])
