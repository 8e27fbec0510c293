"""Document retrieval on Spark: tables of pages and documents in, grounded prompts and answers out."""

import sys

from pyspark import cloudpickle

# task functions travel with the plan, so executors need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
