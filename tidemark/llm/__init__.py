"""Training-data operators: filtering, classifying, mixing, scanning, searching, encoding and joining documents."""

import sys

from pyspark import cloudpickle

# functions that run on executors travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
