"""Water-column sonar analytics expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Python functions of this package travel with the job, so executors need no installation of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
