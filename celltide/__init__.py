"""celltide: cellular-telemetry analytics as plain Spark DataFrame functions."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Python functions that run in tasks travel with the job: executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
