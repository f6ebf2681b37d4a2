"""Spark jobs for the data side of seismic waveform inversion."""

import sys

from pyspark import cloudpickle

# Kernels travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
