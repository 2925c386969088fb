"""Contig filtering, quality control and cohort reports for bacterial genomes, on Spark."""

import sys

from pyspark import cloudpickle

# Tasks get this package's functions with their code, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
