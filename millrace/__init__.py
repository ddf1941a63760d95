"""Change-data-capture on Spark: decode a logical-replication log and keep table replicas.

Python code that runs inside tasks is shipped by value, so executors need no
copy of this package on their path.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
