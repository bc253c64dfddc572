"""Report-archive analytics on Spark: DataFrame operators over catalogue tables,
report containers, index files, spool text and access-control blobs."""

import sys

from pyspark import cloudpickle

# The library's Python functions travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
