"""Bulk file loading as Spark jobs: manifest, fetch, decode, parse, write, audit."""

import sys

from pyspark import cloudpickle

# Arrow stages travel to the executors inside the plan, so a cluster needs no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
