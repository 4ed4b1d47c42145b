"""Score large tables of résumé-like documents and match them against a catalog of roles."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in Python workers travel with the job, so executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
