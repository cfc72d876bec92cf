"""Operators for large-scale training-data pipelines.

One module per operator, each a plain DataFrame -> DataFrame function with its
own general interface; ``queries`` registers the contract queries built on
them. Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their code, so executors
# need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
