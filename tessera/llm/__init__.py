"""Operators of a large-scale training-data pipeline.

Each module holds one operator as DataFrame code; :mod:`tessera.llm.queries`
registers one thin query per operator and :mod:`tessera.llm.oracle` the SQL
for those that SQL can state. Nothing else in the library imports this
package.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python tasks travel with the task, so that executors
# need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
