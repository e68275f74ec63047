"""Training-data operators: ten corpus operators and the pipeline over them.

Nothing else in the library imports this package; ``queries`` registers its
queries and their SQL for the driver.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks are sent by value, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
