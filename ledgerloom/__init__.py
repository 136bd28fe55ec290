"""ledgerloom: retail analytics as Spark plans.

Operators are functions from a mapping of table name to DataFrame (plus
parameters) to a DataFrame. They stay lazy; the few that must cut a plan write
to the checkpoint folder the session names.
"""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks are shipped by value, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
