"""Training-data operators: language ID, quality, near-duplicates, archives,
decontamination, mixing, sharding, toxicity and licence scans.

Each module holds one operator with its own general interface; ``queries``
registers the thin ``opN_<name>`` queries over the given tables and the DuckDB
SQL of those that SQL can express.
"""

import sys

from pyspark import cloudpickle

# Functions and classes of this subpackage travel to the executors by value,
# so executors need no copy of the library on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
