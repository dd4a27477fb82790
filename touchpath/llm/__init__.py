"""Training-data operators: language id, exact and near dedup, repeated-span
removal, fingerprints, secret and personal-data handling, mixing and packing.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# functions of this subpackage travel to the executors by value: workers need
# numpy and pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
