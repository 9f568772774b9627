"""Training-data operators over whole corpora; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# The functions travel with the task, so workers need only the third-party packages.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
