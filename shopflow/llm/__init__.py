"""Training-data operators: extraction, scans, filters, decontamination, mixing and de-duplication of text corpora.

Nothing else in the library imports this subpackage.  Functions that run inside Python workers are pickled by value, so
executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
