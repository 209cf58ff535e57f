"""Training-data operators: chat formatting, decontamination, licences, quality, secrets,
SimHash and embedding near-duplicates, toxicity, PII and sequence packing.

Nothing outside this subpackage imports it; ``queries.py`` registers one query per operator.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so that it need not be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
