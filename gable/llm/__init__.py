"""Training-data operators: decontamination, sharding, mixing, toxicity,
n-gram joins, secret scans, token files, WARC bundles, language id, quality
rules, periodic runs, MinHash near duplicates and spelling variants. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# task functions travel with the plan: executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
