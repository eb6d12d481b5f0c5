"""Training-data operators: archives, secrets, similarity joins, mixing,
decontamination, chat formatting, embedding dedup, toxicity, sharding, licences.

Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
