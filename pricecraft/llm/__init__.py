"""Training-data operators: near-duplicate joins, tokenizer files, quality, toxicity, language and LM scores.

Nothing outside this package imports it.  Task functions are pickled by value,
so executors need the libraries (numpy, pyarrow, ...) but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
