"""Operators of a training-data pipeline over documents and embeddings.

Nothing outside this package (but ``corpus_pipeline.py`` and the driver's
entry module) imports it.  Its Python kernels travel to the executors by
value, so a worker needs numpy, pyarrow and the named tokenizer or hash
library, not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
