"""Operators for preparing language-model training data.

Nothing outside this package (and ``corpus_pipeline.py``) imports it. Its
functions travel to Python workers by value, so executors need only the public
libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
