"""Operators of a large-scale training-data pipeline (extraction, quality, de-duplication,
decontamination, surrogates, tokenising), one module each.

Nothing outside this folder, ``corpus_pipeline.py`` and the guard in ``__spark_entry__.py``
imports it.  Functions that run in Python tasks travel by value, so executors need no copy
of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
