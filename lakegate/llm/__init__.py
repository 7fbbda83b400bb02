"""Operators for preparing language-model training corpora.

Nothing else in the library imports this subpackage; its queries and their SQL
are in :mod:`lakegate.llm.queries`, the staged run is in ``corpus_pipeline.py``.
"""

import sys

from pyspark import cloudpickle

# Code that runs in tasks travels with them, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
