"""Operators for preparing language-model training data.

Nothing else in the package imports this subpackage. Every operator takes
DataFrames with (at least) ``doc_id`` and ``text`` and leaves other columns
alone (names that begin with ``__llm_`` are reserved for columns that exist
only inside an operator); the thin driver queries live in ``queries.py`` and their DuckDB SQL in
``oracle.py``.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors whole, so they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
