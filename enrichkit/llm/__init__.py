"""Operators of a training-data pipeline (nothing else in the library imports them).

One module per operator; ``queries.py`` registers the ``opN_<name>`` queries
and ``oracle.py`` their SQL. The Python helpers that run inside tasks are
pickled by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
