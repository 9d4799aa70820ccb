"""Operators that prepare language-model training data.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries when the folder is present.  Task functions are shipped to the
Python workers by value, so the workers need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
