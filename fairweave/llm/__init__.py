"""Operators for preparing language-model training corpora.

Nothing outside this subpackage imports it, so it can be removed without
touching the rest of the library.  Functions shipped to executors are pickled
by value: the executors need not have this repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
