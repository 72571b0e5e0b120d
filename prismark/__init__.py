"""prismark: literature-review analytics as Spark DataFrame operators.

Functions that run inside Python workers (the title-ratio UDF, the result
page parser, the user scorer wrapper, the neighbour block kernel) are shipped
by value, so executors need no copy of this package installed.
"""

import sys

try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError):  # older cloudpickle: ship the package with --py-files instead
    pass
