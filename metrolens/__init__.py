"""metrolens: lazy, distributed DataFrame operators for civic and location data.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` (or a
``Column``) and stays lazy; the only functions that run jobs are sinks,
``nearest_join`` (which resolves points level by level) and the reports in
``metrolens.plans``.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

__version__ = "0.1.0"

# Functions of this package that run inside Python workers (the Arrow UDF
# twins, the GeoJSON writer) are pickled by value, so executors need no copy
# of the package on their path.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
