"""Landing-zone to lake loading, expressed as Spark DataFrame operators.

Sub-packages:

* ``functions``  column expressions (parsers, validators, key and time helpers)
* ``sources``    readers and parsers for what lands: objects, CSV, sidecars, feeds
* ``operators``  DataFrame -> DataFrame steps over the ledger and the listing
* ``plans``      the steps put together: a load pass, a relocation pass, a feed sync
* ``streaming``  the same steps driven by Structured Streaming
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Task-side helpers travel by value, so executors need no copy of the package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
