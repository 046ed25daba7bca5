"""ratewise: a Spark-native rating analytics and recommendation engine.

Batch statistics, latent-factor recommendation, item-item similarity and
realtime re-scoring of a rating stream, all expressed as DataFrame / Spark SQL
/ Structured Streaming plans.
"""

import sys as _sys

__version__ = "0.1.0"

# The few functions that run inside Python workers (block kernels, the
# streaming state processor) are shipped with each task by value, so
# executors need only pyspark, numpy and pandas -- not this package.
try:  # pragma: no cover - depends on the pyspark build
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
