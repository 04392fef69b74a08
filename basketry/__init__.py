"""basketry: basket and text analytics for retail-style order data, written as
Spark DataFrame / Spark ML jobs.

Sub-packages:

* ``sources``   - table, CSV, pandas and model/file sources and sinks
* ``functions`` - column-expression builders (text cleaning, array slicing, one-hot)
* ``operators`` - DataFrame -> DataFrame operators (profiling, baskets, TF-IDF,
  clustering, classification, next-item models, partition control)
* ``plans``     - the query catalogue over the test tables and its SQL oracles
"""

__version__ = "0.1.0"


def _ship_functions_by_value() -> None:
    """Functions of this package used inside Spark tasks (pandas UDFs,
    mapInPandas passes and their helpers) are pickled by value, so executors
    run them without having the package installed or on their path."""
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover - pyspark is a hard dependency
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_functions_by_value()
