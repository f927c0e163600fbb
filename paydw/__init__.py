"""paydw: a Spark-native payments warehouse and analytics library.

Layers (each one a set of DataFrame/SQL jobs that stay on the executors):

* ``sources``   - staging readers, the driver-table roles and the calendar.
* ``operators`` - reusable relational operators: insert-only merge, contract
  resolution, daily summary, dense day axes, ordered-series windows, trend
  fits and autocorrelation.
* ``functions`` - column expressions (calendar attributes, money sums that round no row).
* ``plans``     - the warehouse ETL and the analytics questions built on it.
* ``streaming`` - incremental ingest and live daily totals.
"""

__version__ = "0.1.0"


def _pickle_by_value() -> None:
    """Ship this package's code inside the pickled grouped-pandas functions,
    so executors need no installed copy of it."""
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover
        return
    try:
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except ValueError:
        pass


_pickle_by_value()
