"""noema: a Spark-native concept / paper knowledge-graph engine.

Sub-packages
------------
functions  column expressions (text, lists, JSON repair, predicates)
sources    readers and writers (CSV, JSON responses, parquet tables, graph snapshots)
operators  reusable DataFrame operators (first/last per key, top-k, joins,
           aggregates, set operations, graph upserts, entity resolution, ...)
plans      composite dataflows built from the operators, and the query catalog
           over the driver tables
streaming  incremental (resumable) processing with Structured Streaming
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Serialise this package's functions (UDFs, generators) by value, so
    Python workers need not be able to import ``noema`` themselves — on a
    cluster or when the driver runs from another working directory."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # older cloudpickle: workers then import the package
        pass


_ship_by_value()
