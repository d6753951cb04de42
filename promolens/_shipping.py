"""Ship worker-side Python code with the tasks.

Modules whose functions run in Python workers (the NFKD step, the
per-partition prefix sum) register themselves here; their functions are
then pickled by value, so executors do not need this package installed.
"""

from __future__ import annotations

from types import ModuleType

try:  # the copy bundled with PySpark
    from pyspark import cloudpickle
except ImportError:  # pragma: no cover
    import cloudpickle


def register_by_value(module: ModuleType) -> None:
    try:
        cloudpickle.register_pickle_by_value(module)
    except (AttributeError, ValueError):  # old cloudpickle or already registered
        pass
