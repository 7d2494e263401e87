"""Operators for preparing training text. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle


def by_value(module: str) -> None:
    """Let a module's functions travel inside the tasks, so that executors need not have the package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
