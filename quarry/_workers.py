"""Functions that run inside Python workers are shipped by value, so executors need
neither this package on their path nor ``--py-files``."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship_by_value(module_name: str) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
