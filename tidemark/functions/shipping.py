"""Send the small task functions of a module along with the job, so that executors need no copy
of this package."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship_with_tasks(module: str) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[module])
