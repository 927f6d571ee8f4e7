"""Tables that may not have been written yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

#: Spark's conditions for a folder that is missing, or holds no file yet (fixed values).
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_if_there(read: Callable[[], DataFrame]) -> DataFrame | None:
    """``read()``, or None where its path does not exist yet; any other error is raised."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() in ABSENT:
            return None
        raise
