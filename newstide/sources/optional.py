"""Inputs that may be absent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame


def or_none(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame, or None when its path does not exist. Other errors surface."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
