"""Archive dump source (SRC-2, WIN-2): ``.tar`` / ``.tar.gz`` of NDJSON members as lines with
``(path, file_number, line_number, value)``; see ``lines`` for how they are read.

A filter on ``file_number`` or ``line_number`` may follow; ``lines.read_lines`` with a range skips the splits outside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .lines import read_lines


def read_tar_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return read_lines(spark, paths, numbered=True).select("path", "file_number", "line_number", "value")
