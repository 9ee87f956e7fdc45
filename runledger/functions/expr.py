"""Column expressions shared by the reports. All are built-in, so they stay in codegen,
and none depends on the session time zone or the ANSI setting."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from runledger.schemas import NONE, NOT_AVAILABLE

DAY_MS = 86_400_000

# Task kinds in the order in which they are tested: fixed values.
TASK_KINDS = (
    ("notebook_task_path", "Notebook Task"),
    ("run_job_task_job_id", "Job Run Task"),
    ("spark_jar_task_jar_uri", "Spark Jar Task"),
    ("spark_python_task_python_file", "Spark Python Task"),
    ("sql_task_query", "SQL Task"),
    ("dbt_task_as_dict", "DBT Task"),
)

# Life-cycle states after which a run no longer changes: fixed values.
TERMINAL_STATES = ("TERMINATED", "INTERNAL_ERROR", "SKIPPED")


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def provision_method(num_workers: Column | str = "num_workers") -> Column:
    return F.when(_col(num_workers) == NONE, "Autoscale").otherwise("Fixed")


def sentinel_long(text: Column | str) -> Column:
    """Count held as text: ``'None'`` is 0, NULL stays NULL."""
    text = _col(text)
    return F.when(text == NONE, F.lit(0).cast("bigint")).otherwise(text.try_cast("bigint"))


def task_type() -> Column:
    """Kind of a task row: the first kind column that is filled, NULL if none is."""
    kind = F.lit(None).cast("string")
    for column, label in reversed(TASK_KINDS):
        kind = F.when(F.col(column) != NOT_AVAILABLE, label).otherwise(kind)
    return kind


def epoch_ms(day: dt.date) -> int:
    return (day - dt.date(1970, 1, 1)).days * DAY_MS


def epoch_day(ms: Column | str) -> Column:
    """UTC date of an epoch-millisecond column."""
    return F.date_from_unix_date(F.floor(_col(ms) / DAY_MS).cast("int"))


def in_window(ms: Column | str, start: dt.date, end: dt.date) -> Column:
    """``start <= day(ms) < end``, stated on the raw column so that it reaches the scan."""
    ms = _col(ms)
    return (ms >= epoch_ms(start)) & (ms < epoch_ms(end))


def size_key(node: Column | str, normalize: bool = False) -> Column:
    """Part of a node type that the size catalogue lists: the text after the last dot.
    ``normalize`` also maps ``Standard_D3_v2`` to the catalogue's ``D3 v2``."""
    node = _col(node)
    suffix = F.substring_index(node, ".", -1)
    if not normalize:
        return suffix
    short = F.replace(F.substr(node, F.lit(10)), F.lit("_"), F.lit(" "))
    return F.when(node.startswith("Standard_"), short).otherwise(suffix)


def is_terminal(state: Column | str) -> Column:
    return _col(state).isin(*TERMINAL_STATES)


def blank_as(value: Column | str, other: Column) -> Column:
    """``value``, or ``other`` where it is NULL or empty text."""
    return F.coalesce(F.nullif(_col(value), F.lit("")), other)
