"""Text labels for codes and hours."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payment codes and their labels.
PAYMENT_LABELS = {1: "credit_card", 2: "cash", 3: "no_charge", 4: "dispute"}
OTHER_PAYMENT = "unknown"

# Parts of the day as [first hour, hour after the last); the rest is night.
DAY_PARTS = {"morning": (6, 12), "afternoon": (12, 17), "evening": (17, 21)}
OTHER_DAY_PART = "night"

# Fixed value: where a landing path carries its hour (`hour_07` or `hour=07`).
HOUR_IN_PATH = r"hour[_=](\d+)"


def first_match(cases: Iterable[tuple[Column, str]], default: str) -> Column:
    """The label of the first case that holds, else ``default``."""
    (holds, text), *others = cases
    label = F.when(holds, text)
    for holds, text in others:
        label = label.when(holds, text)
    return label.otherwise(default)


def payment_label(code: Column) -> Column:
    return first_match(((code == key, text) for key, text in PAYMENT_LABELS.items()), OTHER_PAYMENT)


def day_part(hour: Column) -> Column:
    return first_match(
        ((hour.between(start, end - 1), text) for text, (start, end) in DAY_PARTS.items()),
        OTHER_DAY_PART,
    )


def hour_in_path(path: Column) -> Column:
    """The hour named in a file path; NULL for a path without one."""
    return F.regexp_extract(path, HOUR_IN_PATH, 1).try_cast("int")
