"""Column expressions shared by the operators. All run inside the JVM."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The common-log patterns (one capture group per field; the
# request pattern captures method, endpoint and protocol).
HOST_PATTERN = r"(^\S+\.[\S+\.]+\S+)\s"
ANY_HOST_PATTERN = r"^(\S+)\s"
TIME_PATTERN = r"\[(\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2} -\d{4})]"
ANY_ZONE_TIME_PATTERN = r"\[(\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2} [+-]\d{4})]"
REQUEST_PATTERN = r"\"(\S+)\s(\S+)\s*(\S*)\""
STATUS_PATTERN = r"\s(\d{3})\s"
SIZE_PATTERN = r"\s(\d+)$"

# English month names in calendar order.
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)


def col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clf_time(text: str | Column, use_zone: bool = False) -> Column:
    """Common-log time to timestamp; null when it does not parse.

    The zone is ignored unless ``use_zone`` is set.
    """
    if use_zone:
        return F.try_to_timestamp(col(text), F.lit("dd/MMM/yyyy:HH:mm:ss Z"))
    return F.try_to_timestamp(F.substring(col(text), 1, 20), F.lit("dd/MMM/yyyy:HH:mm:ss"))


def month_number(name: str | Column) -> Column:
    """Full or three-letter English month name to 1..12; null for anything else."""
    key = F.lower(F.trim(col(name)))
    result = F.when(F.lit(False), F.lit(0))
    for number, month in enumerate(MONTHS, start=1):
        result = result.when(key.isin(month.lower(), month[:3].lower()), F.lit(number))
    return result


def month_name(number: str | Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS]), col(number).cast("int"))


def hash_percent(key: str | Column) -> Column:
    """0..99 from a key, the same on any layout, engine or run."""
    digest = F.substring(F.md5(col(key).cast("string")), 1, 8)
    return F.conv(digest, 16, 10).cast("bigint") % 100


def blank(value: str | Column) -> Column:
    return F.trim(col(value).cast("string")) == ""


def tidy(value: Column, digits: int = 4) -> Column:
    """Rounded, with negative zero folded into zero."""
    return F.round(value, digits) + F.lit(0.0)


def symmetric_error(actual: str | Column, forecast: str | Column) -> Column:
    """200·|f−a| / (|f|+|a|); zero when both are zero."""
    a, f = col(actual), col(forecast)
    return F.coalesce(F.try_divide(F.lit(200.0) * F.abs(f - a), F.abs(f) + F.abs(a)), F.abs(f - a) * 0.0)


def squared_distance(left: Column, right: Column) -> Column:
    """Squared Euclidean distance of two equally long arrays."""
    steps = F.zip_with(left, right, lambda a, b: (a - b) * (a - b))
    return F.aggregate(steps, F.lit(0.0), lambda total, x: total + x)


def vectors_literal(vectors: Sequence[Sequence[float]]) -> Column:
    """Many vectors as one folded literal, however many numbers they have."""
    return F.from_json(F.lit(json.dumps([[float(x) for x in v] for v in vectors])), "array<array<double>>")


def vector_literal(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])
