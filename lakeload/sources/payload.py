"""Job payloads: a JSON text with a ``loads`` array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.schemas import JOB_PAYLOAD


def payload_loads(payloads: DataFrame, column: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per load of each payload. Text that is not JSON fails the job; no ``loads`` gives no rows."""
    parsed = F.from_json(F.col(column), JOB_PAYLOAD, {"mode": "FAILFAST"})
    return payloads.select(*keep, F.inline(parsed["loads"]))


def to_payload(loads: Column) -> Column:
    """The inverse: an array of load structs as payload text."""
    return F.to_json(F.struct(loads.alias("loads")))
