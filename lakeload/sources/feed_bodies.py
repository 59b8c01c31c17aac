"""Landed responses of dataset feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.schemas import FEED_BODY


def feed_results(bodies: DataFrame, column: str = "body") -> DataFrame:
    """One row per announced dataset: the body's columns plus ``position`` in the body and ``dataset``, a text map.

    A body without ``results`` gives no rows. Text that is not JSON fails the job.
    """
    parsed = F.from_json(F.col(column), FEED_BODY, {"mode": "FAILFAST"})
    return bodies.select(*[c for c in bodies.columns if c != column], F.posexplode(parsed["results"]).alias("position", "dataset"))
