"""Current value of each window from a log of its versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.schema import AGGREGATE_KEYS, AGGREGATE_MEASURES


def latest_versions(changelog: DataFrame) -> DataFrame:
    """The version with the highest ``batch_id`` of each window and location.

    One ``max_by`` per measure keeps the buffers fixed-width, so this is a hash aggregate that
    combines on the map side, not a sort of all versions. A batch stored twice changes nothing.
    """
    newest = [F.max_by(name, "batch_id").alias(name) for name in AGGREGATE_MEASURES]
    return changelog.groupBy(*AGGREGATE_KEYS).agg(*newest)
