"""Hourly averages as database tables, one per metric."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from wellgauge.config import JdbcTarget
from wellgauge.sources.tables import of_metric


def write_metrics(
    hourly: DataFrame,
    target: JdbcTarget,
    metrics: Iterable[str],
    mode: str = "overwrite",
) -> None:
    """Write each metric of the stored hourly table to a database table.

    Overwriting empties the table but keeps its definition. It can be repeated
    after a failure; ``mode="append"`` cannot, it adds the rows once more.
    """
    for metric in metrics:
        of_metric(hourly, metric).write.option("truncate", "true").jdbc(
            url=target.url,
            table=f"{target.table_prefix}{metric}",
            mode=mode,
            properties=target.properties(),
        )
