"""Export to an external SQL warehouse over JDBC.

``export_jdbc`` appends a frame to a named table (the warehouse's JDBC
driver jar must be on the cluster's classpath); parameterised statements
run through ``catalog.query(sql, args=...)`` on Spark itself. Nothing here
starts or embeds a database.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame

log = logging.getLogger(__name__)


def export_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
                num_partitions: int | None = None, batch_size: int = 10_000) -> None:
    """Append ``df`` to ``table`` at ``url``; ``num_partitions`` bounds the
    number of concurrent connections (coalesce, no shuffle)."""
    out = df.coalesce(num_partitions) if num_partitions else df
    props = {"batchsize": str(batch_size), **(properties or {})}
    log.info("appending to %s", table)
    out.write.jdbc(url=url, table=table, mode="append", properties=props)
