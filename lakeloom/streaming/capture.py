"""The same change capture over a stream: each micro-batch is one load of the store."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..context import LoadContext
from ..plans.loads import run_ods
from ..sources.store import TableStore


def capture_stream(events: DataFrame, store: TableStore, name: str, keys: list[str], attrs: list[str], version: str, checkpoint: str, status: str = "ce_type", strategy: str = "es", clock: Callable[[int], datetime] | None = None) -> StreamingQuery:
    """Runs over what there is and stops. A batch that is replayed changes nothing: its versions are known.

    ``clock`` gives the time of a batch by its number; by default it is the time it runs at.
    """

    def batch(rows: DataFrame, number: int) -> None:
        ctx = LoadContext(clock(number) if clock else datetime.now(), f"{name}-{number}")
        run_ods(store, name, rows, keys, attrs, version, ctx, strategy, status)

    return events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
