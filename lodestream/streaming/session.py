"""Settings of a streaming query's state."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Start a query in here: its state is kept in RocksDB, in ``partitions`` parts.

    The number of parts is fixed for the life of a query's checkpoint. It should fit
    the number of keys in state, not the rate of events; the session's number of shuffle partitions
    unless given.
    """
    wanted = {"spark.sql.streaming.stateStore.providerClass": _ROCKSDB}
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
