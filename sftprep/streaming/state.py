"""What a stream carries from one micro-batch to the next, so that a batch may run again.

Next to the output, in folders that readers of the output do not see, a stream keeps
``_ledger/<batch>.json`` (counters after that batch) and ``_<table>/batch=<id>`` (rows it still
needs). A batch reads what earlier batches left and writes under its own id; run
again after a failure it reads the same and overwrites what it wrote before. So every batch
costs one small file more, however many came before it.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..storage import list_files, path_exists, whole_file, write_text


class Carried:
    """Counters and rows of one stream, kept below the folder it writes to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _entry(self, batch_id: int) -> str:
        return f"{self.path}/_ledger/{batch_id}.json"

    def last(self, before: int | None = None) -> tuple[int, dict] | None:
        """(batch, counters) of the last batch, or of the last one before ``before``."""
        if before is not None and path_exists(self.spark, self._entry(before - 1)):
            found = before - 1
        else:
            folder = f"{self.path}/_ledger"
            files = list_files(self.spark, folder) if path_exists(self.spark, folder) else []
            ids = [int(f.rsplit("/", 1)[-1][:-5]) for f in files if f.endswith(".json")]
            ids = [i for i in ids if before is None or i < before]
            if not ids:
                return None
            found = max(ids)
        return found, json.loads(whole_file(self.spark, self._entry(found)))

    def put(self, batch_id: int, counters: dict) -> None:
        write_text(self.spark, self._entry(batch_id), json.dumps(counters))

    def table_path(self, name: str, batch_id: int) -> str:
        return f"{self.path}/_{name}/batch={batch_id}"

    def store(self, df: DataFrame, name: str, batch_id: int) -> DataFrame:
        """Write rows that later batches need, and read them back."""
        df.write.mode("overwrite").parquet(self.table_path(name, batch_id))
        return self.rows(name, batch_id, df.schema)

    def rows(self, name: str, batch_id: int, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.table_path(name, batch_id))


class ClosedAtEnd:
    """A streaming query whose last rows come out when its input has ended.

    ``awaitTermination`` waits for the query and then closes it; all else is the query's own.
    """

    def __init__(self, query: StreamingQuery, close: Callable[[], None]):
        self._query, self._close = query, close

    def awaitTermination(self, timeout: int | None = None) -> bool | None:
        done = self._query.awaitTermination() if timeout is None else self._query.awaitTermination(timeout)
        if timeout is None or done:
            self._close()
        return done

    def __getattr__(self, name: str):
        return getattr(self._query, name)
