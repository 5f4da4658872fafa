"""``df.write.format(...)`` sink for an external profile service.

Built on Spark's Python data source API: subclass ``ProfileServiceSink``,
implement ``send(records)`` (for example an HTTP client call), register the
class once, then write any store with the DataFrame writer::

    class Upload(ProfileServiceSink):
        def send(self, records):
            client.post(records)          # runs inside the write tasks

    spark.dataSource.register(Upload)
    store.write.format(Upload.name()).option("dataset_id", "orders").mode("append").save()

Each task sends its rows in batches of ``batch_size`` records; every record
carries ``key = dataset_id/period/column`` so the service can drop repeats
when Spark retries a task.  ``on_commit`` runs once, after all tasks
succeeded, with the number of records delivered.

The same class takes a stream of profiles (``profile_stream_windowed``)::

    store.writeStream.format(Upload.name()).option("dataset_id", "orders")
         .option("checkpointLocation", ...).start()

Every epoch (micro-batch) is delivered by its tasks and committed once on the
driver by ``on_epoch``.  A stream that is started again after a failure repeats
its last epoch, so delivery is idempotent twice over: records of an epoch carry
``key = dataset_id/epoch/period/column``, the same ones when they are sent again,
and an epoch that ``delivered`` says is committed is not sent at all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

PERIOD_COLUMN = "dataset_ts"


@dataclass
class Delivered(WriterCommitMessage):
    partition: int
    records: int


class ProfileServiceSink(DataSource):
    """Base class of service sinks; options: ``dataset_id`` (required),
    ``batch_size`` (default 100)."""

    @classmethod
    def name(cls) -> str:
        return "strata_service"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if "dataset_id" not in self.options:
            raise ValueError("option dataset_id is required")
        return _ServiceWriter(self)

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:
        if "dataset_id" not in self.options:
            raise ValueError("option dataset_id is required")
        return _ServiceStreamWriter(self)

    # -- hooks ------------------------------------------------------------
    def send(self, records: list[dict]) -> None:  # pragma: no cover - user hook
        raise NotImplementedError("subclass ProfileServiceSink and implement send()")

    def on_commit(self, delivered: int) -> None:
        """Called once on the driver side after every task succeeded."""

    def delivered(self, epoch: int) -> bool:
        """Asked by the tasks of a stream: is this epoch committed already?"""
        return False

    def on_epoch(self, epoch: int, delivered: int) -> None:
        """Called on the driver side after every task of a stream's epoch succeeded;
        may be called again for the last epoch after a restart."""


class _Sending:
    """What batch and stream writers share: records with keys, sent in batches."""

    def __init__(self, sink: ProfileServiceSink):
        self.sink = sink
        self.dataset_id = sink.options["dataset_id"]
        self.batch_size = int(sink.options.get("batch_size", 100))

    def _record(self, row, prefix: str) -> dict:
        rec = row.asDict()
        ts = rec.get(PERIOD_COLUMN)
        period = ts.isoformat() if ts is not None else "all"
        rec["key"] = f"{prefix}/{period}/{rec.get('column')}"
        return rec

    def _send(self, iterator, prefix: str) -> Delivered:
        from pyspark import TaskContext

        ctx = TaskContext.get()
        batch, sent = [], 0
        for row in iterator:
            batch.append(self._record(row, prefix))
            if len(batch) >= self.batch_size:
                self.sink.send(batch)
                sent += len(batch)
                batch = []
        if batch:
            self.sink.send(batch)
            sent += len(batch)
        return Delivered(ctx.partitionId() if ctx else 0, sent)


class _ServiceWriter(_Sending, DataSourceWriter):
    def write(self, iterator) -> Delivered:
        return self._send(iterator, self.dataset_id)

    def commit(self, messages: list[Delivered]) -> None:
        self.sink.on_commit(sum(m.records for m in messages if m is not None))

    def abort(self, messages: list[Delivered]) -> None:
        """Nothing to undo: the service deduplicates by key on the retry."""


class _ServiceStreamWriter(_Sending, DataSourceStreamWriter):
    def write(self, iterator) -> Delivered:
        from pyspark import TaskContext

        # Spark tells its tasks the epoch (the micro-batch's number) by this property
        epoch = int(TaskContext.get().getLocalProperty("streaming.sql.batchId"))
        if self.sink.delivered(epoch):
            return Delivered(TaskContext.get().partitionId(), 0)
        return self._send(iterator, f"{self.dataset_id}/{epoch}")

    def commit(self, messages: list[Delivered], batchId: int) -> None:
        self.sink.on_epoch(batchId, sum(m.records for m in messages if m is not None))

    def abort(self, messages: list[Delivered], batchId: int) -> None:
        """Nothing to undo: the epoch is sent again under the same keys."""
