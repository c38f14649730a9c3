"""Incremental runs: only what has no finished output yet, as a stream that stops when it has caught up, and page collection as state.

What a batch writes goes to a folder of its run and number, which is replaced when the batch is run again: a failure between a write and the stream's
own commit leaves nothing twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_BUCKETS = 64
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _folders(spark: SparkSession, path: str) -> list[str]:
    """The folders in a folder, none if it is not there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in system.listStatus(where) if s.isDirectory()] if system.exists(where) else []


def _finished(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream whose checkpoint this is; it stays the same when the stream is started again."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


def once(sink: str, checkpoint: str, made: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each batch to ``run=.../batch=...`` below the sink, in place of what an earlier attempt wrote."""

    def write(batch: DataFrame, number: int) -> None:
        made(batch).write.mode("overwrite").parquet(f"{sink}/run={run_of(batch.sparkSession, checkpoint)}/batch={number}")

    return write


def read_batches(spark: SparkSession, sink: str) -> DataFrame:
    """What :func:`once` wrote, of all runs."""
    return spark.read.parquet(sink).drop("run", "batch")


def run_pending(spark: SparkSession, source: str, schema, sink: str, checkpoint: str, work: Callable[[DataFrame], DataFrame], key: str) -> None:
    """Applies ``work`` to the rows of new files in ``source`` whose key has no output yet, and adds the results (see :func:`read_batches`).

    The stream's checkpoint remembers which files were seen. The keys of all outputs lie beside the sink in buckets by their hash, a folder for each batch; a
    batch reads the buckets of its own keys and never the outputs. A batch that is run again replaces its rows and its keys. A key that ``work`` gives nothing for stays
    pending, and is tried again when it comes again. Timestamps play no part.
    """
    done = f"{sink}-keys"
    bucket = F.pmod(F.xxhash64(key), F.lit(_BUCKETS)).cast("int").alias("bucket")

    def note(place: str) -> None:
        rows = spark.read.parquet(f"{sink}/{place}")
        rows.select(F.col(key).alias("_key"), bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{done}/{place}")

    places = [f"{run}/{batch}" for run in _folders(spark, sink) for batch in _folders(spark, f"{sink}/{run}")]
    for place in places:  # of batches that failed between the two writes and never ran again
        if _finished(spark, f"{sink}/{place}") and not _finished(spark, f"{done}/{place}"):
            note(place)

    def write(batch: DataFrame, number: int) -> None:
        run = run_of(spark, checkpoint)
        rows = work(batch.dropDuplicates([key]))
        if _folders(spark, done):
            met = [r.bucket for r in batch.select(bucket).distinct().collect()]  # at most as many as there are
            fields = f"_key {dict(rows.dtypes)[key]}, run string, batch long, bucket int"
            seen = spark.read.schema(fields).parquet(done).where(F.col("bucket").isin(met) & ~((F.col("run") == run) & (F.col("batch") == number)))
            rows = rows.join(seen.select("_key"), F.col(key) == F.col("_key"), "left_anti")
        place = f"run={run}/batch={number}"
        rows.write.mode("overwrite").parquet(f"{sink}/{place}")
        note(place)

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


_COLLECTED = "doc string, num_pages int, markdown string, total_token_count long"


class _Pages(StatefulProcessor):
    """Keeps each page of a document by its number; what has come before is read once, when the last page is there."""

    def __init__(self, milliseconds: int) -> None:
        self.milliseconds = milliseconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pages = handle.getMapState("pages", "page_num int", "markdown string, tokens long")
        self.about = handle.getValueState("about", "have int, abandoned boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        have, abandoned = self.about.get() if self.about.exists() else (0, False)
        expected = 0
        for batch in rows:
            expected = int(batch["expected_pages"].max())
            if not abandoned and bool(batch["error"].fillna(False).any()):
                abandoned = True
                self.pages.clear()
            for row in () if abandoned else batch.itertuples():
                if not self.pages.containsKey((int(row.page_num),)):
                    self.pages.updateValue((int(row.page_num),), (row.markdown or "", int(row.token_count)))
                    have += 1
        if not abandoned and have == expected:
            pages = sorted((number[0], *page) for number, page in self.pages.iterator())
            self._forget()
            yield pd.DataFrame({"doc": [key[0]], "num_pages": [expected], "markdown": ["".join(p[1] for p in pages)], "total_token_count": [sum(p[2] for p in pages)]})
            return
        self.about.update((have, abandoned))
        if self.milliseconds:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.milliseconds)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._forget()
        yield pd.DataFrame()

    def _forget(self) -> None:
        self.pages.clear()
        self.about.clear()
        for timer in list(self.handle.listTimers()) if self.milliseconds else ():
            self.handle.deleteTimer(timer)

    def close(self) -> None:
        pass


def collect_pages(pages: DataFrame, forget_after: str | None = None) -> DataFrame:
    """Documents of a stream of ``pages(doc, page_num, expected_pages, markdown, token_count, error)``, each once it is complete.

    State holds each page by itself until all have come, so a batch costs what its own pages do, however many came before. A document with a failed
    page is abandoned: nothing is emitted for it, and its later pages are ignored; only a mark of it is left in the state. A stream that runs on should
    say ``forget_after`` (like ``7 days``): a document, abandoned or incomplete, of which nothing has come for so long leaves the state, so that the
    state does not grow for ever; like all that gave no output it stays pending. Without it the state keeps them, as a run that ends when it has caught up needs.
    The session's state store is set to the one that this kind of state lives in.
    """
    milliseconds = int(pd.Timedelta(forget_after).total_seconds() * 1000) if forget_after else 0
    pages.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    return pages.groupBy("doc").transformWithStateInPandas(_Pages(milliseconds), _COLLECTED, "append", "processingTime" if milliseconds else "none")
