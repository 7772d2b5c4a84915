"""A landing folder watched by Structured Streaming: every delivery is one gated load.

A delivery is a folder of files with a marker file, written last by the producer, that says it is
complete (at least one byte long: Spark's file sources pass over empty files). The stream watches the markers only; a marker loads its whole folder, however many files
it holds, so a delivery is never cut over micro-batches. Markers that arrive together are loaded one
after the other, oldest first. The driver sees one short row per delivery; executors read the files.
The stream's checkpoint lives in the shared folder, so a restarted query resumes after the last
committed batch. A batch that fails after its publish is replayed; the load replaces the table's
content, so the replay is idempotent.

A bad delivery never stops the stream. Whatever a load says against one delivery (failed checks, ragged
rows, a structure that cannot follow, a broken post-load check, files that are gone or unreadable) is
that delivery's outcome: the table keeps its rows, ``on_result`` sees the refusal and the next delivery
is loaded. Only what says nothing about the delivery (a lost connection to Spark, say) ends the query.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from py4j.protocol import Py4JJavaError, Py4JNetworkError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..contract import Contract, ContractError
from ..plans.apply import LoadResult, apply_contract
from ..session import scratch_path


# A name that Spark's file sources do not skip (they skip a leading _ or .).
MARKER = "delivery.done"


@dataclass
class Refused:
    """A delivery that was not loaded, and why. ``cause`` is what the load raised."""

    delivery: str
    cause: Exception

    @property
    def reason(self) -> str:
        return f"{type(self.cause).__name__}: {self.cause}"


def load_delivery(spark: SparkSession, contract: Contract, environment: str, delivery: str,
                  pattern: str = "*.csv") -> LoadResult | Refused:
    """One gated load; what speaks against the delivery is returned, not raised."""
    try:
        return apply_contract(spark, contract, environment, f"{delivery}/{pattern}")
    except Py4JNetworkError:
        raise  # the session is gone: nothing was decided about the delivery
    except (ContractError, PySparkException, Py4JJavaError) as e:
        return Refused(delivery, e)


def watch_landing(
    spark: SparkSession,
    contract: Contract,
    environment: str,
    folder: str,
    *,
    pattern: str = "*.csv",
    marker: str = MARKER,
    checkpoint: str | None = None,
    available_now: bool = False,
    on_result: Callable[[int, LoadResult | Refused], None] | None = None,
) -> StreamingQuery:
    """Start the watcher: each ``<folder>/<delivery>/<marker>`` loads ``<folder>/<delivery>/<pattern>``.
    ``on_result(batch_id, outcome)`` sees each load's result or its refusal."""
    markers = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", marker)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "modificationTime")
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        for r in batch.orderBy("modificationTime", "path").collect():  # one row per delivery
            out = load_delivery(s, contract, environment, r.path.rsplit("/", 1)[0], pattern)
            if on_result is not None:
                on_result(batch_id, out)

    writer = markers.writeStream.foreachBatch(load).option(
        "checkpointLocation", checkpoint or scratch_path(spark, "streams", contract.physical_name)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
