"""A folder of CSV files as a stream: each file once, by path, with the checkpoint as the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from reelgap.plans.imports import Settings, import_files
from reelgap.sources.store import Store


def watch_folder(spark: SparkSession, store: Store, folder: str, checkpoint: str, settings: Settings | None = None, once: bool = False) -> StreamingQuery:
    """Import files as they arrive; with ``once``, those that are there, and stop.

    The stream lists paths only, since each file has its own header; a batch imports its files in order of name. A file
    that fails is noted in the table ``imports`` and the others go on; a batch that runs again changes nothing.
    """

    def batch(files: DataFrame, _: int) -> None:
        import_files(spark, store, sorted(map(tuple, files.select("path", "length", "modificationTime").collect())), settings)

    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.[cC][sS][vV]").load(folder)
    writer = files.select("path", "length", "modificationTime").writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="500 milliseconds")).start()
