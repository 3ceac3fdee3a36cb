"""Replay of a table as a stream, arrival by arrival, restarted each time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


class Replay:
    """Runs a stream over folders of files that arrive one after the other.

    ``build`` makes the stream's result from its source.  Every ``arrive`` adds
    rows to the source folder and runs the query on what is new, from its
    checkpoint: the query is started anew each time, as after a lost driver.
    Source, checkpoint and result lie under the session's checkpoint folder.
    """

    def __init__(self, spark: SparkSession, schema, build: Callable[[DataFrame], DataFrame],
                 name: str, path: str | None = None):
        self.spark, self.schema, self.build = spark, schema, build
        self.path = path or scratch_path(spark, name)
        #: Microseconds since 1970, None before the first rows.
        self.watermark: int | None = None
        self.state_rows = 0

    def arrive(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.path}/source")
        self.run()

    def run(self) -> None:
        """Process what the source holds and is not processed yet."""
        stream = self.spark.readStream.schema(self.schema).parquet(f"{self.path}/source")
        result = self.build(stream)
        query = (result.writeStream.outputMode("append").format("parquet")
                 .option("checkpointLocation", f"{self.path}/checkpoint")
                 .trigger(availableNow=True).start(f"{self.path}/result"))
        query.awaitTermination()
        self.result_schema = result.schema
        for progress in query.recentProgress:
            seen = progress["eventTime"].get("watermark", "1970-01-01T00:00:00.000Z")
            mark = dt.datetime.fromisoformat(seen) - dt.datetime.fromtimestamp(0, dt.UTC)
            if mark:
                self.watermark = mark // dt.timedelta(microseconds=1)
            if progress["stateOperators"]:
                self.state_rows = progress["stateOperators"][0]["numRowsTotal"]

    def table(self) -> DataFrame:
        """What the stream has written so far."""
        return self.spark.read.schema(self.result_schema).parquet(f"{self.path}/result")
