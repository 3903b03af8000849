"""Sources as a Spark data source: spark.read.format("tidemark"), and readStream.

Options: sources (JSON, rows of the registry), as_of (what the ranges asked for end with; now if not given), start, end, and for
streams interval_seconds. Each source is an input partition, so its requests are one task's and a source that hangs or fails
keeps no other; the rows are those of collect.PAYLOAD, ready for collect.documents.

A stream polls at most once an interval: its offset is the number of the interval since 1970, so a run that starts within the interval of the
last one finds nothing new. A batch that is repeated after a failure asks again; landing by identity makes that harmless.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tidemark.sources import collect


@dataclass
class OneSource(InputPartition):
    """A source as collect.source_row gives it."""

    source: str


class _Asked:
    """What both readers share."""

    def __init__(self, options, fetch: collect.Fetch):
        rows = json.loads(options.get("sources", "[]"))
        self.sources = [collect.source_row(r) for r in rows if r.get("enabled", True)]
        self.as_of, self.start, self.end = options.get("as_of"), options.get("start"), options.get("end")
        self.fetch = fetch
        self.environment = dict(os.environ)

    def parts(self) -> list[OneSource]:
        return [OneSource(json.dumps(s)) for s in self.sources]

    def read(self, partition: OneSource) -> Iterator[tuple]:
        as_of = self.as_of or dt.datetime.now(dt.timezone.utc).isoformat()
        source = json.loads(partition.source)
        for i, row in enumerate(collect.fetch_source(source, as_of, self.fetch, self.environment, self.start, self.end)):
            if i and source.get("delay_seconds"):
                time.sleep(source["delay_seconds"])
            yield row


class BatchReader(_Asked, DataSourceReader):
    def partitions(self) -> list[OneSource]:
        # a table needs a partition; one without a source gives no rows
        return self.parts() or [OneSource("")]

    def read(self, partition: OneSource) -> Iterator[tuple]:
        return super().read(partition) if partition.source else iter(())


class StreamReader(_Asked, DataSourceStreamReader):
    def __init__(self, options, fetch: collect.Fetch):
        super().__init__(options, fetch)
        self.interval = float(options.get("interval_seconds", 3600))

    def _slot(self) -> int:
        return int(time.time() // self.interval)

    def initialOffset(self) -> dict:  # noqa: N802
        return {"slot": self._slot() - 1}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"slot": self._slot()}

    def partitions(self, start: dict, end: dict) -> list[OneSource]:
        return self.parts() if end["slot"] > start["slot"] else []

    def commit(self, end: dict) -> None:
        pass


def register(spark: SparkSession, fetch: collect.Fetch = collect.http_fetch) -> None:
    """Makes format("tidemark") known to the session; fetch sends the requests."""

    class Sources(DataSource):
        @classmethod
        def name(cls) -> str:
            return "tidemark"

        def schema(self) -> str:
            return collect.PAYLOAD

        def reader(self, schema) -> BatchReader:
            return BatchReader(self.options, fetch)

        def streamReader(self, schema) -> StreamReader:  # noqa: N802
            return StreamReader(self.options, fetch)

    spark.dataSource.register(Sources)
