"""Line protocol to a time-series store's HTTP write endpoint."""

from __future__ import annotations

import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "line_protocol_http"
# Answers of a store that is busy for now, and how often and how long to wait for it.
BUSY = (429, 503)
RETRIES = 6
LONGEST_WAIT = 30.0


@dataclass
class LinesWritten(WriterCommitMessage):
    lines: int


class _LineWriter(DataSourceArrowWriter):
    """Each task posts its own lines in blocks.

    A point is identified by measurement, tags and time, so a task that runs
    again after a failure writes the same points once more, not additional ones.
    """

    def __init__(self, options: dict[str, str]) -> None:
        query = urllib.parse.urlencode(
            {"org": options["org"], "bucket": options["bucket"], "precision": "ns"}
        )
        self.endpoint = f"{options['url'].rstrip('/')}/api/v2/write?{query}"
        self.token = options["token"]
        self.block = int(options.get("block_lines", "5000"))
        self.timeout = float(options.get("timeout_seconds", "30"))
        first = float(options.get("first_wait_seconds", "1"))
        self.waits = [min(first * 2**n, LONGEST_WAIT) for n in range(RETRIES)]

    def _post(self, lines: list[str]) -> None:
        request = urllib.request.Request(
            self.endpoint,
            data="\n".join(lines).encode("utf-8"),
            headers={
                "Authorization": f"Token {self.token}",
                "Content-Type": "text/plain; charset=utf-8",
            },
            method="POST",
        )
        for wait in (*self.waits, None):
            try:
                with urllib.request.urlopen(request, timeout=self.timeout):
                    return
            except urllib.error.HTTPError as error:
                # A busy store is asked again; any other error fails the task.
                if wait is None or error.code not in BUSY:
                    raise
                asked = error.headers.get("Retry-After", "") if error.headers else ""
                time.sleep(min(float(asked), LONGEST_WAIT) if asked.isdigit() else wait)

    def write(self, iterator: Iterator) -> LinesWritten:
        written = 0
        for batch in iterator:
            lines = batch.column("line")
            for start in range(0, len(lines), self.block):
                block = lines.slice(start, self.block).to_pylist()
                self._post(block)
                written += len(block)
        return LinesWritten(written)


class LineProtocolHttp(DataSource):
    """Write-only source; options ``url org bucket token block_lines timeout_seconds first_wait_seconds``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> _LineWriter:
        return _LineWriter(dict(self.options))


def post_lines(
    lines: DataFrame,
    *,
    url: str,
    org: str,
    bucket: str,
    token: str | None,
    writers: int | None = None,
    block_lines: int = 5000,
) -> None:
    """Post a ``line`` column.

    ``writers`` bounds how many tasks call the store at once. Those tasks then also
    read and convert the rows, which is little work next to the requests.
    """
    if not token:
        raise ValueError("a token for the point store is required")
    lines.sparkSession.dataSource.register(LineProtocolHttp)
    limited = lines if writers is None else lines.coalesce(writers)
    (
        limited.write.format(FORMAT)
        .options(url=url, org=org, bucket=bucket, token=token, block_lines=str(block_lines))
        .mode("append")
        .save()
    )
