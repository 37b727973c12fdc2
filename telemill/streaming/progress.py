"""The life of one running query in the log; its batches log themselves as they finish."""

from __future__ import annotations

import logging

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class BatchLogger(StreamingQueryListener):
    """Logs when a query starts, waits, ends or fails; register it with `spark.streams.addListener`.

    `query` is a query or the name of one; other queries of the session are none of its business.
    """

    def __init__(self, query: StreamingQuery | str, logger: logging.Logger | None = None):
        self.name = query if isinstance(query, str) else query.name
        self.ids = set() if isinstance(query, str) else {str(query.id)}
        self.logger = logger or logging.getLogger("telemill.streaming")

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.ids.add(str(event.id))
            self.logger.info("%s: started", self.name)

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        if str(event.id) in self.ids:
            self.logger.info("%s: no new segments", self.name)

    def onQueryTerminated(self, event) -> None:
        if str(event.id) not in self.ids:
            return
        if event.exception:
            self.logger.error("%s: failed: %s", self.name, event.exception)
        else:
            self.logger.info("%s: ended", self.name)
