"""What a running stream says about itself: counters of its batches, and its watermarks.

Both come from the progress that Spark reports after each micro-batch, so no data is read again.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from fleetpulse.schema import UNIT
from fleetpulse.sources.frames import REJECT
from fleetpulse.sources.versions import Folder

_ZERO = "1970-01-01"


def observed(frames: DataFrame, name: str, *counters: Column) -> DataFrame:
    """Rows whose counters are observed as they pass: by default, of decoded frames, all, the
    accepted ones, the rejected ones and those of no unit."""
    if counters:
        return frames.observe(name, *counters)
    reason = F.col(REJECT) if REJECT in frames.columns else F.lit(None).cast("string")
    return frames.observe(
        name,
        F.count(F.lit(1)).alias("frames"),
        F.count_if(reason.isNull()).alias("accepted"),
        F.count_if(reason.isNotNull()).alias("rejected"),
        F.count_if(F.col(UNIT).isNull()).alias("without_unit"),
    )


class LiveCounters(StreamingQueryListener):
    """Totals of observed streams, by the name they are observed under, while they run.

    Register it with ``spark.streams.addListener``. A batch that Spark reports again, as after a
    restart, replaces its own numbers.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._batches: dict[str, dict[tuple[str, int], dict[str, int]]] = {}
        self.seen: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, row in progress.observedMetrics.items():
            with self._lock:
                batches = self._batches.setdefault(name, {})
                batches[(str(progress.id), progress.batchId)] = row.asDict()
        self.seen[str(progress.id)] = progress.batchId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def totals(self, name: str) -> dict[str, int]:
        """The sums over all batches so far, and their number as ``batches``."""
        with self._lock:
            rows = list(self._batches.get(name, {}).values())
        sums = {key: sum(r[key] for r in rows) for r in rows[:1] for key in r}
        return {"batches": len(rows), **sums}


class WatermarkLog(StreamingQueryListener):
    """Writes down the watermark after each micro-batch of the streams it is registered for.

    One small file a change lies in ``path``, best beside the checkpoint, so it outlives the run.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._folder = Folder(spark, path)
        self._last = ""
        self.seen: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        mark = dict(event.progress.eventTime).get("watermark", _ZERO)
        query, batch = str(event.progress.id), event.progress.batchId
        if not mark.startswith(_ZERO) and mark != self._last:
            stamp = {"query": query, "batch": batch, "watermark": mark}
            self._folder.create(f"{batch:010d}-{uuid.uuid4().hex}.json", json.dumps(stamp))
            self._last = mark
        self.seen[query] = batch

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def settle(listener: LiveCounters | WatermarkLog, query: StreamingQuery, seconds: float = 60) -> None:
    """Wait until a listener has been told of the last batch of a query; reports come late."""
    until = time.monotonic() + seconds
    while query.lastProgress is not None and listener.seen.get(str(query.id), -1) < query.lastProgress.batchId:
        if time.monotonic() > until:
            raise TimeoutError(f"no report of batch {query.lastProgress.batchId}")
        time.sleep(0.05)


def last_watermark(spark: SparkSession, path: str) -> datetime | None:
    """The highest watermark written down; None if a stream never had one."""
    folder = Folder(spark, path)
    marks = [json.loads(folder.text(e.path))["watermark"] for e in folder.find("[0-9]*.json")[-16:]]
    times = [datetime.fromisoformat(m.replace("Z", "+00:00")) for m in marks]
    return max(times, default=None)


def utc_text(moment: datetime) -> str:
    return moment.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
