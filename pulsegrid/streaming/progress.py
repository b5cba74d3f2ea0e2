"""Progress that a run tells: events with rising numbers, in a folder that others read as a batch or a stream, and as lines for people."""

from __future__ import annotations

import json
from datetime import UTC, datetime
from typing import TextIO

from pyspark.sql import SparkSession

from pulsegrid.contracts import EVENT_VERSION, ContractError, safe_identifier
from pulsegrid.functions.storage import exists, put_text


def human_line(event: dict) -> str:
    part = event.get("progress")
    return f"[{event['module']}:{event['operation']}] {event['message']}" + (f" ({part['current']}/{part['total']})" if part else "")


class ProgressLog:
    """The events of one run under folder/events; one file each, which appears whole or not at all.

    A run that was stopped goes on behind the last number that is there. A number that is not higher than all before, or
    that another start of the run has taken in the meantime, is refused.
    """

    def __init__(self, spark: SparkSession, folder: str, run_id: str, lines: TextIO | None = None):
        self.spark, self.folder, self.run_id, self.lines = spark, f"{folder}/events", safe_identifier(run_id, "run_id"), lines
        self.last = 0
        while exists(spark, self._file(self.last + 1)):  # some ten for a run, one for each batch of units
            self.last += 1

    def _file(self, number: int) -> str:
        return f"{self.folder}/{number:08d}.json"

    def record(self, sequence: int, module: str, operation: str, message: str, level: str = "info", progress: tuple[int, int] | None = None) -> dict:
        """Keep and show an event of this number."""
        if sequence <= self.last:
            raise ContractError("event sequence must increase monotonically")
        if progress is not None and not 0 <= progress[0] <= progress[1]:
            raise ContractError("progress must lie between nothing and its total")
        event = {"schema_version": EVENT_VERSION, "run_id": self.run_id, "sequence": sequence, "timestamp": datetime.now(UTC).isoformat(), "module": module, "operation": operation, "level": level, "message": message}
        if progress is not None:
            event["progress"] = {"current": progress[0], "total": progress[1]}
        put_text(self.spark, self._file(sequence), json.dumps(event, sort_keys=True, separators=(",", ":")) + "\n", replace=False)
        self.last = sequence
        if self.lines is not None:
            print(human_line(event), file=self.lines, flush=True)
        return event

    def emit(self, module: str, operation: str, message: str, level: str = "info", progress: tuple[int, int] | None = None) -> dict:
        """The next event."""
        return self.record(self.last + 1, module, operation, message, level, progress)
