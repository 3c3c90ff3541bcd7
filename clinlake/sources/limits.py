"""Admission limits of file streams: how much one micro-batch takes from a backlog."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame

PER_FILE = 8


@dataclass(frozen=True)
class BatchLimit:
    """Most files, or most bytes, of one micro-batch; a single larger file makes a batch of its own.

    With ``availableNow`` a run still drains the whole backlog that it finds, in
    several batches, each with a commit of its own: a run that ends in between goes on
    after the last whole batch.
    """

    files: int | None = None
    size: int | None = None

    def __post_init__(self) -> None:
        if self.files is not None and self.size is not None:
            raise ValueError("limit files or bytes, not both")
        if any(v is not None and v < 1 for v in (self.files, self.size)):
            raise ValueError("a limit is at least one")

    def packed(self, df: DataFrame) -> DataFrame:
        """A limited stream whose batches write one file per ``PER_FILE`` files that they read.

        The next table's stream is limited by files as well: one file per task of every batch would multiply the batches from table to table.
        """
        return df if self.files is None else df.coalesce(math.ceil(self.files / PER_FILE))

    def on(self, reader):
        """A stream reader with the limit set."""
        if self.files is not None:
            reader = reader.option("maxFilesPerTrigger", self.files)
        if self.size is not None:
            reader = reader.option("maxBytesPerTrigger", self.size)
        return reader


NO_LIMIT = BatchLimit()
