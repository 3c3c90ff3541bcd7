"""Frames whose making runs jobs are made a few at a time."""

import threading

from clinlake import queries


def test_frames_are_made_side_by_side_in_order(spark):
    both = threading.Barrier(2, timeout=30)

    def step(n):
        both.wait()
        return spark.range(n)

    out = queries.side_by_side({"b": lambda: step(2), "a": lambda: step(3)})
    assert [(k, df.count()) for k, df in out.items()] == [("b", 2), ("a", 3)]
