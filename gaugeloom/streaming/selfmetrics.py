"""Self-metrics of streams: every micro-batch's own counts, taken while it runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from gaugeloom.operators.stats import run_points

_GATHERED, _ERRORS = "gathered ", "gather errors"


def watched(points: DataFrame, name: str) -> DataFrame:
    """The points of an input, counted in every micro-batch before what follows may drop some."""
    return points.observe(_GATHERED + name, F.count(F.lit(1)).alias("n"))


def watched_errors(errors: DataFrame) -> DataFrame:
    return errors.observe(_ERRORS, F.count(F.lit(1)).alias("n"))


class GatherListener(StreamingQueryListener):
    """Hands on ``(run, batch, gathered, errors)`` of every micro-batch that holds a watched frame.

    The counts come with the batch's progress, so nothing is read for them. A batch that is run again after a failure is
    reported again under its number.
    """

    def __init__(self, sink: Callable[[str, int, dict[str, int], int], None]):
        self.sink = sink

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = {name: int(row["n"]) for name, row in progress.observedMetrics.items() if name == _ERRORS or name.startswith(_GATHERED)}
        if counts:
            errors = counts.pop(_ERRORS, 0)
            self.sink(progress.name or str(progress.id), int(progress.batchId), {n.removeprefix(_GATHERED): c for n, c in counts.items()}, errors)


def to_folder(spark: SparkSession, path: str) -> Callable[[str, int, dict[str, int], int], None]:
    """Writes each batch's self-metrics as points in a folder of its own, so a repeated batch replaces itself."""
    def save(run: str, batch: int, gathered: dict[str, int], errors: int) -> None:
        run_points(spark, gathered, errors, F.current_timestamp()).coalesce(1).write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch}")

    return save
