"""The model as a pluggable batch function: windows in, detections out."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame

SCHEMA = "scene string, row int, col int, confidence double, xmin double, ymin double, xmax double, ymax double"

#: Batches whose detections leave a task together.
JOINED = 128


def checked_task(description: dict, task: str = "segment") -> dict:
    """A model's description; one that does another task is an error."""
    if description.get("task") != task:
        raise ValueError(f"the model does {description.get('task')!r}, not {task!r}")
    return description


def detect(windows: DataFrame, load_model: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], batch: int = 8) -> DataFrame:
    """Runs a model over windows; it is loaded once a task and gets `batch` windows at a time.

    What it finds leaves a task joined from JOINED batches, as each table that does costs as much as many windows.
    """

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for frame in frames:
            found = (model(frame.iloc[i : i + batch]) for i in range(0, len(frame), batch))
            while some := list(islice(found, JOINED)):
                yield pd.concat(some, ignore_index=True)

    return windows.mapInPandas(work, SCHEMA)


def stub_model() -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A model that finds one box a window, from the window's place alone."""

    def model(frame: pd.DataFrame) -> pd.DataFrame:
        row, col = (frame[c].to_numpy() for c in ("row", "col"))
        k = (row // 512 * 31 + col // 512 * 17) % 100
        out = {"scene": frame["scene"].to_numpy(), "row": row, "col": col, "confidence": k / 100}
        out |= {"xmin": 10.0 + k, "ymin": 20.0 + k, "xmax": 110.0 + k, "ymax": 100.0 + k}
        return pd.DataFrame(out)

    return model
