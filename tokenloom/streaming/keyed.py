"""One small value per key in the state store.

``transformWithState`` reads and writes only the keys that a micro-batch holds; the store logs those changes, so the state of
other keys is not written again. A micro-batch that failed is replayed on the state before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

STORE = "spark.sql.streaming.stateStore.providerClass"
#: The key as text: a NULL would not be equal to itself in Python, and its rows would come one by one.
KEY = "_state_key"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class RunningValue(StatefulProcessor):
    """A value per key that ``update(value, rows)`` carries over rows sorted by ``order``.

    It returns the rows with what was computed and the value after them. The rows of a key in one micro-batch are sorted in
    one task: keep them narrow, the trigger bounds their number.
    """

    def __init__(self, order: str, start: float, update) -> None:
        self.order, self.start, self.advance = order, start, update

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("value", "value double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # A call of the state store is a round trip to the JVM, and a frame of a few rows costs more than they do: of each as few as may be.
        parts = list(rows)
        log = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        if not log[self.order].is_monotonic_increasing:
            log = log.sort_values(self.order, kind="stable", ignore_index=True)
        held = self.held.get()
        before = self.start if held is None else held[0]
        out, after = self.advance(before, log.drop(columns=KEY, errors="ignore"))
        if after != before or held is None:
            self.held.update((float(after),))
        yield out

    def close(self) -> None:
        pass


def run_keyed(stream: DataFrame, key: str, processor: StatefulProcessor, schema: StructType | str, folder: str) -> StreamingQuery:
    """Start the processor over everything available; rows are appended to ``folder/output`` exactly once."""
    name = F.col(key).cast("string")
    keyed = stream.withColumn(KEY, F.coalesce(F.concat(F.lit("="), name), F.lit("")))
    conf = stream.sparkSession.conf
    before = conf.get(STORE, None)
    conf.set(STORE, ROCKSDB)  # read once, when the query starts
    try:
        return (
            keyed.groupBy(KEY)
            .transformWithStateInPandas(processor, outputStructType=schema, outputMode="Append", timeMode="None")
            .writeStream.format("parquet")
            .option("path", f"{folder}/output")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        if before is None:
            conf.unset(STORE)
        else:
            conf.set(STORE, before)


def kl_update(target: float, horizon: int, limit: float):
    """Multiply the coefficient by 1 + clip(kl / target - 1) * n / horizon at each step."""

    def update(coef: float, log: pd.DataFrame) -> tuple[pd.DataFrame, float]:
        error = np.clip(log["kl"] / target - 1, -limit, limit)
        values = coef * np.cumprod((error * log["n"] / float(horizon) + 1.0).to_numpy(float))
        return log.assign(kl_coef=values), values[-1]

    return update


def best_update(best: float, log: pd.DataFrame) -> tuple[pd.DataFrame, float]:
    """The least loss before each step, and whether the step is saved."""
    least = np.fmin.accumulate(np.concatenate([[best], log["val_loss"].to_numpy(float)]))
    before = least[:-1]
    improved = (log["val_loss"] < before).to_numpy()
    return log.assign(best_before=before, improved=improved, saved=improved & (log["step"] > 0).to_numpy()), least[-1]
