"""Micro-batches that hand a value per key to later ones, for values that batch operators make.

The batch operators split hot groups over many tasks, which a keyed state operator would not. So every micro-batch runs the batch
operator and leaves its keys' values in a folder under the batch id, in parts by a hash of the key. A micro-batch reads the
parts its keys fall into, each from the latest folder before its own that has it, and writes the same parts; others are not
touched. Outputs and parts are overwritten under the batch id, so a repeated micro-batch changes nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tokenloom.plans.lookups import join_null_safe

#: Parts of the state; a part holds all keys of a hash value.
STATE_PARTS = 64

Step = Callable[[DataFrame, DataFrame], DataFrame]
Pick = Callable[[DataFrame], DataFrame]


class PartedState:
    """Folders ``batch=N/part=P``; of each part the latest before a batch is its state, older ones than that are deleted."""

    def __init__(self, spark: SparkSession, folder: str, key: str, schema: StructType | str, parts: int) -> None:
        self.spark, self.folder, self.key, self.schema, self.parts = spark, folder, key, schema, parts
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self.path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def part_of(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int")

    def _numbers(self, folder: str, name: str) -> list[int]:
        if not self.files.exists(self.path(folder)):
            return []
        found = [re.fullmatch(rf"{name}=(\d+)", s.getPath().getName()) for s in self.files.listStatus(self.path(folder))]
        return [int(m[1]) for m in found if m]

    def versions(self, before: int) -> dict[int, list[int]]:
        """Batches before ``before`` that wrote each part, in order."""
        out: dict[int, list[int]] = {}
        for batch in sorted(b for b in self._numbers(self.folder, "batch") if b < before):
            for part in self._numbers(f"{self.folder}/batch={batch}", "part"):
                out.setdefault(part, []).append(batch)
        return out

    def read(self, batch_id: int, parts: list[int]) -> DataFrame:
        found = self.versions(batch_id)
        paths = [f"{self.folder}/batch={found[p][-1]}/part={p}" for p in parts if p in found]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def write(self, state: DataFrame, batch_id: int) -> None:
        """Write the parts of a batch, then delete what no repetition of the batch can read."""
        found = self.versions(batch_id)
        path = f"{self.folder}/batch={batch_id}"
        state.withColumn("part", self.part_of()).repartition("part").write.mode("overwrite").partitionBy("part").parquet(path)
        for part, batches in found.items():
            for old in batches[:-1]:
                self.files.delete(self.path(f"{self.folder}/batch={old}/part={part}"), True)


def run_with_parts(stream: DataFrame, key: str, step: Step, output: Pick, state: Pick, schema: StructType | str, folder: str, parts: int = STATE_PARTS) -> StreamingQuery:
    """Start ``step(batch, state)`` over everything available; ``output`` of it goes to ``folder/output``.

    ``state`` of it are the new values of the keys in the batch, in the columns of ``schema``. ``step`` gets the values of those keys.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store = PartedState(spark, f"{folder}/state", key, schema, parts)
        keys = batch.select(key, store.part_of().alias("part")).distinct().persist()
        touched = sorted(r["part"] for r in keys.select("part").distinct().collect())
        held = store.read(batch_id, touched).persist()
        done = step(batch, join_null_safe(held, keys.select(key), [key], "left_semi")).persist()
        try:
            output(done).write.mode("overwrite").parquet(f"{folder}/output/batch_id={batch_id}")
            others = join_null_safe(held, keys.select(key), [key], "left_anti")
            store.write(state(done).unionByName(others), batch_id)
        finally:
            for df in (done, held, keys):
                df.unpersist()

    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
