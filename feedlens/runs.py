"""The landed tables of one run: owned by its result, found again by a restarted run.

A run keeps its tables in one folder under ``spark.checkpoint.dir``. Without a run id the
folder is private: the result's ``close()`` (or ``with``) deletes it, and should the caller
forget, the driver's end does. With a caller's run id the folder has that name; a table that
was landed whole is marked, and a run started again with the same id and the same inputs reads
it instead of computing it again. A run that fails leaves its folder to the next attempt;
``close()`` deletes it.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from feedlens import config

RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


class RunMismatch(ValueError):
    """A run id was used before for a run over other inputs."""


class RunFolder:
    def __init__(self, spark: SparkSession, run_id: str | None = None, inputs: dict | None = None):
        if run_id is not None and not RUN_ID.fullmatch(run_id):
            raise ValueError(f"a run id has letters, digits, '.', '_' and '-': {run_id!r}")
        self.spark, self.run_id = spark, run_id
        self.path = f"{config.checkpoint_base(spark)}/feedlens/runs/{run_id or 'private-' + uuid.uuid4().hex}"
        jvm = spark.sparkContext._jvm
        self._hadoop_path = jvm.org.apache.hadoop.fs.Path
        self._store = self._hadoop_path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if run_id is None:
            self._store.deleteOnExit(self._hadoop_path(self.path))
        else:
            self._same_inputs(json.dumps(inputs or {}, sort_keys=True))

    def _same_inputs(self, inputs: str) -> None:
        file = f"{self.path}/inputs.json"
        if self._exists(file):
            before = self.spark.read.text(file, wholetext=True).first()["value"]
            if before != inputs:
                raise RunMismatch(f"run {self.run_id!r} was begun with other inputs: {before}")
        else:
            self._write(file, inputs)

    def _exists(self, path: str) -> bool:
        return bool(self._store.exists(self._hadoop_path(path)))

    def _write(self, path: str, text: str) -> None:
        out = self._store.create(self._hadoop_path(path), True)
        out.write(bytearray(text, "utf-8"))
        out.close()

    def has(self, name: str) -> bool:
        """Whether an attempt has landed table ``name`` whole."""
        return self._exists(f"{self.path}/{name}.landed")

    def land(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written once as table ``name`` and read back; a table landed before is read as it is."""
        table = f"{self.path}/{name}"
        if not self.has(name):
            df.write.mode("overwrite").parquet(table)  # over what a broken attempt may have left
            self._write(f"{table}.landed", "")
        return self.spark.read.schema(df.schema).parquet(table)

    def exists(self) -> bool:
        return self._exists(self.path)

    def close(self) -> None:
        """Delete the folder; DataFrames that read it are gone with it."""
        self._store.delete(self._hadoop_path(self.path), True)


class Owner:
    """A result that owns a run folder: ``close()`` or the end of ``with`` frees it."""

    folder: RunFolder | None = None

    def close(self) -> None:
        if self.folder is not None:
            self.folder.close()

    def __enter__(self):
        return self

    def __exit__(self, *error) -> None:
        self.close()
