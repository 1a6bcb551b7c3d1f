"""Reuse by content (A3, A15): a step runs again only if its inputs or parameters have changed.

A fingerprint covers the files a step reads and writes (name, length and time of change, from
the file listing: no content is read) and its parameters; outputs that were changed or removed
since are made again. It is kept beside the outputs as a small
table that is emptied before the step writes anything and filled after all of it is written,
so a step that broke off counts as not done.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import MissingInput, load_required

_MARK = "step string, fingerprint string"


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """path, length and time of the data files under ``path`` (a file or a folder of any depth)."""
    listing = load_required(spark, path, path, "binaryFile", recursiveFileLookup=True)
    return listing.select("path", "length", "modificationTime")


def files_digest(spark: SparkSession, path: str) -> str:
    """One digest of all files under ``path``; independent of their order. 'missing' without any."""
    try:
        files = files_of(spark, path)
    except MissingInput:
        return "missing"
    # two sums of 64-bit hashes: nothing but the totals reaches the driver
    exact = lambda seed: F.sum(F.xxhash64(F.lit(seed), "path", "length", "modificationTime").cast("decimal(38,0)"))
    n, a, b = files.agg(F.count(F.lit(1)), exact(0), exact(1)).first()
    return f"{n}:{a}:{b}" if n else "missing"


def fingerprint(spark: SparkSession, inputs: Iterable[str], params: Mapping) -> str:
    told = {"inputs": {p: files_digest(spark, p) for p in inputs}, "params": dict(params)}
    return hashlib.sha256(json.dumps(told, sort_keys=True, default=str).encode()).hexdigest()


class Steps:
    """The marks of the steps of one output folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, step: str) -> str:
        return f"{self.folder}/steps/{step}"

    def mark(self, step: str) -> str | None:
        """Fingerprint of the last complete run of a step."""
        try:
            row = load_required(self.spark, self._path(step), step, schema=None).first()
        except MissingInput:
            return None
        return row["fingerprint"] if row else None

    def _set(self, step: str, value: str | None) -> None:
        rows = [] if value is None else [(step, value)]
        self.spark.createDataFrame(rows, _MARK).coalesce(1).write.mode("overwrite").parquet(self._path(step))

    def reset(self, step: str) -> None:
        """The step counts as not done."""
        self._set(step, None)

    def run(self, step: str, inputs: Iterable[str], params: Mapping, outputs: Iterable[str], work: Callable[[], object]) -> bool:
        """Run ``work`` unless the step is up to date; True if it ran. Success is marked last."""
        now = fingerprint(self.spark, inputs, params)
        outputs = list(outputs)
        if self.mark(step) == f"{now}/{fingerprint(self.spark, outputs, {})}":
            return False
        self.reset(step)
        work()
        self._set(step, f"{now}/{fingerprint(self.spark, outputs, {})}")
        return True


def read_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame], fmt: str = "parquet",
                  inputs: Iterable[str] = (), params: Mapping | None = None) -> DataFrame:
    """Read a saved table if it was built from the same inputs and parameters, else build and save it (A3).

    Reading back cuts the lineage: later steps start from the written table.
    """
    Steps(spark, path + ".meta").run(
        "build", inputs, params or {}, [path], lambda: build().write.mode("overwrite").format(fmt).save(path))
    return spark.read.format(fmt).load(path)
