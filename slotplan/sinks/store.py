"""Published tables that a failed save cannot harm.

A store is a folder of append-only parts:

* ``rows/version=<n>/``: the rows of the chunks that version n wrote;
* ``chunks/version=<n>/``: its manifest, one row per chunk of the whole table with the chunk's
  digest and the version that holds its rows;
* ``log/``: one small record per complete version. The record is written last; readers
  take the last one, so a version that broke off is never seen and the one before it stays
  readable to the end.

A publication compares the digests of its chunks with the last manifest and writes only the
chunks that differ: one changed row rewrites one chunk. Chunks beyond a new, earlier end are
not in the new manifest. The version before is the archive, by the name it had when it was
replaced; it shares the chunks that did not change.

A store has one writer at a time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fmt import archive_name
from ..operators.windows import written
from ..sources.tables import MissingInput, load_required

LOG = "version bigint, name string, archived string, ts timestamp, n_rows bigint, n_chunks bigint, n_written bigint, n_removed bigint"


def chunk_digests(rows: DataFrame, id_col: str = "id", chunk_col: str = "chunk_id") -> DataFrame:
    """chunk_id, n_rows, d1 and d2 per chunk, from partial sums: no chunk is gathered.

    Every row is hashed together with its id (its place), so the digest depends on the
    order of the rows; two sums of 64-bit hashes make it 128 bits wide.
    """
    cols = [F.col(c) for c in rows.columns if c not in (id_col, chunk_col)]
    # nulls are skipped by the hash; their places are hashed beside the values
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in rows.columns])
    exact = lambda seed: F.sum(F.xxhash64(F.lit(seed), F.col(id_col), nulls, *cols).cast("decimal(38,0)"))
    return rows.groupBy(chunk_col).agg(F.count(F.lit(1)).alias("n_rows"), exact(0).alias("d1"), exact(1).alias("d2"))


def chunk_changes(new: DataFrame, old: DataFrame, chunk_col: str = "chunk_id") -> DataFrame:
    """Action per chunk of two manifests: WRITE (new or changed), KEEP or REMOVE (beyond the new end)."""
    o = old.select(F.col(chunk_col).alias("_c"), *[F.col(c).alias(f"_{c}") for c in ("n_rows", "d1", "d2")])
    both = new.join(o, F.col(chunk_col) == F.col("_c"), "full_outer")
    same = (F.col("n_rows") == F.col("_n_rows")) & (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2"))
    action: Column = F.when(F.col(chunk_col).isNull(), "REMOVE").when(F.coalesce(same, F.lit(False)), "KEEP").otherwise("WRITE")
    return both.select(F.coalesce(chunk_col, "_c").alias(chunk_col), action.alias("action"),
                       F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"), "d1", "d2")


class Store:
    """One published table under ``root`` (a shared folder); ``name`` is what archives are named after."""

    def __init__(self, spark: SparkSession, root: str, name: str | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.name = name or self.root.rsplit("/", 1)[-1]

    def history(self) -> DataFrame:
        """One row per complete version."""
        try:
            return load_required(self.spark, f"{self.root}/log", self.name, schema=None).select(*[c.split()[0] for c in LOG.split(", ")])
        except MissingInput:
            return self.spark.createDataFrame([], LOG)

    def _last(self):
        return self.history().orderBy(F.desc("version")).first()

    def manifest(self, version: int | None) -> DataFrame:
        """chunk_id, n_rows, d1, d2, held (the version that holds the rows) of one version."""
        if version is None:
            return self.spark.createDataFrame([], "chunk_id bigint, n_rows bigint, d1 decimal(38,0), d2 decimal(38,0), held bigint")
        return self.spark.read.parquet(f"{self.root}/chunks/version={version}")

    def publish(self, plan: DataFrame, ts: dt.datetime) -> dict:
        """Publish ``plan`` (see ``chunk_plan``) as the next version; the current one is archived.

        Returns the new log record. Nothing that readers see changes before the last write.
        """
        last = self._last()
        before = last["version"] if last else None
        # past versions that broke off may have left files under a number: never reuse one
        version = max([before or 0, *self._started()]) + 1
        rows = written(plan.select("id", "chunk_id", *[c for c in plan.columns if c not in ("id", "chunk_id")]), "publish")
        changes = written(chunk_changes(chunk_digests(rows), self.manifest(before)), "publish-changes")
        fresh = changes.where("action = 'WRITE'").select("chunk_id")
        (rows.join(fresh, "chunk_id", "left_semi").sortWithinPartitions("id")
             .write.parquet(f"{self.root}/rows/version={version}"))
        kept = self.manifest(before).select("chunk_id", F.col("held").alias("_held"))
        (changes.where("action <> 'REMOVE'").join(kept, "chunk_id", "left")
                .select("chunk_id", "n_rows", "d1", "d2", F.when(F.col("action") == "WRITE", version).otherwise(F.col("_held")).cast("bigint").alias("held"))
                .write.parquet(f"{self.root}/chunks/version={version}"))
        n = {r["action"]: (r["n"], r["rows"]) for r in changes.groupBy("action").agg(
            F.count(F.lit(1)).alias("n"), F.sum("n_rows").alias("rows")).collect()}          # three rows
        archived = None
        if last:
            archived = self.spark.range(1).select(archive_name(F.lit(self.name), F.lit(ts))).first()[0]
        of = lambda *a: [n.get(x, (0, 0)) for x in a]
        record = (version, self.name, archived, ts, sum(x[1] for x in of("WRITE", "KEEP")), sum(x[0] for x in of("WRITE", "KEEP")),
                  of("WRITE")[0][0], of("REMOVE")[0][0])
        log = self.spark.createDataFrame([record], LOG)
        log.coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        return dict(zip(log.columns, record))

    def _started(self) -> list[int]:
        """Numbers of the versions of which any file was written (listing only; one per version)."""
        found = []
        for part in ("rows", "chunks"):
            try:
                files = load_required(self.spark, f"{self.root}/{part}", part, "binaryFile", recursiveFileLookup=True)
            except MissingInput:
                continue
            number = F.regexp_extract("path", r"version=(\d+)/", 1).cast("bigint")
            found.append(files.agg(F.max(number)).first()[0] or 0)
        return found

    def read(self, archive: str | None = None) -> DataFrame:
        """The current table, or the one archived under a name."""
        log = self.history()
        if archive is not None:
            hit = log.where(F.col("archived") == archive).orderBy(F.desc("version")).first()
            row = hit and log.where(F.col("version") < hit["version"]).orderBy(F.desc("version")).first()
        else:
            row = self._last()
        if not row:
            raise MissingInput(f"no version of '{self.name}'" + (f" archived as '{archive}'" if archive else "") + f" at {self.root}")
        held = self.manifest(row["version"]).select("chunk_id", F.col("held").alias("version"))
        rows = self.spark.read.option("basePath", f"{self.root}/rows").parquet(f"{self.root}/rows")
        return rows.join(held, ["version", "chunk_id"], "left_semi").drop("version")
