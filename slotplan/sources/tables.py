"""Base table readers (A1, A2, A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException


class MissingInput(FileNotFoundError):
    """A named input table or file is absent (run the step that builds it first)."""


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one base table; Catalyst prunes columns, pushes filters and splits files."""
    return spark.read.parquet(table_path(sf_dir, name))


def load_required(spark: SparkSession, path: str, name: str, fmt: str = "parquet",
                  schema: StructType | None = None, **options) -> DataFrame:
    """Guarded load: a named error instead of a bare path failure (A2)."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.load(path)
        # resolve the file listing now so a missing path fails here, by name
        df.schema
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise MissingInput(f"no data for '{name}' at {path}; build it first") from e
        raise


#: column that holds the raw text of a CSV row that does not fit the schema
BAD_ROW = "_bad_row"


def read_csv(spark: SparkSession, path: str, schema: StructType, name: str | None = None, **options) -> DataFrame:
    """CSV with header and a declared schema (A1); types are not inferred.

    A row that does not fit the schema keeps its raw text in ``BAD_ROW`` (null for good
    rows). A missing path raises ``MissingInput`` by name.
    """
    whole = StructType([*schema.fields, StructField(BAD_ROW, StringType())])
    return load_required(spark, path, name or path, "csv", whole,
                         **{"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_ROW, **options})


def in_file_order(df: DataFrame, order: str) -> DataFrame:
    """``df``, straight from a file reader, with ``order`` = 1..N by file name and place in the file.

    Spark may read large files first and cut a file into several splits; the rows are
    numbered by file, start of the split and place in it, from one written table.
    """
    from ..sinks.publish import dense_ids

    at = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
                   F.monotonically_increasing_id().alias("_row"))
    return dense_ids(at, ["_file", "_start", "_row"], order).drop("_start", "_row")
