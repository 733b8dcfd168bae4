"""Sample tables on disk: CSV, knowledge base JSON, Parquet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codesift import fixed_values as fixed
from codesift.operators import samples
from codesift.sources.synthetic import synthetic_samples
from codesift.sources.tables import KNOWLEDGE_BASE_SCHEMA, SAMPLE_SCHEMA

_CSV = {
    "header": True, "multiLine": True, "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    "emptyValue": "", "encoding": "UTF-8",
}


def read_csv(spark: SparkSession, path: str, schema: str = SAMPLE_SCHEMA) -> DataFrame:
    """A CSV with quoted cells of many lines. Such files do not split: convert a
    large one to Parquet once, or keep it in many files. Empty cells are the empty
    code and "no CWE", never null."""
    return _filled(spark.read.schema(schema).options(**_CSV).csv(path))


def _filled(df: DataFrame) -> DataFrame:
    return df.fillna({"code": "", "cwe_id": fixed.NO_CWE})


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of unknown columns, all text, for the external adapters."""
    return spark.read.options(**_CSV, inferSchema=False).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(**{**_CSV, "quoteAll": True}).csv(path)


def read_mined(spark: SparkSession, path: str) -> DataFrame:
    """A mined CSV or Parquet table, cut to the sample columns."""
    if path.endswith(".parquet"):
        return samples.canonical(spark.read.parquet(path))
    raw = read_text_csv(spark, path)
    typed = raw.withColumn("is_vulnerable", F.col("is_vulnerable").cast("int"))
    return _filled(samples.canonical(typed))


def write_mined(df: DataFrame, path: str) -> None:
    """The mined table as Parquet, a folder per source repository.

    Rebalancing splits a large repository over many tasks and files and keeps the
    small ones together.
    """
    df.hint("rebalance", F.col("source")).write.mode("overwrite").partitionBy("source").parquet(path)


def write_knowledge_base(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_knowledge_base(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """JSON lines, or one JSON array per file with ``multi_line``."""
    return spark.read.schema(KNOWLEDGE_BASE_SCHEMA).json(path, multiLine=multi_line)


def _readable(read, *args) -> DataFrame | None:
    """The table, or None where its path does not exist."""
    try:
        return read(*args)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def base_samples(spark: SparkSession, base_path: str | None = None,
                 function_path: str | None = None, patch_path: str | None = None,
                 num_samples: int = 100) -> DataFrame:
    """The base table if it exists, else landed external tables, else synthetic rows."""
    base = _readable(read_csv, spark, base_path) if base_path else None
    if base is not None:
        return base
    landed = []
    for path, adapt in ((function_path, samples.from_function_table),
                        (patch_path, samples.from_patch_table)):
        raw = _readable(read_text_csv, spark, path) if path else None
        table = adapt(raw) if raw is not None else None
        if table is not None:
            landed.append(table)
    if landed:
        return samples.union_by_rank(landed).drop("source_rank")
    return synthetic_samples(spark, num_samples)


def load_samples(spark: SparkSession, base_path: str | None = None,
                 mined_path: str | None = None, **external) -> DataFrame:
    """Base and mined samples together, one copy of each code kept.

    A base sample goes before a mined one, and else the smallest row, so the choice does not
    depend on how files are cut into tasks.
    """
    parts = [samples.canonical(base_samples(spark, base_path, **external))]
    mined = _readable(read_mined, spark, mined_path) if mined_path else None
    if mined is not None:
        parts.append(mined)
    merged = samples.union_by_rank(parts)
    return samples.deduplicated(merged, ["source_rank"]).select(*samples.CANONICAL)
