"""Tables and raw files in the shared folder, and the readers of the corpus tables."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.session import importable, session_conf
from roompulse.workspace import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch where whole texts pass through Python; a batch is bounded in bytes as well.
BATCH_ROWS = 1000


def saved(df: DataFrame, name: str, folder: str | None = None, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Write a table to the shared folder and read it back: later work starts from committed files."""
    spark = df.sparkSession
    folder = folder or new_folder(spark, name)
    with session_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(batch_rows)}):
        df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def dropped(spark: SparkSession, *folders: str) -> None:
    """Delete intermediate tables that nothing reads any more."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def named(column: str) -> Column:
    """A column by its whole name, whatever characters that has."""
    return F.col("`" + column.replace("`", "``") + "`")


def documents(df: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """The id and the text, under fixed names, so that other columns can't clash; those to carry along get ``own_`` before theirs."""
    return df.select(named(id_col).alias("doc_id"), named(text_col).alias("text"), *(named(c).alias(f"own_{c}") for c in carry))


def own_columns(df: DataFrame) -> str:
    """The carried columns as the end of a schema string."""
    kinds = ((f.name.replace("`", "``"), f.dataType.simpleString()) for f in df.schema.fields if f.name.startswith("own_"))
    return "".join(f", `{name}` {kind}" for name, kind in kinds)


def finished(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of work whose result is saved; it does so when the driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def release_memory() -> None:
    """Give freed memory back to the system: Python workers live on between tasks and would keep what one task needed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mapped(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` whose tasks give their memory back at the end."""

    # Spark looks the columns up by name, and takes a dot or a backtick in one for syntax.
    names = df.columns
    odd = any("." in name or "`" in name for name in names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if odd:
            batches = (pa.RecordBatch.from_arrays(batch.columns, names=names) for batch in batches)
        try:
            yield from function(batches)
        finally:
            release_memory()

    return (df.toDF(*(f"c{i}" for i in range(len(names)))) if odd else df).mapInArrow(task, schema)
