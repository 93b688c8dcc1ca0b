"""Helpers of the operators: projecting documents, sizing blocks, scratch tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from andenlake.session import shared_folder

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a public vocabulary file; the files are installed on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator reads: id, UTF-8 bytes (null: empty), and ``more``.

    Extra columns, whatever their names, cannot clash with an operator's own."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("utf8"), *more)


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{shared_folder(spark)}/andenlake-llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: fixes what depends on
    task order, and survives the loss of executors."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete tables made by ``stored`` that no later step reads."""
    for frame in frames:
        spark = frame.sparkSession
        for folder in {path.rpartition("/")[0] for path in frame.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def block_count(docs: DataFrame, block_bytes: int) -> int:
    """Blocks of about ``block_bytes`` of text: grows with the corpus."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-total // block_bytes))


def map_batches(df: DataFrame, work: Callable[[dict], Iterator[dict] | dict], schema: str,
                start: Callable | None = None) -> DataFrame:
    """``work`` gets each Arrow batch as a dict of Python lists (with ``start()``'s
    value as second argument, made once per task) and returns a dict of lists."""
    spark = df.sparkSession
    arrow = to_arrow(spark, schema)

    def run(batches):
        state = (start(),) if start else ()
        for batch in batches:
            out = work(batch.to_pydict(), *state)
            yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return df.mapInArrow(run, schema)


def to_arrow(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string
    parsed = _parse_datatype_string(schema)
    assert isinstance(parsed, StructType)
    return to_arrow_schema(parsed)
