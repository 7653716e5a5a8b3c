"""Publications as they arrive: the stateless part of processing over a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from litloom import schemas
from litloom.operators import publications


def read_stream(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    return spark.readStream.schema(schemas.PUBLICATIONS).option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", "true").json(path)


def usable_sentences(stream: DataFrame, lookup: DataFrame) -> DataFrame:
    """Sentences fit for grounding; the lookup is a static table, so no state is kept."""
    return publications.usable(publications.load_publications(stream, lookup))


def write_stream(sentences: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends what has arrived as Parquet, once, and ends."""
    return sentences.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
