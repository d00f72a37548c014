"""Running error rates over predictions that keep arriving."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parkwright.operators.scoring import scored
from parkwright.sources.shared import new_path


def rates(stream: DataFrame) -> DataFrame:
    """Edits and words by group; sums only, so the state is one row a group."""
    return scored(stream).groupBy("source_dataset").agg(F.sum("word_edits").alias("word_edits"), F.sum("n_words").alias("n_words"))


def running_rates(spark: SparkSession, pairs: DataFrame) -> DataFrame:
    """Write ``pairs`` as an arriving directory, run the stream over it to its end, and return the last state with its pooled row."""
    source, sink, name = new_path(spark, "arriving"), new_path(spark, "state"), f"rates_{uuid.uuid4().hex}"
    pairs.write.parquet(source)
    stream = spark.readStream.schema(pairs.schema).option("maxFilesPerTrigger", 4).parquet(source)
    started = rates(stream).writeStream.outputMode("complete").foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(sink))
    run = started.queryName(name).option("checkpointLocation", new_path(spark, "stream")).trigger(availableNow=True).start()
    run.awaitTermination()
    last = spark.read.parquet(sink)
    pooled = last.agg(F.sum("word_edits").alias("word_edits"), F.sum("n_words").alias("n_words")).withColumn("source_dataset", F.lit("pooled"))
    return last.unionByName(pooled)
