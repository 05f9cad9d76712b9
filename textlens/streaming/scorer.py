"""Score documents as they arrive (Structured Streaming).

New documents land as files in a folder; each micro-batch is tokenised and
scored against a fixed, saved model with the batch scorer (``foreachBatch``),
and the predictions go to a parquet sink, one folder ``epoch=<id>`` for each
batch: a batch that is run again replaces its own rows. Progress is kept in a
checkpoint folder under the session's shared ``spark.checkpoint.dir``, so a
restarted query neither loses nor repeats a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.operators.model import Model, test_token_lists, tokenize
from textlens.operators.scoring import DEFAULT_REJECT, FIXED_FLOOR, FLOOR
from textlens.operators.sums import candidate_tables, mode_term, score_sums


def score_batch(batch: DataFrame, model: Model, header, mode=FLOOR, zero_fix=FIXED_FLOOR, reject=DEFAULT_REJECT, tables=None) -> DataFrame:
    """``(doc_id, class, text)`` -> ``(doc_id, class, pred, score)``; docs with no kept word are skipped. ``tables``: the
    model's word tables (``sums.candidate_tables``), made once for all batches."""
    docs = test_token_lists(tokenize(batch).withColumn("split", F.lit("test")))
    scored = score_sums(docs, model, mode=mode, zero_fix=zero_fix, reject=reject, header=header, tables=tables)
    return scored.select("doc_id", "class", "pred", F.array_max("scores").alias("score"))


def start_scoring(
    spark: SparkSession,
    source_dir: str,
    schema,
    model: Model,
    sink_dir: str,
    checkpoint: str,
    mode=FLOOR,
    zero_fix=FIXED_FLOOR,
    reject=DEFAULT_REJECT,
    available_now: bool = True,
):
    """Start the streaming scorer over parquet files in ``source_dir``.

    The class header (K rows) and the word tables are made once from the model; ``available_now``
    processes what is there and stops (use a processing-time trigger to keep
    running).
    """
    header = model.header()
    tables = candidate_tables(model, header, [mode_term(mode, zero_fix)])
    stream = spark.readStream.schema(schema).parquet(source_dir)

    def each(batch: DataFrame, epoch_id: int) -> None:
        score_batch(batch, model, header, mode, zero_fix, reject, tables).write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/epoch={epoch_id}")

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
