"""Feeding an index from a stream of documents."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from termloom.plans.build import add_documents, build_index
from termloom.sources.index_store import index_exists, read_index


def append_stream(
    docs: DataFrame, path: str, checkpoint: str, **settings
) -> StreamingQuery:
    """Append what has arrived on ``docs(doc_id, text[, title])`` and stop.

    The first batch builds the index with ``settings``, later ones append to it.  The
    index keeps the name of the batch that came last, so a batch that is run again after a
    failure adds nothing twice, whatever its documents.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, f"{checkpoint}#{batch_id}"
        if index_exists(spark, path):
            add_documents(read_index(spark, path), batch, batch=name)
        else:
            build_index(batch, path, last_batch=name, **settings)

    writer = docs.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
