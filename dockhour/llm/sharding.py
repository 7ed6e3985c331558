"""Contiguous shards of nearly equal bytes, cut on global prefix sums."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .prefix import running


def byte_shards(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Cut the documents, in id order, into ``n_shards`` contiguous runs of nearly equal bytes.

    A document weighs its UTF-8 bytes plus one (null text: one).  With T the sum of all weights, a
    document goes to the shard in which its middle byte falls when [0, T) is cut at equal targets.
    ``slot`` numbers the documents of a shard from 0 in id order.

    Null ids come first; equal ids are ordered by size and checksum, repeated rows in any order;
    every input row gives one output row.  An empty table gives no rows; shards beyond the number
    of documents stay empty.  Other columns are not read.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(F.col(id_col).alias("doc_id"),
                        (F.octet_length(body) + 1).cast("long").alias("size"),
                        F.crc32(body.cast("binary")).alias("text_crc32"))
    placed = running(sized, [], ["doc_id", "size", "text_crc32"], ["size"], "shard-sizes")
    total = placed.agg(F.coalesce(F.max(F.col("size_before") + F.col("size")), F.lit(1))
                       .cast("long").alias("_total"))
    # Twice the position of the middle byte, so that the cut stays in integers.
    middle = 2 * F.col("size_before") + F.col("size")
    cut = placed.crossJoin(F.broadcast(total)).withColumn(  # one row
        "shard", F.least(F.lit(n_shards - 1), F.floor(
            middle.cast("decimal(38,0)") * n_shards / (2 * F.col("_total")))).cast("int"))
    cut = written(cut.drop("_total"), "shard-cut")
    first = cut.groupBy(F.col("shard").alias("_shard")).agg(F.min("row_before").alias("_first"))
    return (cut.join(F.broadcast(first), F.col("shard") == F.col("_shard"))  # n_shards rows
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("row_before") - F.col("_first")).alias("slot")))
