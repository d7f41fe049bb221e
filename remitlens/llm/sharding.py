"""Global shuffle into shards in two passes over the rows.

Pass one scatters the rows uniformly into buckets of about ``bucket_bytes`` by a seeded hash of the document, its text and its place in
the input, so that neither a repeated document nor a repeated text fills a bucket.  Pass two reads one bucket at a time, puts its
rows in Fisher-Yates order from a generator seeded by the bucket, and writes them.  The buckets follow each other: a first count of
rows per bucket (one number each, from the same scan) tells where a bucket begins in the whole order, and place modulo the number
of shards is a row's shard.  Shards so differ by one row at most, and slots have no gaps.

A task that is repeated gives the same rows again.  The order depends on the seed, the number of buckets and the way the input is
split; an input that changes between the count and the write is refused.  The driver holds 8 bytes for each bucket.

Defined results: null texts have size 1; repeated rows are placed one by one; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from remitlens.llm.support import ship

#: Bytes of text in a bucket; at 100 TB take 256 MB, so that the buckets stay under half a million.
BUCKET_BYTES = 8 << 20
SEED = 7
#: Columns that are made here; an input's columns of these names are replaced.
OWN = ("slot", "shard", "_bucket", "_place")


def size_of(text):
    """UTF-8 bytes of a text and one; null is none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def scattered(docs: DataFrame, buckets: int, seed: int) -> DataFrame:
    """``docs`` with a bucket for each row."""
    place = F.monotonically_increasing_id()
    return docs.withColumn("_place", place).withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text", "_place"), F.lit(buckets)).cast("int"))


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """The order of a bucket's ``n`` rows; numpy's ``shuffle`` is the Fisher-Yates shuffle."""
    order = np.arange(n)
    np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(order)
    return order


def sharded(docs: DataFrame, path: str, shards: int, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Shuffle ``docs`` (doc_id, text and more), write them to ``path`` and return them as written, with ``slot`` and ``shard``.

    ``path`` holds one folder per shard; within a file the rows stand in their order.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.drop(*OWN)
    total = docs.select(size_of(F.col("text")).alias("size")).agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    dealt = scattered(docs, buckets, seed)
    counts = np.zeros(buckets + 1, np.int64)
    for bucket, n in dealt.groupBy("_bucket").count().toPandas().itertuples(index=False):
        counts[bucket + 1] = n
    begins = spark.sparkContext.broadcast(np.cumsum(counts))

    def run(batches):
        held: list[pa.RecordBatch] = []
        current = -1

        def emit():
            rows = pa.Table.from_batches(held)
            order = fisher_yates(len(rows), seed, current)
            begin, end = begins.value[current : current + 2]
            if len(rows) != end - begin:
                raise ValueError("the input gave other rows when it was read again")
            at = begin + np.arange(len(rows))
            shard = at % shards
            by_shard = np.argsort(shard, kind="stable")
            out = rows.select(range(rows.num_columns - 1)).take(pa.array(order[by_shard]))
            out = out.append_column("slot", pa.array((at // shards)[by_shard])).append_column("shard", pa.array(shard[by_shard].astype(np.int32)))
            return out.to_batches(max_chunksize=1000)

        for batch in batches:
            at, bucket = 0, batch.column(batch.num_columns - 1).to_numpy()
            for stop in [*(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]:
                if stop == at:
                    continue
                if held and bucket[at] != current:
                    yield from emit()
                    held = []
                current = int(bucket[at])
                held.append(batch.slice(at, stop - at))
                at = stop
        if held:
            yield from emit()

    schema = StructType([*docs.schema.fields, StructField("slot", LongType()), StructField("shard", IntegerType())])
    ranged = dealt.repartitionByRange(buckets, "_bucket").sortWithinPartitions("_bucket", "_place").drop("_place")
    ranged.mapInArrow(run, schema).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return spark.read.schema(schema).parquet(path)
