"""Incremental page ingest as a Structured Streaming job (L1).

New page files arrive in a folder; each micro-batch is deduplicated by
URL, run through the item extraction, deduplicated by item key and
anti-joined against the items already stored, then appended. The
anti-join inside ``foreachBatch`` is the dedup across batches, so no
unbounded streaming state is kept (a stream-side ``dropDuplicates``
without event time would keep every key for ever). A retried batch
finds its own rows already stored and appends nothing: the sink is
idempotent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.ingest import dedup_by_key
from ..operators.pages import extract_items, extract_marked_items
from ..session import scratch_path

PAGES_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])


BUCKETS = 256
BUCKET = "_bucket"


def _located(spark: SparkSession, place: str):
    """The Hadoop path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def stored_rows(spark: SparkSession, target: str, schema: T.StructType | str) -> DataFrame:
    """The stored rows; none if the folder is not there yet. Any other
    failure to read them is the caller's failure."""
    path, fs = _located(spark, target)
    if not fs.exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(target)


def table_files(spark: SparkSession, table: str) -> tuple[str, str]:
    """(folder, file name pattern) of a table that is one file or a folder of files."""
    path, fs = _located(spark, table)
    if fs.getFileStatus(path).isDirectory():
        return table, "*"
    return path.getParent().toString(), path.getName()


def ingest_batch(batch: DataFrame, target: str, extract: Callable[[DataFrame], DataFrame], key_cols) -> None:
    """One micro-batch: pages deduplicated by URL (lowest page id) ->
    ``extract`` -> one row per key -> anti-join with the stored rows ->
    append. The store is partitioned by a bucket of the key's hash; a batch
    reads only the buckets it has keys in."""
    spark = batch.sparkSession
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    pages = dedup_by_key(batch.select("url", "page_id", "html"), "url", ["page_id"])
    rows = dedup_by_key(extract(pages), keys)
    rows = rows.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))
    rows = rows.persist()
    try:
        buckets = [r[0] for r in rows.select(BUCKET).distinct().collect()]  # BUCKETS numbers at most
        stored = stored_rows(spark, target, rows.schema).where(F.col(BUCKET).isin(buckets))
        fresh = rows.join(stored.select(BUCKET, *keys), [BUCKET, *keys], "left_anti")
        fresh.repartition(BUCKET).write.partitionBy(BUCKET).mode("append").parquet(target)
    finally:
        rows.unpersist()


def stream_ingest_pages(spark: SparkSession, source_dir: str, target: str | None = None,
                        extract: Callable[[DataFrame], DataFrame] | None = None, key_cols=("item_url",),
                        glob: str = "*.parquet", checkpoint: str | None = None,
                        max_files_per_trigger: int | None = None) -> str:
    """Run the ingest over every file now in ``source_dir`` (trigger
    ``availableNow``) and return the target path. Re-running with the same
    checkpoint only picks up new files."""
    target = target or scratch_path(spark, "ingested-items")
    checkpoint = checkpoint or scratch_path(spark, "ingest-checkpoint")
    extract = extract or (lambda p: extract_items(p).select("item_url", "title", "summary", "score"))
    reader = spark.readStream.schema(PAGES_SCHEMA).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    q = (stream.writeStream
         .foreachBatch(lambda df, _epoch: ingest_batch(df, target, extract, key_cols))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return target


def nav_items(pages: DataFrame) -> DataFrame:
    """The nav-list links of a page read as items (title, item_url)."""
    got = extract_marked_items(pages, item_marker="<li>", title_pattern=r'<a href="[^"]*">([^<]*)</a>',
                        link_pattern=r'href="([^"]*)"')
    return got.filter(F.col("item_url") != "").select("item_url", "title")
