"""Parsing stages as streams over the folders captures land in.

Each micro-batch writes its own ``batch=N`` folder, so a batch that runs again after a failure
replaces its rows and adds none twice. Which keys came before is the state of a streaming
aggregation, kept per key in the state store: a batch looks up its own keys and reads nothing
of what earlier batches wrote, however many there were.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfloom import schemas
from shelfloom.operators.extract import error_rows, extract_listing, extract_product, good_rows
from shelfloom.operators.frontier import with_html
from shelfloom.operators.products import number_products, parsed_values, row_key
from shelfloom.rules import SITES, SiteRule
from shelfloom.sources.tables import _folder

LISTING = (
    "page_id BIGINT, url STRING, site STRING, page_items INT, pos INT, name STRING, slug STRING, "
    "product_code STRING, currency STRING, price_text STRING, price BIGINT, link STRING, "
    "reviews STRING, image STRING, reason STRING"
)


def _path(root: str, table: str, batch: int) -> str:
    return f"{root}/{table}/batch={batch}"


def read_batches(
    spark: SparkSession, root: str, table: str, schema: str, before: int | None = None
) -> DataFrame:
    """Rows of all batches of a table, or of those before one."""
    folder, files, _ = _folder(spark, f"{root}/{table}")
    empty = spark.createDataFrame([], schema)
    if not files.exists(folder) or not files.listStatus(folder):
        return empty
    rows = spark.read.schema(f"{schema}, batch BIGINT").parquet(f"{root}/{table}")
    if before is not None:
        rows = rows.filter(F.col("batch") < before)
    return rows.select(*empty.columns)


def _write(df: DataFrame, root: str, table: str, batch: int) -> DataFrame:
    path = _path(root, table, batch)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _read(spark: SparkSession, landing: str, schema: str, files_per_batch: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(landing)


def _start(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(each)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _run(
    spark: SparkSession, landing: str, schema: str, checkpoint: str,
    each: Callable[[DataFrame, int], None], files_per_batch: int | None,
) -> StreamingQuery:
    return _start(_read(spark, landing, schema, files_per_batch), checkpoint, each)


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_rows(
    stream: DataFrame, keys: Sequence[Column], order: Column, checkpoint: str, each: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Give ``each`` micro-batch the rows of the keys it saw first, the least of each key in ``order``.

    State is the first row of every key, on the executors' disks and in the checkpoint, not in
    their memory. A key is new if the time of its first batch is that of its last one. ``each``
    must use its rows once. NULL is a key like any other.
    """
    spark = stream.sparkSession
    # Every expression of one micro-batch sees the same time.
    stamped = stream.withColumn("_at", F.current_timestamp())
    state = stamped.groupBy(*keys).agg(
        F.min_by(F.struct(*stream.columns), F.struct("_at", order)).alias("_first"),
        F.min("_at").alias("_since"), F.max("_at").alias("_last"),
    )

    def new(batch: DataFrame, number: int) -> None:
        each(batch.filter(F.col("_since") == F.col("_last")).select("_first.*"), number)

    provider = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        return _start(state, checkpoint, new, "update")
    finally:
        spark.conf.set(_PROVIDER, provider)


def listing_stream(
    spark: SparkSession,
    landing: str,
    root: str,
    rules: Mapping[str, SiteRule] = SITES,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Parse listing captures once each: listing rows, errors and new products.

    ``landing`` holds parquet captures (``schemas.CAPTURES``). The parse runs to its end first;
    the stream that is returned reads its rows and adds the products that are new. Restarting
    with the same ``root`` goes on after the last batch of each.
    """

    def parse(batch: DataFrame, number: int) -> None:
        # Written first, so that pages are parsed once for both tables.
        rows = _write(extract_listing(batch, rules), root, "listing_products", number)
        _write(error_rows(rows, "listing_parse"), root, "errors", number)

    _run(
        spark, landing, schemas.CAPTURES, f"{root}/_listing_checkpoint", parse, files_per_batch
    ).awaitTermination()

    def add(new: DataFrame, number: int) -> None:
        # One row a batch, so the last id is known without the products themselves.
        last = read_batches(spark, root, "product_ids", "last BIGINT", before=number)
        last = last.agg(F.coalesce(F.max("last"), F.lit(0).cast("bigint"))).first()[0]
        # Written first: the sort samples its keys, and would look up the state for that once more.
        new = _write(new, root, "found_products", number)
        rows = number_products(new, last, ["batch", "source_page_id", "pos"])
        rows = _write(rows, root, "products", number)
        _write(rows.agg(F.coalesce(F.max("id"), F.lit(last).cast("bigint")).alias("last")), root, "product_ids", number)

    folder, files, _ = _folder(spark, f"{root}/listing_products")
    files.mkdirs(folder)
    rows = _read(spark, f"{root}/listing_products", f"{LISTING}, batch BIGINT", None)
    found = good_rows(rows).select("batch", F.col("page_id").alias("source_page_id"), "pos", "link", "slug")
    place = F.struct("batch", "source_page_id", "pos")
    return first_rows(found, row_key("link"), place, f"{root}/_products_checkpoint", add)


PARSES = (
    "product_url STRING, slug STRING, name STRING, currency STRING, price DOUBLE, "
    "product_code STRING, reviews STRING, reviews_num BIGINT, image STRING, reason STRING, "
    "page_id BIGINT"
)


def product_stream(
    spark: SparkSession,
    landing: str,
    root: str,
    rules: Mapping[str, SiteRule] = SITES,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Parse product captures once each into an append-only table of parse results.

    ``current_products`` lays the results over the product table; no micro-batch rewrites
    that table.
    """

    def each(batch: DataFrame, number: int) -> None:
        # An empty capture says nothing of the product and never replaces a full one.
        rows = parsed_values(extract_product(with_html(batch), rules)).withColumnRenamed("url", "product_url")
        empty = spark.createDataFrame([], PARSES)
        _write(rows.select(*empty.columns), root, "product_parses", number)

    return _run(
        spark, landing, schemas.CAPTURES, f"{root}/_product_checkpoint", each, files_per_batch
    )


def latest_parses(parses: DataFrame) -> DataFrame:
    """Last parse result of each product URL, by capture id."""
    rest = [c for c in parses.columns if c != "product_url"]
    newest = F.max_by(F.struct(*rest), "page_id").alias("last")
    return (
        parses.filter(F.col("product_url").isNotNull())
        .groupBy("product_url")
        .agg(newest)
        .select("product_url", "last.*")
    )


def stream_dedup(
    spark: SparkSession, landing: str, schema: str, key: str, root: str,
    order: Column, files_per_batch: int | None = None,
) -> StreamingQuery:
    """Keep the first row of each key over all batches, exactly: the least in ``order`` of its first batch.

    There is no watermark, so no late repeat gets through.
    """

    def each(new: DataFrame, number: int) -> None:
        _write(new, root, "unique", number)

    stream = _read(spark, landing, schema, files_per_batch)
    return first_rows(stream, [F.col(key).alias("_key")], order, f"{root}/_dedup_checkpoint", each)


def bounded_stream_dedup(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """The same with bounded state: repeats count as such only within ``delay``."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
