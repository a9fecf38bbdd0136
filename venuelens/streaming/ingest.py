"""Landed listing pages to a table of cards, each page once (SS-1)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from venuelens.sources.cards import CardRules, extract_cards, extract_listing_cards

PAGE_SCHEMA = "page_id BIGINT, url STRING, html STRING"
KEY = "page_id"


def known_keys(spark: SparkSession, keys: str, before: int) -> DataFrame | None:
    """The page keys that batches before this one have taken; None if there are none yet."""
    try:
        return spark.read.parquet(keys).where(f"batch < {before}").select(KEY)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def take_batch(pages: DataFrame, batch: int, output: str, keys: str, rules: CardRules | None = None) -> None:
    """Write the cards of the pages that no earlier batch has taken, then the keys of these pages.

    Both go to a folder of the batch that replaces an earlier attempt at the same batch, and keys of the batch itself do not count as known. So a batch that is
    run again, whatever its last attempt had written, leaves the same cards and keys.
    """
    spark = pages.sparkSession
    fresh = pages.dropDuplicates([KEY])
    known = known_keys(spark, keys, batch)
    if known is not None:
        # Known keys are many: those of the batch go to them, not the other way round.
        met = known.join(pages.select(KEY).distinct(), KEY, "left_semi")
        fresh = fresh.join(met, KEY, "left_anti")
    cards = extract_cards(fresh, rules) if rules else extract_listing_cards(fresh)
    cards.write.mode("overwrite").parquet(f"{output}/batch={batch}")
    fresh.select(KEY).write.mode("overwrite").parquet(f"{keys}/batch={batch}")


def ingest_pages(
    spark: SparkSession, landing: str, output: str, checkpoint: str, rules: CardRules | None = None, files: int = 1000
) -> StreamingQuery:
    """Process all pages landed since the last run, each page once, and stop.

    Pages carry no event time, so there is no watermark and all page keys must be kept: they are a table next to the
    checkpoint, not state of the query, so their number is limited by storage only. A batch holds at most ``files`` files. NULL is a key
    like any other within a batch. Without rules the cards are restaurant listings. The cards have the number of their batch.
    """
    pages = spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", files).parquet(landing)
    return (
        pages.writeStream.foreachBatch(lambda batch, number: take_batch(batch, number, output, f"{checkpoint}/keys", rules))
        .option("checkpointLocation", f"{checkpoint}/log")
        .trigger(availableNow=True)
        .start()
    )
