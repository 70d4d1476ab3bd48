"""Facts and metrics as plain append streams.

New transactions are joined to the dimensions as they are when the stream starts (Spark lists the static tables' files
anew each time), and the metrics are a stream of their own from the fact table. Sinks are exactly-once file sinks. As in any
inner join with a stream on one side, a transaction whose owner is unknown by then is dropped; ``facts.FactFeed`` keeps such rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..catalog import FACTS, METRICS
from ..config import Settings
from ..plans import gold
from ..sources.tables import stream_table
from .feeds import append


def stream_facts(
    spark: SparkSession, settings: Settings, owners: DataFrame, owners_of_cards: DataFrame, cities: DataFrame, regions: DataFrame,
) -> StreamingQuery:
    """New card and account transactions into the fact table; each task writes few periods, so files stay few as data grows."""
    card, financial = (stream_table(spark, settings, f"{kind}_transactions_silver") for kind in ("card", "financial"))
    owned = gold.by_period(gold.owned_transactions(card, financial, owners, owners_of_cards))
    return append(gold.enriched(owned, cities, regions, settings), settings, FACTS)


def stream_metrics(spark: SparkSession, settings: Settings) -> StreamingQuery:
    """New facts into the metrics table."""
    return append(gold.business_metrics(stream_table(spark, settings, FACTS), settings), settings, METRICS)
