"""Crawl-frontier tables: what is to be fetched, when, and in which order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemart.operators.graph import AWAITING_FETCH, CREATED
from pagemart.operators.lineage import numbered, numbered_within, with_previous
from pagemart.operators.resolve import by_host

DELAY_SECONDS, ATTEMPTS, RETRY_SECONDS = 2.5, 3, 0.5


def unknown_seeds(seeds: DataFrame, known: DataFrame, url: str = "url") -> DataFrame:
    """Seeds that are not known; repeated seeds stay."""
    return seeds.join(known.select(url), url, "left_anti")


def seeds_by_host(seeds: DataFrame, known: DataFrame) -> DataFrame:
    """(host, urls) of unknown seeds (host, ord, url), in order."""
    return by_host(unknown_seeds(seeds, known), "host", "ord", "url")


def next_seeds(seeds: DataFrame, active: DataFrame) -> DataFrame:
    """(host, ord, url, state): the next seed of each host that has no active root."""
    idle = seeds.join(active.select("host"), "host", "left_anti")
    return idle.groupBy("host").agg(F.min("ord").alias("ord"), F.min_by("url", "ord").alias("url")).withColumn("state", F.lit(AWAITING_FETCH))


def queue_created(nodes: DataFrame) -> DataFrame:
    """Created nodes become awaiting, ahead of the others."""
    created = F.col("state") == CREATED
    return nodes.withColumn("ahead", F.when(created, 0).otherwise(1)).withColumn("state", F.when(created, AWAITING_FETCH).otherwise(F.col("state")))


def interleave(a: DataFrame, b: DataFrame, order: str = "ord") -> DataFrame:
    """(rn, source, ...): the first of a, the first of b, the second of a, and so on."""
    rows = numbered(a, order).withColumn("source", F.lit(0)).unionByName(numbered(b, order).withColumn("source", F.lit(1)))
    return rows.orderBy("rn", "source")


def fetch_plan(queue: DataFrame, last_fetch: DataFrame, delay: float = DELAY_SECONDS) -> DataFrame:
    """queue(host, ord, ...) with not_before in seconds: the host's last fetch plus a delay for each place in line."""
    return numbered_within(queue, "host", "ord", out="place").join(last_fetch.select("host", "last"), "host", "left").withColumn("not_before", F.coalesce("last", F.lit(0.0)) + F.lit(delay) * F.col("place")).drop("last")


def delay_audit(log: DataFrame, host: str, ts: str, delay: float = DELAY_SECONDS) -> DataFrame:
    """Fetches that came sooner than the delay after the one before on their host."""
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    return with_previous(log, host, at, "_previous").withColumn("gap_s", (at - F.col("_previous")) / 1e6).where(F.col("gap_s") < delay).drop("_previous")


def retry_plan(log: DataFrame, key: str, ts: str, attempts: int = ATTEMPTS, wait: float = RETRY_SECONDS) -> DataFrame:
    """(key, attempts, next_try, exhausted) from failed fetches."""
    tried = log.groupBy(key).agg(F.count(F.lit(1)).alias("attempts"), F.max(F.unix_micros(F.col(ts).cast("timestamp"))).alias("_last"))
    tried = tried.withColumn("exhausted", F.col("attempts") >= attempts)
    return tried.withColumn("next_try", F.when(~F.col("exhausted"), F.col("_last") / 1e6 + F.lit(wait) * F.col("attempts"))).drop("_last")


def fifo(queue: DataFrame, order: str = "ord") -> DataFrame:
    return queue.orderBy(order)


def lifo(queue: DataFrame, order: str = "ord") -> DataFrame:
    return queue.orderBy(F.col(order).desc())
