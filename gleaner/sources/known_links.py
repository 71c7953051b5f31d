"""The lasting set of known links: a table bucketed by link that is only appended to.

A join with it shuffles the other side into its buckets and reads the stored side as it lies, so a run costs what it brings and not
a shuffle of all links ever seen.  The folder is the table; a session that does not know it yet declares it anew.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: At least the number of shuffle partitions, or Spark shuffles both sides; fixed for the life of a table.
BUCKETS = 1024


def known_link_table(spark: SparkSession, path: str, buckets: int = BUCKETS) -> DataFrame:
    """(link, article_id) of the table at ``path``, which is made if it is not there."""
    return spark.table(_declared(spark, path, buckets))


def _declared(spark: SparkSession, path: str, buckets: int) -> str:
    name = "known_links_" + hashlib.md5(path.encode()).hexdigest()
    where = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (link STRING, article_id BIGINT) USING parquet "
        f"CLUSTERED BY (link) INTO {buckets} BUCKETS LOCATION '{where}'")
    return name


def catch_up(articles: DataFrame, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Append the links and canonical links of articles stored since the last call; returns the table.

    What is new is told by ``article_id``, which only grows, so older articles are skipped by the statistics of their files, and a
    run that stopped between storing articles and links is made good by the next call.
    """
    spark = articles.sparkSession
    name = _declared(spark, path, buckets)
    highest = spark.table(name).agg(F.max("article_id")).first()[0]
    new = articles if highest is None else articles.where(F.col("article_id") > highest)
    links = new.select("article_id", F.explode(F.array("link", "canonical_link")).alias("link"))
    links = links.where(F.coalesce(F.col("link"), F.lit("")) != "").groupBy("link").agg(F.min("article_id").alias("article_id"))
    # Every task holds one bucket, so an append writes at most one file per bucket.
    links.repartition(buckets, "link").write.insertInto(name)
    spark.catalog.refreshTable(name)
    return spark.table(name)
