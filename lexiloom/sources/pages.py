"""Crawled pages laid out by URL, so that a few URLs need only a few folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.session import read_note, write_note

PREFIXES = 256


def url_prefix(prefixes: int) -> Column:
    return F.pmod(F.xxhash64("url"), F.lit(prefixes)).cast("int")


def write_pages(pages: DataFrame, path: str, prefixes: int = PREFIXES, files: int = 1) -> PageStore:
    """Write ``url, text`` to a new store: a folder per prefix of the URL's hash, its files sorted by URL.

    Rows are kept as they are, repeated URLs too. ``files`` is how many files a prefix gets; more of them
    spread the writing of a large crawl, and a URL that very many rows have.
    """
    spread = F.pmod(F.xxhash64("url", "text"), F.lit(files))
    rows = pages.select("url", "text", url_prefix(prefixes).alias("prefix"), spread.alias("spread"))
    placed = rows.repartition("prefix", "spread").sortWithinPartitions("prefix", "url").drop("spread")
    placed.write.partitionBy("prefix").parquet(f"{path}/pages")
    write_note(pages.sparkSession, f"{path}/prefixes", str(prefixes))
    return PageStore(pages.sparkSession, path)


class PageStore:
    """Pages by URL, as ``write_pages`` has laid them out."""

    def __init__(self, spark: SparkSession, path: str):
        found = read_note(spark, f"{path}/prefixes")
        if found is None:
            raise FileNotFoundError(f"{path} is no finished page store")
        self.spark, self.path, self.prefixes = spark, path, int(found)

    def all(self) -> DataFrame:
        return self.spark.read.schema("url string, text string, prefix int").parquet(f"{self.path}/pages")

    def holding(self, urls: DataFrame) -> DataFrame:
        """``url, text`` of the folders that may hold one of ``urls``; no other folder is listed or read.

        At most as many numbers as there are prefixes go through the driver.
        """
        wanted = [r[0] for r in urls.select(url_prefix(self.prefixes).alias("prefix")).distinct().collect()]
        return self.all().filter(F.col("prefix").isin(wanted) if wanted else F.lit(False)).select("url", "text")
