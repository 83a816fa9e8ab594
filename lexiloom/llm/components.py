"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (or smaller and own) neighbours of every node below its least neighbour.

    ``edges`` has ``a > b``. Both neighbourhoods are joins with one row per node, which Spark
    splits where a node is hot.
    """
    out = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        out = out.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = materialize(out.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star-least")
    hung = out.join(least, "u")
    if large:
        hung = hung.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        hung = hung.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return hung.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` for every node of ``edges`` (``a``, ``b``) that is not the least of its component.

    ``comp`` is the least node reachable. Links to itself, repeated links and either direction
    are fine; nothing but one count and checksum per round reaches the driver.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges, before = materialize(edges, "links"), None
    while True:
        edges = materialize(_star(materialize(_star(edges, True), "star-large"), False), "star-small")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
        before = now
