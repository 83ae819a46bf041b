"""Connected components of an edge table, in joins and aggregates only."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from paperloom.llm.common import Forest, Scratch, lean


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Replaces each batch's edges by stars around the smallest node of each of its pieces."""
    for pdf in batches:
        if not len(pdf):
            continue
        nodes, at = np.unique(pdf[["a", "b"]].to_numpy().ravel(), return_inverse=True)
        forest = Forest(len(nodes))
        for x, y in at.reshape(-1, 2).tolist():
            forest.join(x, y)
        root = np.array([forest.find(i) for i in range(len(nodes))])
        own = root != np.arange(len(nodes))
        yield pd.DataFrame({"a": nodes[root[own]], "b": nodes[own]})


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b); a component's name is its smallest node.

    Every round takes the least label among a node's neighbours and then the label of
    that label, so that distances shrink by more than half. Labels stay in tables; the driver
    sees one count a round.
    """
    scratch = Scratch(edges.sparkSession)
    stars = scratch.keep(edges.select("a", "b").where("a <> b").mapInPandas(lean(_contract), "a long, b long").distinct(), "stars")
    both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = scratch.keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "labels0")
    for turn in count(1):
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        near = labels.join(seen, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("component").alias("far"))
        new = scratch.keep(near.join(jump, "mid", "left").select("node", "old", F.least("mid", F.coalesce("far", "mid")).alias("component")), f"labels{turn}")
        scratch.drop(f"labels{turn - 1}")
        labels = new.select("node", "component")
        if new.where("old <> component").isEmpty():
            scratch.drop("stars")
            return labels
