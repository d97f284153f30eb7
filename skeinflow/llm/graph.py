"""Connected components: of edge tables, and in memory."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import edge_components


def components(edges: DataFrame, rows: int | None = None) -> tuple[DataFrame, str]:
    """(node, component) for all nodes that ``edges`` (a, b; at most ``rows``) names, and the folder to remove after use."""
    found, path = edge_components(edges, rows)
    return found.select(F.col("v").alias("node"), F.col("u").alias("component")), path


def labels(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smallest index reachable of each of n nodes, over the edges (x, y), in memory."""
    label = np.arange(n)
    while len(x):
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        while True:
            jump = new[new]
            if (jump == new).all():
                break
            new = jump
        label = new[label]
        keep = label[x] != label[y]
        x, y = x[keep], y[keep]
    return label
