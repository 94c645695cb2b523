"""Boosted trees as flat arrays: read once from a fitted model, then evaluated with numpy inside Arrow maps.

A model is a table with a row per node. Its size is fixed by the number of output steps, rounds and the depth, never by
the data, so it travels to the tasks with the code that evaluates it.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd

from tidemark.functions.shipping import ship_with_tasks

ship_with_tasks(__name__)

NODE_SCHEMA = ("step int, tree int, weight double, node int, feature int, threshold double, below int, above int, "
               "value double")
NODE_COLUMNS = [c.split(" ")[0] for c in NODE_SCHEMA.split(", ")]
LINE = re.compile(r"Tree \d+ \(weight (?P<weight>\S+)\)|If \(feature (?P<feature>\d+) <= (?P<threshold>\S+)\)|Predict: (?P<value>\S+)")


def nodes_of(description: str, step: int) -> pd.DataFrame:
    """Nodes of an ensemble from its description: trees in order, each node before its lower and then its upper branch."""
    out, open_places = [], []
    tree, weight = -1, 1.0
    for found in LINE.finditer(description):
        if found["weight"] is not None:
            tree, weight, open_places = tree + 1, float(found["weight"]), []
            first = len(out)
            continue
        node = len(out) - first
        if open_places:
            parent, side = open_places.pop()
            out[parent][side] = node
        row = {"step": step, "tree": tree, "weight": weight, "node": node, "feature": -1, "threshold": 0.0, "below": node,
               "above": node, "value": 0.0}
        if found["feature"] is not None:
            row |= {"feature": int(found["feature"]), "threshold": float(found["threshold"])}
            open_places += [(len(out), "above"), (len(out), "below")]
        else:
            row["value"] = float(found["value"])
        out.append(row)
    return pd.DataFrame(out, columns=NODE_COLUMNS)


class Forest:
    """The trees of one output step, side by side. A leaf is its own successor."""

    def __init__(self, nodes: pd.DataFrame):
        nodes = nodes.sort_values(["tree", "node"])
        sizes = nodes.groupby("tree").size()
        self.roots = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(int)
        at = np.repeat(self.roots, sizes)
        self.leaf = nodes["feature"].to_numpy() < 0
        self.feature = np.maximum(nodes["feature"].to_numpy(), 0)
        self.threshold = nodes["threshold"].to_numpy()
        self.next = np.stack([nodes["above"].to_numpy() + at, nodes["below"].to_numpy() + at])
        self.value = nodes["value"].to_numpy()
        self.weights = nodes.groupby("tree")["weight"].first().to_numpy()

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Weighted sum of the trees for each row of ``x``. A missing value takes the upper branch."""
        at = np.repeat(self.roots[None], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        while not self.leaf[at].all():
            below = x[rows, self.feature[at]] <= self.threshold[at]
            at = self.next[below.astype(int), at]
        return self.value[at] @ self.weights


def forests(nodes: pd.DataFrame) -> list[Forest]:
    return [Forest(part) for _, part in nodes.groupby("step")]


def follow_blocks(seeds: np.ndarray, regressors: np.ndarray, steps: list[Forest], block: int) -> np.ndarray:
    """Scaled forecasts of many series side by side: ``seeds`` (series, days, columns) end before the first day of
    ``regressors`` (series, days, columns without the target). Each block enters the windows of the next ones."""
    n, n_in, _ = seeds.shape
    days = regressors.shape[1]
    ahead = np.concatenate([np.full((n, days, 1), np.nan), regressors], axis=2)
    x = np.concatenate([seeds, ahead], axis=1)
    for first in range(0, days, block):
        window = x[:, first:first + n_in].reshape(n, -1)
        for k in range(min(block, days - first)):
            x[:, n_in + first + k, 0] = steps[k](window)
    return x[:, n_in:, 0]
