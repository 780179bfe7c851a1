"""The four prediction heads: one softmax model over whole windows, fitted jointly, and batch scoring.

All heads read every step of a sample's window, its context and its ids.  One pass over the rows gives the
gradient of all heads: a task reads blocks of rows, forms windows as views and leaves one gradient per block; these are
added up in three steps by Spark, so what reaches the driver is one gradient per pass whatever the number of samples.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from seriesmill.operators.dataset import Windows, class_weights, over_windows, window_blocks
from seriesmill.operators.rows import latest
from seriesmill.plans.blocks import Layout

HEADS = {"direction": ("y_direction", 3), "regime": ("y_regime", 6), "cycle": ("y_cycle", 4), "quality": ("y_trade_quality", 2)}
LABELS = [label for label, _ in HEADS.values()]
#: Tasks that add up the gradients of all others; one more adds up theirs, so one sum reaches the driver per pass.
PARTS = 8
GRADIENT = "loss double, n bigint, sums binary"


@dataclass
class Heads:
    """Weights of every step and column (``steps``), of the context and ids (``flat``), and one bias per class."""

    sequence: list[str]
    context: list[str]
    length: int
    steps: np.ndarray
    flat: np.ndarray
    bias: np.ndarray
    losses: list[float] = field(default_factory=list)

    @classmethod
    def start(cls, sequence: Sequence[str], context: Sequence[str], length: int) -> Heads:
        sequence, flat, outputs = list(sequence), [*context, "asset_id", "tf_id"], sum(n for _, n in HEADS.values())
        return cls(sequence, flat, length, np.zeros((length, len(sequence), outputs)), np.zeros((len(flat), outputs)), np.zeros(outputs))

    def parameters(self) -> list[np.ndarray]:
        return [self.steps, self.flat, self.bias]


def _flat(windows: Windows, names: Sequence[str]) -> np.ndarray:
    return np.stack([windows.carried.column(c).to_numpy().astype(np.float64) for c in names], axis=1)


def probabilities(model: Heads, windows: Windows) -> list[np.ndarray]:
    """Class probabilities of every head: samples x classes each."""
    logits = windows.project(model.steps) + _flat(windows, model.context) @ model.flat + model.bias
    out, at = [], 0
    for _, classes in HEADS.values():
        part = np.exp(logits[:, at:at + classes] - logits[:, at:at + classes].max(axis=1, keepdims=True))
        out.append(part / part.sum(axis=1, keepdims=True))
        at += classes
    return out


def gradient(model: Heads, windows: Windows, weights: Sequence[float]) -> tuple[float, int, list[np.ndarray]]:
    """Sum of the losses of all heads over the training samples, their number and the gradient of the sum.

    A direction counts by its class weight.
    """
    train = windows.carried.column("split").to_numpy(zero_copy_only=False) == "train"
    some = Windows(windows.rows, windows.ends[train], windows.length, windows.carried.filter(pa.array(train)))
    residuals, loss = [], 0.0
    for (head, (label, classes)), p in zip(HEADS.items(), probabilities(model, some)):
        y = some.carried.column(label).to_numpy().astype(int)
        w = np.asarray(weights)[y] if head == "direction" else np.ones(len(y))
        loss -= float((w * np.log(np.maximum(p[np.arange(len(y)), y], 1e-300))).sum())
        residuals.append(w[:, None] * (p - np.eye(classes)[y]))
    r = np.concatenate(residuals, axis=1)
    return loss, len(r), [some.gather(r), _flat(some, model.context).T @ r, r.sum(axis=0)]


def train_heads(samples: DataFrame, layout: Layout, sequence: Sequence[str], context: Sequence[str], length: int, passes: int = 25,
                rate: float = 0.02, ridge: float = 1e-3) -> Heads:
    """Fit all heads on the rows of split ``train`` by Adam over full passes.

    ``samples`` has the scaled rows with ``split`` and ``targets``; rows of every split serve as steps of windows.
    """
    model = Heads.start(sequence, context, length)
    carry = ["split", *model.context, *LABELS]
    blocks = window_blocks(samples, layout, sequence, length, carry).persist(StorageLevel.DISK_ONLY)
    rows = class_weights(samples.where("split = 'train'"), "y_direction").orderBy("label").collect()  # three rows
    weights = [r["weight"] for r in rows]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in model.parameters()]
    try:
        for turn in range(1, passes + 1):
            loss, n, grads = _one_pass(blocks, layout, model, carry, weights)
            if not n:
                break
            model.losses.append(loss / n)
            for p, g, (m, v) in zip(model.parameters(), grads, moments):
                g = g / n + ridge * p
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.999 ** turn)) + 1e-8)
    finally:
        blocks.unpersist()
    return model


def _added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    loss, n, total = 0.0, 0, None
    for batch in batches:
        for row in batch.itertuples():
            part = np.frombuffer(row.sums)
            loss, n, total = loss + row.loss, n + row.n, part.copy() if total is None else total + part
    if total is not None:
        yield pd.DataFrame({"loss": [loss], "n": [n], "sums": [total.tobytes()]})


def summed(parts: DataFrame) -> DataFrame:
    """One row, the sum of all rows of ``parts`` (none for none): first inside the tasks, then in a few tasks, then in one."""
    few = parts.mapInPandas(_added, GRADIENT).repartition(PARTS).mapInPandas(_added, GRADIENT)
    return few.repartition(1).mapInPandas(_added, GRADIENT)


def _one_pass(blocks: DataFrame, layout: Layout, model: Heads, carry: Sequence[str], weights: Sequence[float]) -> tuple[float, int, list[np.ndarray]]:
    shared = blocks.sparkSession.sparkContext.broadcast(model)
    shapes = [p.shape for p in model.parameters()]

    def each(windows: Windows) -> pa.Table:
        loss, n, grads = gradient(shared.value, windows, weights)
        return pa.table({"loss": [loss], "n": [n], "sums": pa.array([np.concatenate([g.ravel() for g in grads]).tobytes()], pa.binary())})

    one = summed(over_windows(blocks, layout, model.sequence, model.length, carry, each, GRADIENT)).first()
    shared.unpersist()
    total = np.frombuffer(one["sums"]) if one else np.zeros(sum(int(np.prod(s)) for s in shapes))
    cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
    return one["loss"] if one else 0.0, one["n"] if one else 0, [g.reshape(s) for g, s in zip(np.split(total, cuts), shapes)]


def score(samples: DataFrame, layout: Layout, model: Heads) -> DataFrame:
    """Class probabilities of every head for every sample, next to its keys, split and targets."""
    keep = [*layout.keys, layout.ts, "split", *LABELS]
    carry = list(dict.fromkeys([*keep, *model.context]))
    kinds = {f.name: f.dataType.simpleString() for f in samples.schema.fields}
    shared = samples.sparkSession.sparkContext.broadcast(model)

    def each(windows: Windows) -> pa.Table:
        direction, regime, cycle, quality = probabilities(shared.value, windows)
        out = windows.carried.select(keep)
        for name, value in {"p_down": direction[:, 0], "p_sideways": direction[:, 1], "p_up": direction[:, 2],
                            "regime_id": regime.argmax(axis=1).astype(np.int32), "regime_confidence": regime.max(axis=1),
                            "cycle_id": cycle.argmax(axis=1).astype(np.int32), "cycle_confidence": cycle.max(axis=1),
                            "quality": quality[:, 1]}.items():
            out = out.append_column(name, pa.array(value))
        return out

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + (
        ", p_down double, p_sideways double, p_up double, regime_id int, regime_confidence double, cycle_id int, cycle_confidence double, quality double")
    blocks = window_blocks(samples, layout, model.sequence, model.length, carry)
    return over_windows(blocks, layout, model.sequence, model.length, carry, each, schema)


def latest_predictions(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    return latest(scored, keys)
