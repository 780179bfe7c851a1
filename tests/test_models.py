"""The joint fit of the heads against NumPy over explicit windows, and permutation scores against swapped columns."""

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from seriesmill.operators import dataset as ds, models, selection as sel
from seriesmill.plans.blocks import Layout

HOUR = 3_600_000
LENGTH, SEQUENCE, CONTEXT = 5, ["a", "b"], ["c"]


def rows(n=70, seed=3):
    rng = np.random.default_rng(seed)
    parts = []
    for s, symbol in enumerate(["AAA", "BBB"]):
        m = n - 20 * s
        parts.append(pd.DataFrame({
            "source": "s", "market_type": "spot", "symbol": symbol, "timeframe": "1h", "ts": pd.date_range("2024-01-01", periods=m, freq="h"),
            "a": rng.normal(size=m), "b": rng.normal(size=m), "c": rng.normal(size=m), "asset_id": s, "tf_id": 1,
            "split": np.where(np.arange(m) < 0.7 * m, "train", np.where(np.arange(m) % 9 == 0, None, "val")),
            "y_direction": rng.integers(0, 3, m), "y_regime": rng.integers(0, 6, m), "y_cycle": rng.integers(0, 4, m), "y_trade_quality": rng.integers(0, 2, m)}))
    return pd.concat(parts, ignore_index=True)


def plain_inputs(pdf):
    """Flattened windows of all samples, their last rows."""
    x, last = [], []
    for _, part in pdf.groupby("symbol"):
        part = part.sort_values("ts").reset_index(drop=True)
        for i in range(LENGTH - 1, len(part)):
            if isinstance(part.split[i], str):
                x.append(np.concatenate([part[SEQUENCE].to_numpy()[i - LENGTH + 1:i + 1].ravel(), part.loc[i, ["c", "asset_id", "tf_id"]].to_numpy(float)]))
                last.append(part.loc[i])
    return np.array(x), pd.DataFrame(last)


def plain_fit(pdf, passes, rate=0.02, ridge=1e-3):
    x, last = plain_inputs(pdf)
    train = (last.split == "train").to_numpy()
    x, last = x[train], last[train]
    count = pdf[pdf.split == "train"].y_direction.value_counts().reindex(range(3), fill_value=0).clip(lower=1)
    weight = 1 / np.sqrt(count)
    weight = (weight / weight.mean()).to_numpy()
    w, b, losses = np.zeros((x.shape[1], 15)), np.zeros(15), []
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    for t in range(1, passes + 1):
        logits, r, loss, at = x @ w + b, [], 0.0, 0
        for head, (label, k) in models.HEADS.items():
            e = np.exp(logits[:, at:at + k])
            p, y, at = e / e.sum(axis=1, keepdims=True), last[label].to_numpy(int), at + k
            s = weight[y] if head == "direction" else np.ones(len(y))
            loss -= (s * np.log(p[np.arange(len(y)), y])).sum()
            r.append(s[:, None] * (p - np.eye(k)[y]))
        r = np.concatenate(r, axis=1)
        losses.append(loss / len(x))
        for p, g, m, v in ((w, x.T @ r, *state[:2]), (b, r.sum(axis=0), *state[2:])):
            g = g / len(x) + ridge * p
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w, b, losses


def test_joint_fit_equals_numpy_for_any_blocks(spark):
    pdf = rows()
    w, b, losses = plain_fit(pdf, 6)
    x, last = plain_inputs(pdf)
    logits = x @ w + b
    up = np.exp(logits[:, 2]) / np.exp(logits[:, :3]).sum(axis=1)
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp"))
    for layout in (Layout(step_ms=HOUR), Layout(step_ms=HOUR, rows=16, sub_rows=8, bucket_steps=32)):
        model = models.train_heads(df, layout, SEQUENCE, CONTEXT, LENGTH, passes=6)
        assert np.allclose(model.losses, losses, rtol=1e-10) and losses[-1] < losses[0]
        assert np.allclose(model.steps.reshape(-1, 15), w[:LENGTH * 2], atol=1e-9) and np.allclose(model.bias, b, atol=1e-9)
        got = models.score(df, layout, model).toPandas().sort_values(["symbol", "ts"])
        assert np.allclose(got.p_up.to_numpy(), up, atol=1e-9) and got.y_cycle.tolist() == last.y_cycle.tolist()
        assert (got.regime_id.to_numpy() == logits[:, 3:9].argmax(axis=1)).all()


def test_windows_are_views_and_sums_over_them_are_right():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 3))
    ends = np.array([4, 5, 9, 39])
    w = ds.Windows(x, ends, 5, None)
    weights, values = rng.normal(size=(5, 3, 2)), rng.normal(size=(4, 2))
    explicit = np.stack([x[e - 4:e + 1] for e in ends])
    assert np.array_equal(w.all().transpose(0, 2, 1), explicit)
    assert np.allclose(w.project(weights), np.einsum("skc,kco->so", explicit, weights))
    assert np.allclose(w.gather(values), np.einsum("skc,so->kco", explicit, values))


def test_training_without_rows_ends(spark):
    df = spark.createDataFrame(rows()).withColumn("ts", F.col("ts").cast("timestamp"))
    layout = Layout(step_ms=HOUR)
    model = models.train_heads(df.where("split = 'val'"), layout, SEQUENCE, CONTEXT, LENGTH, passes=2)
    assert model.losses == [] and not model.steps.any()
    assert models.score(df.limit(2), layout, model).count() == 0


def test_permutation_scores_equal_swapped_columns(spark):
    rng = np.random.default_rng(5)
    n = 400
    pdf = pd.DataFrame({"i": range(n), "s": rng.normal(size=n), "t": rng.integers(0, 4, n).astype(float), "noise": rng.normal(size=n), "flat": 1.0})
    pdf["y"] = ((pdf.s + 0.4 * (pdf.t > 1) + 0.1 * rng.normal(size=n)) > 0.2).astype(int)
    df = spark.createDataFrame(pdf)
    columns = ["s", "t", "noise", "flat"]
    data = VectorAssembler(inputCols=columns, outputCol="features").transform(df.withColumn("_y", F.col("y").cast("double")))
    model = GBTClassifier(labelCol="_y", maxIter=6, maxDepth=3, seed=1).fit(data)
    trees = sel.Trees.of(model)
    x, y = pdf[columns].to_numpy(float), pdf.y.to_numpy()
    want = model.transform(data).orderBy("i").toPandas().prediction.to_numpy()
    assert ((trees.margins(x, np.arange(6)).sum(axis=0) > 0) == (want > 0)).all()
    other = x[rng.permutation(n)]
    hits = sel.swapped_hits(trees, x, other, range(4), y)
    for c in range(4):
        changed = x.copy()
        changed[:, c] = other[:, c]
        swapped = spark.createDataFrame(pd.DataFrame(changed, columns=columns).assign(i=range(n), _y=y.astype(float)))
        p = model.transform(VectorAssembler(inputCols=columns, outputCol="features").transform(swapped)).orderBy("i").toPandas().prediction
        assert hits[c] == int((p.to_numpy() == y).sum())
    score = {r["feature"]: r["score"] for r in sel.permutation_importance(df, columns, "y", ["i"], repeats=3, trees=6).collect()}
    assert score["flat"] == 0 and score["s"] > 0.2 > score["t"] > abs(score["noise"])


def test_one_gradient_reaches_the_driver_whatever_the_number_of_parts(spark):
    from seriesmill.operators import models
    for n in (0, 1, 40):
        rows = [(1.0, 2, np.array([float(k), 1.0]).tobytes()) for k in range(n)]
        found = models.summed(spark.createDataFrame(rows, models.GRADIENT).repartition(8)).collect()
        assert len(found) == min(n, 1)
        for r in found:
            assert (r["loss"], r["n"], np.frombuffer(r["sums"]).tolist()) == (float(n), 2 * n, [n * (n - 1) / 2, float(n)])


def test_counting_samples_fits_no_scaler(spark, monkeypatch):
    from seriesmill.catalog import QUERIES, dataset
    monkeypatch.setattr(dataset.ds, "fit_scaler", None)
    counted = {(r["split"], r["y_direction"]): r["samples"] for r in QUERIES["d7_stacked_training_set"](spark, "/root/testdata/sf0.01").collect()}
    spec = QUERIES["d9_dataset_spec"](spark, "/root/testdata/sf0.01").collect()
    for part in ("train", "val", "test"):
        assert sum(n for (split, _), n in counted.items() if split == part) == sum(r[f"{part}_rows"] for r in spec) > 0


def test_swapped_columns_copy_the_rows_once_and_take_known_margins():
    class Rows(np.ndarray):
        copies = 0

        def copy(self, *a):
            Rows.copies += 1
            return super().copy(*a)

    rng = np.random.default_rng(3)
    shape = (5, 3)
    feature, left, right = np.full(shape, -1), np.zeros(shape, int), np.zeros(shape, int)
    feature[:, 0], left[:, 0], right[:, 0] = [0, 1, 2, 1, 0], 1, 2
    trees = sel.Trees(feature, rng.normal(size=shape), left, right, rng.normal(size=shape), np.full(5, 0.5), 1)
    x, other, y = rng.normal(size=(50, 4)), rng.normal(size=(50, 4)), rng.integers(0, 2, 50)
    seen = x.copy().view(Rows)
    hits = sel.swapped_hits(trees, seen, other, range(4), y, trees.margins(x, np.arange(5)))
    assert Rows.copies == 1 and (np.asarray(seen) == x).all()
    for c in range(4):
        swapped = x.copy()
        swapped[:, c] = other[:, c]
        assert hits[c] == int(((trees.margins(swapped, np.arange(5)).sum(axis=0) > 0) == (y > 0)).sum())


def test_permutation_scores_with_values_that_no_vector_may_hold(spark):
    """NaN and infinity count as missing (0), rows without a label are left out, and no rows have no scores."""
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"i": range(300), "s": rng.normal(size=300), "odd": rng.normal(size=300)})
    pdf["y"] = (pdf.s > 0).astype(int)
    plain = spark.createDataFrame(pdf)
    k = F.col("i") % 9
    odd = F.when(k == 0, float("nan")).when(k == 1, float("inf")).when(k == 2, float("-inf")).when(k == 3, F.lit(None)).otherwise(F.col("odd"))
    zero = F.when(k < 4, 0.0).otherwise(F.col("odd"))
    scores = lambda df: {r["feature"]: r["score"] for r in sel.permutation_importance(df, ["s", "odd"], "y", ["i"], repeats=2, trees=4).collect()}
    got = scores(plain.withColumn("odd", odd))
    assert got == scores(plain.withColumn("odd", zero)) and got["s"] > 0.2
    unlabelled = plain.withColumn("i", F.col("i") + 1000).withColumn("y", F.lit(None).cast("int"))
    assert scores(plain.withColumn("odd", zero).unionByName(unlabelled)) == got
    assert scores(plain.where("false")) == {}
