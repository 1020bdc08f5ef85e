"""Next-state models per symbol and the averaged transition matrix.

For every symbol and class a one-against-rest logistic model minimises
``|w|^2 / 2 + sum log(1 + exp(-y w.x))`` over six lagged returns and a constant, the constant being
penalised like the rest. Two classes need one model, for the later class.

Symbols of up to ``GROUP_ROWS`` training rows are fitted whole, many side by side, after a single shuffle.
Larger ones, of which there may be any number, are fitted by rounds of partially aggregated gradient and
Hessian sums over blocks of their rows, which are dealt evenly over the tasks once; a row for each model
holds where its iteration stands.

A fit counts as done when the gradient is zero for all practical purposes, not when steps get short. One
that does not get there in ``MAX_ROUNDS`` has the status ``not_converged``, no weights and no matrix.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidebars.operators.states import scoring_rows, training_rows
from tidebars.schema import FEATURE_COLS
from tidebars.session import Rounds, remove_folder, scratch_dir, ship_package

MODEL_SCHEMA = "symbol string, classes array<string>, weights array<array<double>>, status string"
#: Training rows of a symbol that one task fits at most, whatever the size of the table.
GROUP_ROWS = 200_000
#: Largest slope left over, as a share of the loss.
TOLERANCE = 1e-10
MAX_ROUNDS = 100
N_WEIGHTS = len(FEATURE_COLS) + 1
#: Rows of whole symbols that a task fits side by side, unless one symbol has more.
TOGETHER = 20_000

#: Rows and columns of an upper triangle, and for each entry of the square its place in it.
_UPPER = np.triu_indices(N_WEIGHTS)
_MIRROR = np.zeros((N_WEIGHTS, N_WEIGHTS), dtype=int)
_MIRROR[_UPPER] = _MIRROR.T[_UPPER] = np.arange(len(_UPPER[0]))


def classes_per_symbol(features: DataFrame) -> DataFrame:
    """Sorted distinct target states of the training rows."""
    return training_rows(features).groupBy("symbol").agg(
        F.array_sort(F.collect_set("target_state")).alias("classes")
    )


def label_codes(features: DataFrame) -> DataFrame:
    """Training rows with ``label``: the position of the target among the symbol's classes."""
    rows = training_rows(features)
    return rows.join(classes_per_symbol(features), "symbol").select(
        "symbol", "timestamp", "target_state",
        (F.array_position("classes", F.col("target_state")) - 1).alias("label"),
    )


# -- fitting -----------------------------------------------------------------------------------


def newton_step(w, kept_w, kept_loss, step, loss, gradient, hessian):
    """One round of many models, a row each: the same four and whether a model is done.

    A step that raised the loss is halved and taken again from the weights kept before it.
    """
    done = np.abs(gradient).max(axis=1) <= TOLERANCE * np.maximum(100.0, loss)
    worse = ~done & (loss > kept_loss + 1e-9 * (1.0 + np.abs(kept_loss)))
    on = ~done & ~worse
    step = np.where(worse[:, None], step / 2.0, step)
    step[on] = np.linalg.solve(hessian[on], gradient[on][:, :, None])[:, :, 0]
    kept_w, kept_loss = np.where(on[:, None], w, kept_w), np.where(on, loss, kept_loss)
    return np.where(done[:, None], w, kept_w - step), kept_w, kept_loss, step, done


def _square(upper: np.ndarray) -> np.ndarray:
    """Hessians from their upper triangles, a row each, the penalty included."""
    return upper[:, _MIRROR] + np.eye(N_WEIGHTS)


def _fit_models(x: np.ndarray, y: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of a model for each run of ``sizes`` rows, and whether its iteration ended."""
    weights, ended = np.zeros((len(sizes), N_WEIGHTS)), np.zeros(len(sizes), dtype=bool)
    still, products = np.arange(len(sizes)), x[:, _UPPER[0]] * x[:, _UPPER[1]]
    state = np.zeros_like(weights), np.zeros_like(weights), np.full(len(sizes), np.inf), np.zeros_like(weights)
    for _ in range(MAX_ROUNDS):
        w, starts = state[0], np.cumsum(sizes) - sizes
        margin = y * np.einsum("ij,ij->i", x, np.repeat(w, sizes, axis=0))
        miss = 0.5 * (1.0 - np.tanh(0.5 * margin))
        loss = 0.5 * np.einsum("ij,ij->i", w, w) + np.add.reduceat(np.logaddexp(0.0, -margin), starts)
        gradient = w - np.add.reduceat(x * (y * miss)[:, None], starts)
        hessian = _square(np.add.reduceat(products * (miss * (1.0 - miss))[:, None], starts))
        *state, done = newton_step(*state, loss, gradient, hessian)
        weights[still], ended[still] = state[0], done
        if done.all():
            break
        if done.any():
            rows = np.repeat(~done, sizes)
            x, y, products = x[rows], y[rows], products[rows]
            state, still, sizes = [s[~done] for s in state], still[~done], sizes[~done]
    return weights, ended


def _positive_classes(classes: list[str]) -> list[str]:
    return classes[1:] if len(classes) == 2 else classes


def _fit_group(pdf: pd.DataFrame) -> pd.DataFrame:
    """Models of a group of whole symbols, the rows of each one after the other."""
    x = np.column_stack([pdf[FEATURE_COLS].to_numpy(dtype=float), np.ones(len(pdf))])
    symbols, targets = pdf["symbol"].to_numpy(), pdf["target_state"].to_numpy()
    starts = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
    sizes = np.diff(np.append(starts, len(symbols)))
    classes = [sorted(set(targets[a : a + n])) for a, n in zip(starts, sizes)]
    labels = [_positive_classes(c) if len(c) > 1 else [] for c in classes]
    weights, status = [[] for _ in classes], ["ok" if len(c) > 1 else "single_class" for c in classes]
    for k in range(max(map(len, labels))):
        own = np.array([len(names) > k for names in labels])
        rows, wanted = np.repeat(own, sizes), np.array([names[k] for names in labels if len(names) > k], dtype=object)
        y = np.where(targets[rows] == np.repeat(wanted, sizes[own]), 1.0, -1.0)
        for place, w, ended in zip(np.flatnonzero(own), *_fit_models(x[rows], y, sizes[own])):
            weights[place].append(w.tolist())
            status[place] = status[place] if ended else "not_converged"
    weights = [w if s == "ok" else [] for w, s in zip(weights, status)]
    return pd.DataFrame({"symbol": symbols[starts], "classes": classes, "weights": weights, "status": status})


def _fit_sorted(batches):
    """Models of symbols whose rows come sorted, about ``TOGETHER`` rows of whole symbols at a time."""
    held, n = [], 0
    for pdf in batches:
        held, n = [*held, pdf], n + len(pdf)
        if n < TOGETHER:
            continue
        rows = pd.concat(held, ignore_index=True)
        ready = int((rows["symbol"] != rows["symbol"].iloc[-1]).sum())
        held, n = [rows.iloc[ready:]], n - ready
        if ready:
            yield _fit_group(rows.iloc[:ready])
    if n:
        yield _fit_group(pd.concat(held, ignore_index=True))


def _inputs() -> list[Column]:
    return [F.col(c) for c in FEATURE_COLS] + [F.lit(1.0)]


def _dot(weights: Column) -> Column:
    return reduce(lambda a, b: a + b, [weights[i] * x for i, x in enumerate(_inputs())])


def model_sums(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """Sums of one Newton round for every (symbol, label): ``loss``, ``g0..g6``, ``h0_0..h6_6``.

    ``weights`` has (symbol, label, w); the penalty is not included. Rows are aggregated where they
    are before one row per model and task is shuffled.
    """
    y = F.when(F.col("target_state") == F.col("label"), 1.0).otherwise(-1.0)
    placed = rows.join(weights, "symbol").select("symbol", "label", *FEATURE_COLS, y.alias("_y"),
                                                 (y * _dot(F.col("w"))).alias("_m"))
    placed = placed.withColumn("_miss", 1.0 / (1.0 + F.exp("_m")))
    x = _inputs()
    loss = F.greatest(-F.col("_m"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("_m")))
    gradient = [F.sum(-F.col("_y") * F.col("_miss") * x[i]).alias(f"g{i}") for i in range(N_WEIGHTS)]
    hessian = [
        F.sum(F.col("_miss") * (1.0 - F.col("_miss")) * x[i] * x[j]).alias(f"h{i}_{j}")
        for i in range(N_WEIGHTS) for j in range(i, N_WEIGHTS)
    ]
    return placed.groupBy("symbol", "label").agg(F.sum(loss).alias("loss"), *gradient, *hessian)


_BLOCK_SCHEMA = "symbol string, size int, x binary, code binary"
_SUMS = ["loss"] + [f"g{i}" for i in range(N_WEIGHTS)] + [f"h{i}_{j}" for i, j in zip(*_UPPER)]
_SUMS_SCHEMA = "symbol string, place int, " + ", ".join(f"{c} double" for c in _SUMS)


def _pack(batches):
    """Blocks of rows of one symbol, as bytes, from rows in which symbols stand together: features and the target's place."""
    for pdf in batches:
        symbols, code = pdf["symbol"].to_numpy(), pdf["code"].to_numpy(dtype=np.int8)
        x = pdf[FEATURE_COLS].to_numpy(dtype=float)
        starts = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1]))) if len(pdf) else []
        for a, b in zip(starts, [*starts[1:], len(pdf)]):
            yield pd.DataFrame({"symbol": [symbols[a]], "size": [b - a], "x": [x[a:b].tobytes()], "code": [code[a:b].tobytes()]})


def _block_sums(batches):
    """Sums of one Newton round, the penalty left out, for each block and open model of its symbol."""
    for pdf in batches:
        out = []
        for symbol, size, packed, code, models in zip(*(pdf[c] for c in ("symbol", "size", "x", "code", "models"))):
            x = np.ones((N_WEIGHTS, size))
            x[:-1] = np.frombuffer(packed).reshape(size, -1).T
            places = [m["place"] for m in models]
            y = np.where(np.frombuffer(code, dtype=np.int8) == np.array(places)[:, None], 1.0, -1.0)
            margin = y * (np.array([m["w"] for m in models], dtype=float) @ x)
            tail = np.exp(-np.abs(margin))
            loss = np.log1p(tail).sum(axis=1) - np.minimum(margin, 0.0).sum(axis=1)
            gradient = -(y * np.where(margin > 0.0, tail, 1.0) / (1.0 + tail)) @ x.T
            spread = tail / (1.0 + tail) ** 2
            out += [(symbol, k, a, *g, *((x * d) @ x.T)[_UPPER]) for k, a, g, d in zip(places, loss, gradient, spread)]
        yield pd.DataFrame(out, columns=["symbol", "place", *_SUMS])


_STANDING = "symbol string, place int, w array<double>, kept_w array<double>, kept_loss double, step array<double>, done boolean"


def _advance(batches):
    """One Newton step of every model from its sums and its standing."""
    for pdf in batches:
        if len(pdf) == 0:
            continue
        w, kept_w, step = (np.stack(pdf[c]).astype(float) for c in ("w", "kept_w", "step"))
        gradient = w + pdf[[f"g{i}" for i in range(N_WEIGHTS)]].to_numpy(dtype=float)
        hessian = _square(pdf[[f"h{i}_{j}" for i, j in zip(*_UPPER)]].to_numpy(dtype=float))
        loss = pdf["loss"].to_numpy(dtype=float) + 0.5 * np.einsum("ij,ij->i", w, w)
        made = newton_step(w, kept_w, pdf["kept_loss"].to_numpy(dtype=float), step, loss, gradient, hessian)
        columns = dict(zip(("w", "kept_w", "kept_loss", "step", "done"), made))
        yield pd.DataFrame({"symbol": pdf["symbol"], "place": pdf["place"]} | {c: list(v) for c, v in columns.items()})


def pack_rows(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Training rows of the symbols in ``classes`` as blocks (symbol, size, x, code), dealt evenly over the tasks however few
    symbols there are: (symbol, timestamp) is unique, and a symbol may lie in any number of tasks."""
    place = (F.array_position("classes", F.col("target_state")) - 1).cast("int").alias("code")
    coded = rows.join(classes, "symbol").select("symbol", "timestamp", *FEATURE_COLS, place)
    dealt = coded.repartition("symbol", "timestamp").sortWithinPartitions("symbol").drop("timestamp")
    return dealt.mapInPandas(_pack, _BLOCK_SCHEMA)


def _fit_large(blocks: DataFrame, classes: DataFrame) -> DataFrame:
    """Models of the symbols in ``classes``, by rounds over the ``blocks`` of their rows. Where each model stands is a row of a
    table in the shared folder, so any number of symbols may be large and nothing of theirs comes to the driver."""
    zeros = F.array(*[F.lit(0.0)] * N_WEIGHTS)
    written = Rounds(blocks.sparkSession, "standing")
    # of two classes the later one has a model, of one class none
    own = (F.size("classes") > 2) | ((F.size("classes") == 2) & (F.col("place") == 1))
    standing = written.write(classes.select("symbol", "classes", F.posexplode("classes").alias("place", "label")).filter(own).select(
        "symbol", "place", zeros.alias("w"), zeros.alias("kept_w"), F.lit(float("inf")).alias("kept_loss"), zeros.alias("step"),
        F.lit(False).alias("done")))
    for _ in range(MAX_ROUNDS):
        open_ = standing.filter(~F.col("done"))
        if open_.isEmpty():
            break
        models = open_.groupBy("symbol").agg(F.collect_list(F.struct("place", "w")).alias("models"))
        parts = blocks.join(models, "symbol").mapInPandas(_block_sums, _SUMS_SCHEMA)
        sums = parts.groupBy("symbol", "place").agg(*[F.sum(c).alias(c) for c in _SUMS])
        moved = open_.join(sums, ["symbol", "place"]).mapInPandas(_advance, _STANDING)
        standing = written.write(standing.filter("done").unionByName(moved))
    # one row per class, of which there are five at most
    fitted = standing.groupBy("symbol").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "w"))), lambda m: m["w"]).alias("weights"),
        F.bool_and("done").alias("done"))
    status = F.when(F.size("classes") < 2, "single_class").when(F.col("done"), "ok").otherwise("not_converged")
    none = F.array().cast("array<array<double>>")
    return classes.join(fitted, "symbol", "left").select(
        "symbol", "classes", F.when(F.col("done"), F.col("weights")).otherwise(none).alias("weights"), status.alias("status"))


def fit_transitions(features: DataFrame, group_rows: int | None = None) -> DataFrame:
    """(symbol, classes, weights, status, n, dropped): one row per symbol of ``features``.

    ``status`` is "ok", "single_class", "not_converged" or "no_data"; ``n`` counts training rows and
    ``dropped`` the rows left out because a zero close made a feature undefined. ``group_rows`` may lower
    ``GROUP_ROWS``.
    """
    ship_package(features.sparkSession)
    limit = min(group_rows or GROUP_ROWS, GROUP_ROWS)
    rows = training_rows(features).select("symbol", "timestamp", *FEATURE_COLS, "target_state")
    undefined = F.col("history") & reduce(lambda a, b: a | b, [F.col(c).isNull() for c in FEATURE_COLS])
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*FEATURE_COLS, "target_state"]])
    counts = Rounds(features.sparkSession, "model-counts").write(features.groupBy("symbol").agg(
        F.count_if(complete).alias("n"), F.count_if(undefined).alias("dropped"),
        F.array_sort(F.collect_set(F.when(complete, F.col("target_state")))).alias("found")))
    large = counts.filter(F.col("n") > limit)
    any_large = not large.isEmpty()
    small = rows.join(large.select("symbol"), "symbol", "left_anti") if any_large else rows
    models = small.drop("timestamp").repartition("symbol").sortWithinPartitions("symbol").mapInPandas(_fit_sorted, MODEL_SCHEMA)
    if any_large:
        classes = large.select("symbol", F.col("found").alias("classes"))
        path = scratch_dir(features.sparkSession, "blocks")
        try:
            pack_rows(rows, classes).write.parquet(path)
            models = models.unionByName(_fit_large(features.sparkSession.read.schema(_BLOCK_SCHEMA).parquet(path), classes))
        finally:
            remove_folder(features.sparkSession, path)
    return counts.join(models, "symbol", "left").select(
        "symbol", "classes", "weights", F.coalesce("status", F.lit("no_data")).alias("status"), "n", "dropped"
    )


# -- scoring -----------------------------------------------------------------------------------


def state_probabilities(features: DataFrame, models: DataFrame) -> DataFrame:
    """(symbol, timestamp, from_state, to_state, prob) for every complete row and class."""
    fitted = models.filter(F.col("status") == "ok").select("symbol", "classes", "weights")
    rows = scoring_rows(features).join(fitted, "symbol")
    # Logarithms of the sigmoids, so that shares stay defined where all sigmoids underflow.
    rows = rows.withColumn("_z", F.transform("weights", _dot))
    rows = rows.withColumn("_l", F.transform("_z", lambda z: F.least(z, F.lit(0.0)) - F.log1p(F.exp(-F.abs(z)))))
    rows = rows.withColumn("_p", F.transform("_l", lambda v: F.exp(v - F.array_max("_l"))))
    total = F.aggregate("_p", F.lit(0.0), lambda a, b: a + b)
    later = 1.0 / (1.0 + F.exp(-F.element_at("_z", 1)))
    shares = F.when(F.size("classes") == 2, F.array(1.0 - later, later)).otherwise(F.transform("_p", lambda p: p / total))
    scored = rows.select("symbol", "timestamp", F.col("market_state").alias("from_state"),
                         F.explode(F.arrays_zip(F.col("classes").alias("to_state"), shares.alias("prob"))).alias("s"))
    return scored.select("symbol", "timestamp", "from_state", F.col("s.to_state").alias("to_state"), F.col("s.prob").alias("prob"))


def transition_probs(features: DataFrame, models: DataFrame) -> DataFrame:
    """The matrix of every fitted symbol as rows (symbol, from_state, to_state, prob).

    ``prob`` is the mean predicted probability over the rows in ``from_state``, 0.0 for a class that
    is never current. Current states outside the classes are left out, and so are symbols without
    a complete row.
    """
    means = state_probabilities(features, models).groupBy("symbol", "from_state", "to_state").agg(
        F.avg("prob").alias("prob")
    )
    # At most one entry per pair of the few states, so a row per symbol holds the whole matrix.
    lookup = means.groupBy("symbol").agg(
        F.map_from_entries(F.collect_list(F.struct(F.struct("from_state", "to_state"), "prob"))).alias("_means")
    )
    cells = (
        models.filter(F.col("status") == "ok").join(lookup, "symbol")
        .select("symbol", "classes", "_means", F.explode("classes").alias("from_state"))
        .select("symbol", "_means", "from_state", F.explode("classes").alias("to_state"))
    )
    cell = F.try_element_at("_means", F.struct("from_state", "to_state"))
    return cells.select("symbol", "from_state", "to_state", F.coalesce(cell, F.lit(0.0)).alias("prob"))


def matrix_view(probs: DataFrame) -> DataFrame:
    """(symbol, states, matrix): the long table as sorted states and an array of rows."""
    lines = probs.groupBy("symbol", "from_state").agg(
        F.array_sort(F.collect_list(F.struct("to_state", "prob"))).alias("line")
    )
    return lines.groupBy("symbol").agg(
        F.array_sort(F.collect_list(F.struct("from_state", "line"))).alias("m")
    ).select(
        "symbol",
        F.transform("m", lambda r: r["from_state"]).alias("states"),
        F.transform("m", lambda r: F.transform(r["line"], lambda c: c["prob"])).alias("matrix"),
    )
