"""The classifier's arithmetic on one Arrow batch or one shard: dense layers, ReLU, softmax over two classes.

Kept small on purpose; Spark decides which rows come together and merges what comes out.
"""

from __future__ import annotations

import numpy as np


def parameter_count(dims: tuple[int, ...]) -> int:
    return sum((a + 1) * b for a, b in zip(dims, dims[1:]))


def initial_params(dims: tuple[int, ...], seed: int) -> np.ndarray:
    """Uniform within 1 / sqrt(inputs) of zero, layer by layer, weights then biases."""
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.uniform(-1, 1, (a + 1) * b) / np.sqrt(a) for a, b in zip(dims, dims[1:])])


def unflatten(params: np.ndarray, dims: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weights, biases) views per layer of the flat array."""
    layers, at = [], 0
    for a, b in zip(dims, dims[1:]):
        layers.append((params[at:at + a * b].reshape(a, b), params[at + a * b:at + (a + 1) * b]))
        at += (a + 1) * b
    return layers


def run_layers(layers, x: np.ndarray, keep: float = 1.0, rng=None):
    """Class probabilities, plus the input of every layer and the dropout masks for the backward pass."""
    inputs, masks = [x], []
    for weights, biases in layers[:-1]:
        mask = np.ones(1) if keep == 1.0 else (rng.random((len(x), len(biases))) < keep) / keep
        inputs.append(np.maximum(inputs[-1] @ weights + biases, 0.0) * mask)
        masks.append(mask)
    z = inputs[-1] @ layers[-1][0] + layers[-1][1]
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True), inputs, masks


def gradient(params, dims, x, y, w, keep=1.0, rng=None):
    """(weighted mean cross-entropy, probabilities, flat gradient) of one batch."""
    layers = unflatten(params, dims)
    probabilities, inputs, masks = run_layers(layers, x, keep, rng)
    rows, share = np.arange(len(y)), w / w.sum()
    loss = -(share * np.log(np.maximum(probabilities[rows, y], 1e-15))).sum()
    delta = probabilities.copy()
    delta[rows, y] -= 1.0
    delta *= share[:, None]
    pieces = []
    for i in range(len(layers) - 1, -1, -1):
        pieces[:0] = [(inputs[i].T @ delta).ravel(), delta.sum(axis=0)]
        if i:
            delta = (delta @ layers[i][0].T) * (inputs[i] > 0) * masks[i - 1]
    return loss, probabilities, np.concatenate(pieces)


STEPS_DRAWN = 4


class Steps:
    """`gradient` for batches of one size of several models side by side, in arrays that all steps share: the same sums in the
    same order as for each model alone.

    `weights` and `slopes` are views per layer of the flat parameters and of the flat gradients, one row of each per model.
    """

    def __init__(self, params, slope, dims, size, keep):
        models, widths = len(params), dims[1:-1]
        self.keep, self.dims, self.size, self.widths = keep, dims, size, widths
        self.weights, self.slopes = stacked(params, dims), stacked(slope, dims)
        self.hidden = [np.empty((models, size, width)) for width in widths]
        self.deltas = [np.empty((models, size, width)) for width in widths]
        self.active = [np.empty((models, size, width), dtype=bool) for width in widths]
        self.z, self.top = np.empty((models, size, dims[-1])), np.empty((models, size, 1))
        self.at = np.arange(models)[:, None], np.arange(size)
        ends = np.cumsum([size * width for width in widths], dtype=int)
        self.drawn = np.empty((models, STEPS_DRAWN, size * sum(widths)))
        self.kept = np.empty(self.drawn.shape[1:], dtype=bool)
        self.views = [
            [self.drawn[:, k, end - size * width:end].reshape(models, size, width) for width, end in zip(widths, ends)] for k in range(STEPS_DRAWN)]
        self.of = {}

    def draw(self, model, steps, rng):
        """The dropout masks of some steps of a model: drawn at once, in the order in which `run_layers` draws them."""
        if self.keep < 1.0:
            drawn = rng.random(out=self.drawn[model, :steps])
            np.multiply(np.less(drawn, self.keep, out=self.kept[:steps]), 1.0 / self.keep, out=drawn)

    def first(self, models):
        """Views of everything for the first so many models."""
        if models not in self.of:
            masks = [[None if self.keep == 1.0 else view[:models] for view in views] for views in self.views]
            self.of[models] = (
                [(w[:models], w[:models].transpose(0, 2, 1), b[:models], ws[:models], bs[:models]) for (w, b), (ws, bs) in zip(self.weights, self.slopes)],
                [a[:models] for a in self.hidden], [a[:models] for a in self.deltas], [a[:models] for a in self.active],
                self.z[:models], self.top[:models], (self.at[0][:models], self.at[1]), masks)
        return self.of[models]

    def __call__(self, models, drawn, x, y, share, probabilities):
        """Leave the gradients of one batch of each of the first `models` in `slopes` and what the networks say of it in
        `probabilities`; `drawn` is the place of the step among those that masks were drawn for."""
        sides, hidden, deltas, active, z, top, (model, row), masks = self.first(models)
        masks, inputs = masks[drawn], [x]
        for (weights, _, biases, _, _), mask, out in zip(sides, masks, hidden):
            np.matmul(inputs[-1], weights, out=out)
            out += biases
            np.maximum(out, 0.0, out=out)
            if mask is not None:
                out *= mask
            inputs.append(out)
        np.matmul(inputs[-1], sides[-1][0], out=z)
        z += sides[-1][2]
        over_classes(np.maximum, z, top)
        z -= top
        np.exp(z, out=z)
        over_classes(np.add, z, top)
        delta = np.divide(z, top, out=z)
        probabilities[:] = delta
        delta[model, row, y] -= 1.0
        delta *= share
        for i in range(len(sides) - 1, -1, -1):
            _, turned, _, slope, bias = sides[i]
            np.matmul(inputs[i].transpose(0, 2, 1), delta, out=slope)
            np.add.reduce(delta, axis=1, keepdims=True, out=bias)
            if i:
                delta = np.matmul(delta, turned, out=deltas[i - 1])
                delta *= np.greater(inputs[i], 0, out=active[i - 1])
                if masks[i - 1] is not None:
                    delta *= masks[i - 1]


def over_classes(ufunc, z, out):
    """`ufunc.reduce` over the last axis, column by column: there are few classes."""
    np.copyto(out, z[..., :1])
    for k in range(1, z.shape[-1]):
        ufunc(out, z[..., k:k + 1], out=out)


def stacked(params, dims):
    """`unflatten` of several models, one in each row: (weights, biases) views per layer, biases as rows."""
    layers, at, models = [], 0, len(params)
    for a, b in zip(dims, dims[1:]):
        layers.append((params[:, at:at + a * b].reshape(models, a, b), params[:, at + a * b:at + (a + 1) * b].reshape(models, 1, b)))
        at += (a + 1) * b
    return layers


def train(params, dims, x, y, w, epochs, batch_size, learning_rate, dropout, rng, held_out=None):
    """Mini-batch Adam. Returns the new parameters and (loss, accuracy, held-out loss, held-out accuracy) of every
    epoch; `held_out` are features and labels measured after each epoch (none: the last two are None)."""
    return train_each(params, dims, [(x, y, w, rng, held_out)], epochs, batch_size, learning_rate, dropout)[0]


def train_each(params, dims, shards, epochs, batch_size, learning_rate, dropout):
    """`train` from the same parameters on every one of `shards` (x, y, w, rng, held_out), side by side: a step of all costs
    much less than a step of each, and leaves the same figures. Returns what `train` does for each, in their order."""
    places = sorted(range(len(shards)), key=lambda i: -len(shards[i][1]))  # so that those with steps left come first
    shards = [shards[i] for i in places]
    rows = [len(s[1]) for s in shards]
    models, most, outs, size = len(shards), max(rows), dims[-1], batch_size
    flat = np.tile(np.asarray(params, dtype=float), (models, 1))
    first, second, slope, part, root = np.zeros_like(flat), np.zeros_like(flat), np.empty_like(flat), np.empty_like(flat), np.empty_like(flat)
    whole = [n // size for n in rows]
    # The full batches of an epoch side by side, then the rest of it as a batch of each shard's own size.
    steps = Steps(flat, slope, dims, size, 1.0 - dropout)
    rests = [Steps(flat[i:i + 1], slope[i:i + 1], dims, n % size, 1.0 - dropout) if n % size else None for i, n in enumerate(rows)]
    each = [full + (rest is not None) for full, rest in zip(whole, rests)]
    powers = range(1, epochs * max(each) + 1)
    rates, sizes = np.array([learning_rate / (1 - 0.9**t) for t in powers]), np.array([1 - 0.999**t for t in powers])
    xs, ys = np.empty((models, most, dims[0])), np.zeros((models, most), dtype=np.int64)
    shares, p = np.empty((models, most, 1)), np.empty((models, most, outs))
    histories = [[] for _ in shards]

    def adam(some, taken):
        """Move `some` models by their slopes; `taken` are the steps that each has made with this one."""
        g, a, b, c, d = slope[some], first[some], second[some], part[some], root[some]
        np.subtract(g, a, out=c)
        np.multiply(c, 0.1, out=c)
        np.add(a, c, out=a)
        np.multiply(g, g, out=c)
        np.subtract(c, b, out=c)
        np.multiply(c, 0.001, out=c)
        np.add(b, c, out=b)
        np.divide(b, sizes[taken - 1], out=d)
        np.sqrt(d, out=d)
        np.add(d, 1e-8, out=d)
        np.multiply(a, rates[taken - 1], out=c)
        np.divide(c, d, out=c)
        np.subtract(flat[some], c, out=flat[some])

    for epoch in range(epochs):
        for i, (x, y, w, rng, _) in enumerate(shards):
            n, full = rows[i], whole[i] * size
            order = rng.permutation(n)
            np.take(x, order, axis=0, out=xs[i, :n])
            ys[i, :n], weights = y[order], w[order]
            for a, b in ((0, full), (full, n)):
                if b > a:
                    batches = weights[a:b].reshape(-1, min(b - a, size))
                    shares[i, a:b, 0] = (batches / batches.sum(axis=1, keepdims=True)).ravel()
        before = np.array([[epoch * n] for n in each])
        running = models
        for k in range(whole[0]):
            while whole[running - 1] <= k:
                running -= 1
            if k % STEPS_DRAWN == 0:
                for i in range(running):
                    steps.draw(i, min(STEPS_DRAWN, whole[i] - k), shards[i][3])
            at, to = k * size, (k + 1) * size
            steps(running, k % STEPS_DRAWN, xs[:running, at:to], ys[:running, at:to], shares[:running, at:to], p[:running, at:to])
            adam(slice(running), before[:running] + (k + 1))
        for i, rest in enumerate(rests):
            if rest is not None:
                one, at, to = slice(i, i + 1), whole[i] * size, rows[i]
                rest.draw(0, 1, shards[i][3])
                rest(1, 0, xs[one, at:to], ys[one, at:to], shares[one, at:to], p[one, at:to])
                adam(one, np.array([[(epoch + 1) * each[i]]]))
        for i, (_, _, _, _, held_out) in enumerate(shards):
            n, full, losses = rows[i], whole[i] * size, []
            right = int((p[i, :n].argmax(axis=1) == ys[i, :n]).sum())
            for a, b in ((0, full), (full, n)):
                if b > a:
                    said = np.maximum(p[i, np.arange(a, b), ys[i, a:b]], 1e-15)
                    losses.extend(-(shares[i, a:b, 0] * np.log(said)).reshape(-1, min(b - a, size)).sum(axis=1))
            after = (None, None)
            if held_out is not None and len(held_out[1]):
                sure, truth = positive_probability(flat[i], dims, held_out[0]), held_out[1]
                cost = -np.log(np.maximum(np.where(truth == 1, sure, 1 - sure), 1e-15)).mean()
                after = (float(cost), float(((sure > 0.5) == (truth == 1)).mean()))
            histories[i].append((float(np.mean(losses)), right / n, *after))
    found = [None] * models
    for i, place in enumerate(places):
        found[place] = (flat[i].copy(), histories[i])
    return found


def positive_probability(params, dims, x) -> np.ndarray:
    return run_layers(unflatten(np.asarray(params, dtype=float), dims), x)[0][:, 1]


ROWS_AT_ONCE = 1_024


def sigmoid_sums(params, dims, x, y, share):
    """Sums over rows of the cross-entropy and its gradient, each row times its `share`, for sigmoid layers under a softmax."""
    layers, slope, loss = unflatten(params, dims), np.zeros(len(params)), 0.0
    slopes = unflatten(slope, dims)
    for at in range(0, len(y), ROWS_AT_ONCE):
        rows, inputs = slice(at, at + ROWS_AT_ONCE), [x[at:at + ROWS_AT_ONCE]]
        for weights, biases in layers[:-1]:
            out = inputs[-1] @ weights
            out += biases
            np.negative(out, out=out)
            with np.errstate(over="ignore"):  # 1 / inf is the 0 that it should be
                np.exp(out, out=out)
            out += 1.0
            inputs.append(np.divide(1.0, out, out=out))
        z = inputs[-1] @ layers[-1][0]
        z += layers[-1][1]
        z -= z.max(axis=1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(axis=1, keepdims=True)
        truth = np.arange(len(z)), y[rows]
        with np.errstate(divide="ignore"):
            loss -= float(share[rows] @ np.log(z[truth]))
        z[truth] -= 1.0
        z *= share[rows, None]
        delta = z
        for i in range(len(layers) - 1, -1, -1):
            slopes[i][0][...] += inputs[i].T @ delta
            slopes[i][1][...] += delta.sum(axis=0)
            if i:
                delta = delta @ layers[i][0].T
                delta *= inputs[i]
                delta *= np.subtract(1.0, inputs[i], out=inputs[i])
    return loss, slope
