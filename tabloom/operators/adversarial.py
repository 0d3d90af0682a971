"""One local training pass of a small adversarial pair, run inside a Spark task.

A model state is one flat vector: generator and discriminator weights, then the
two moment vectors of the optimizer. Flat vectors make averaging over shards a
plain weighted mean.
"""

from __future__ import annotations

import numpy as np

BETA1, BETA2, TINY = 0.5, 0.999, 1e-8


def shapes(latent: int, hidden: int, width: int) -> list[tuple[int, ...]]:
    """Generator latent-hidden-width, then discriminator width-hidden-1: weights and biases."""
    return [(latent, hidden), (hidden,), (hidden, width), (width,), (width, hidden), (hidden,), (hidden, 1), (1,)]


def views(flat: np.ndarray, layout: list[tuple[int, ...]]) -> list[np.ndarray]:
    sizes = np.cumsum([0] + [int(np.prod(s)) for s in layout])
    return [flat[a:b].reshape(s) for a, b, s in zip(sizes, sizes[1:], layout)]


def weight_count(layout: list[tuple[int, ...]]) -> int:
    return sum(int(np.prod(s)) for s in layout)


def initial_state(layout: list[tuple[int, ...]], rng: np.random.Generator) -> np.ndarray:
    """Uniform weights within 1/sqrt(inputs of the layer), zero moments."""
    size = weight_count(layout)
    state = np.zeros(3 * size)
    for i, part in enumerate(views(state[:size], layout)):
        bound = 1 / np.sqrt(layout[i - i % 2][0])
        part[...] = rng.uniform(-bound, bound, part.shape)
    return state


def generate(weights: list[np.ndarray], noise: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = noise @ weights[0]
    hidden += weights[1]
    np.maximum(hidden, 0, out=hidden)
    made = hidden @ weights[2]
    made += weights[3]
    return hidden, np.tanh(made, out=made)


def _judge(weights: list[np.ndarray], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = rows @ weights[4]
    hidden += weights[5]
    np.maximum(hidden, 0, out=hidden)
    return hidden, hidden @ weights[6] + weights[7]


def _hidden_gradient(weights, hidden, d_logit):
    d_hidden = d_logit * weights[6].T
    d_hidden *= hidden > 0
    return d_hidden


def _judge_gradients(weights, rows, hidden, d_logit):
    d_hidden = _hidden_gradient(weights, hidden, d_logit)
    return d_hidden, [rows.T @ d_hidden, d_hidden.sum(0), hidden.T @ d_logit, d_logit.sum(0)]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _softplus(x):
    return np.logaddexp(0, x)


def train_shard(
    state: np.ndarray,
    steps: int,
    data: np.ndarray,
    layout: list[tuple[int, ...]],
    epochs: int,
    batch_size: int,
    learning_rate: float,
    rng: np.random.Generator,
    batches: int | None = None,
) -> tuple[np.ndarray, int, np.ndarray]:
    """Returns the new state, the optimizer steps done so far and (generator, discriminator) loss per epoch.

    Every batch makes one discriminator step and one generator step on fresh
    noise; a last partial batch is left for the next shuffle. An epoch has ``batches`` batches; rows are shuffled
    anew whenever they run out. Batches shrink to the shard where it is smaller than a batch.
    """
    size = weight_count(layout)
    flat = state.astype(np.float32)
    w, m, v = flat[:size], flat[size : 2 * size], flat[2 * size :]
    weights = views(w, layout)
    split = weight_count(layout[:4])
    latent = layout[0][0]
    batch = min(batch_size, len(data))

    def adam(part: slice, gradients: list[np.ndarray]) -> None:
        g = np.concatenate([x.ravel() for x in gradients])
        m[part] += (1 - BETA1) * (g - m[part])
        v[part] += (1 - BETA2) * (g * g - v[part])
        rate = learning_rate / (1 - BETA1**steps)
        w[part] -= rate * m[part] / (np.sqrt(v[part] / (1 - BETA2**steps)) + TINY)

    losses = np.zeros((epochs, 2))
    full = len(data) // batch
    batches = batches or full
    truth = np.concatenate([np.ones((batch, 1)), np.zeros((batch, 1))]).astype(np.float32)
    for epoch in range(epochs):
        order = rng.permutation(len(data))
        for done in range(batches):
            b = done % full
            if done and not b:
                order = rng.permutation(len(data))
            steps += 1
            noise = rng.standard_normal((batch, latent), dtype=np.float32)
            rows = np.concatenate([data[order[b * batch : (b + 1) * batch]], generate(weights, noise)[1]])
            hidden, logit = _judge(weights, rows)
            losses[epoch, 1] += _softplus(np.where(truth > 0, -logit, logit)).sum() / batch
            adam(slice(split, size), _judge_gradients(weights, rows, hidden, (_sigmoid(logit) - truth) / batch)[1])

            noise = rng.standard_normal((batch, latent), dtype=np.float32)
            inner, made = generate(weights, noise)
            hidden, logit = _judge(weights, made)
            losses[epoch, 0] += _softplus(-logit).sum() / batch
            d_hidden = _hidden_gradient(weights, hidden, (_sigmoid(logit) - 1) / batch)
            d_out = (d_hidden @ weights[4].T) * (1 - made * made)
            d_inner = (d_out @ weights[2].T) * (inner > 0)
            adam(slice(0, split), [noise.T @ d_inner, d_inner.sum(0), inner.T @ d_out, d_out.sum(0)])
    return flat.astype(np.float64), steps, losses / max(1, batches)
