"""Non-negative positive-unlabelled learning in numpy (Kiryo et al., 2017).

The risk of a classifier g with class prior p is
    p * R+(positives) + max(0, R-(unlabelled) - p * R-(positives)),
with the logistic loss, so sigmoid(g) estimates the probability of the positive
class. Where the bracket of a mini-batch is negative, the step goes up that
bracket's gradient instead, as the paper has it.
"""

from __future__ import annotations

import numpy as np


def class_prior(n_rows: int, n_labelled: int, n_positive: int) -> float:
    """Share of positives among the rows that aren't confirmed positives.

    The rate among labelled rows is taken to hold for the others; of the labelled
    rows only the negatives stay among the unlabelled ones.
    """
    if not n_labelled or n_rows <= n_positive:
        return 0.0
    return min(0.99, max(0.0, (n_rows - n_labelled) * (n_positive / n_labelled) / (n_rows - n_positive)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Net:
    """A perceptron with one hidden layer; hidden = 0 gives a linear model."""

    def __init__(self, n: int, hidden: int, seed: int):
        r = np.random.Generator(np.random.PCG64(seed))
        self.hidden = hidden
        if hidden:
            self.p = [r.normal(0, (2 / n) ** 0.5, (n, hidden)), np.zeros(hidden), r.normal(0, (1 / hidden) ** 0.5, hidden), np.zeros(1)]
        else:
            self.p = [np.zeros(n), np.zeros(1)]

    def forward(self, x: np.ndarray) -> np.ndarray:
        if not self.hidden:
            return x @ self.p[0] + self.p[1][0]
        return np.maximum(x @ self.p[0] + self.p[1], 0) @ self.p[2] + self.p[3][0]

    def gradient(self, x: np.ndarray, d: np.ndarray) -> list[np.ndarray]:
        """Gradient of sum(d * g(x))."""
        if not self.hidden:
            return [x.T @ d, np.array([d.sum()])]
        a = np.maximum(x @ self.p[0] + self.p[1], 0)
        back = np.outer(d, self.p[2]) * (a > 0)
        return [x.T @ back, back.sum(0), a.T @ d, np.array([d.sum()])]


def train(pos: np.ndarray, unl: np.ndarray, prior: float, hidden: int = 0, epochs: int = 60, rate: float = 0.02, decay: float = 1e-4, batch: int = 512, seed: int = 7) -> Net:
    """Minimise the non-negative risk by Adam over shuffled mini-batches."""
    net = Net(pos.shape[1], hidden, seed)
    r = np.random.Generator(np.random.PCG64(seed + 1))
    m, v, t = [np.zeros_like(x) for x in net.p], [np.zeros_like(x) for x in net.p], 0
    steps = max(1, -(-len(unl) // batch))
    for epoch in range(epochs):
        for part_u, part_p in zip(np.array_split(r.permutation(len(unl)), steps), np.array_split(r.permutation(max(len(pos), steps)) % len(pos), steps), strict=True):
            xp, xu = pos[part_p], unl[part_u]
            gp, gu = sigmoid(net.forward(xp)), sigmoid(net.forward(xu))
            inner = -np.log1p(-np.minimum(gu, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(gp, 1 - 1e-12)).mean()
            # d loss+/dg = -(1 - s); d loss-/dg = s
            if inner >= 0:
                grads = [a + b for a, b in zip(net.gradient(xp, prior * (-(1 - gp) - gp) / len(xp)), net.gradient(xu, gu / len(xu)), strict=True)]
            else:
                grads = [a + b for a, b in zip(net.gradient(xp, prior * gp / len(xp)), net.gradient(xu, -gu / len(xu)), strict=True)]
            t += 1
            now = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for i, g in enumerate(grads):
                g = g + decay * net.p[i]
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                net.p[i] = net.p[i] - now * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return net
