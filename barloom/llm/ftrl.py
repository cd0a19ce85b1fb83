"""Follow-the-regularised-leader updates for sparse linear models."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Ftrl:
    """FTRL-proximal state of `shape` weights, with per-coordinate rates and elastic-net penalties.

    Each coordinate keeps z, the sum of its gradients less what its own steps have undone, and n,
    the sum of their squares; its weight is the closed-form minimiser, zero while |z| <= l1.
    """

    shape: tuple[int, ...]
    alpha: float = 0.1
    beta: float = 1.0
    l1: float = 0.0
    l2: float = 0.0
    z: np.ndarray = field(init=False)
    n: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.z, self.n = np.zeros(self.shape), np.zeros(self.shape)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        scale = (self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / scale)

    def update(self, at: np.ndarray | slice, gradient: np.ndarray, weights: np.ndarray) -> None:
        """One step on distinct coordinates `at`, whose weights were `weights`."""
        n = self.n[at]
        new = n + gradient * gradient
        self.z[at] += gradient - (np.sqrt(new) - np.sqrt(n)) / self.alpha * weights
        self.n[at] = new


def sigmoid(x: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)
