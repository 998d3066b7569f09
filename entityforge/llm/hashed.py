"""Hashed word and character n-grams, logistic regression on them, and probability calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from entityforge.llm.textstats import WordNumbers, words_of

#: Slots of each of the four families: words, word pairs, 3 and 4 characters (code points).
SLOTS = 1 << 14
WIDTH = 4 * SLOTS
#: A family of n n-grams counts n / (n + PULL): a few n-grams say little about a text.
PULL = 40
#: Code points whose n-grams are hashed at once; a longer text is read in overlapping parts, and whole.
PART = 1 << 18
_SHIFT = np.uint32(32 - 14)
_MIX = np.uint32(2654435761)
_P = np.uint32(0x9E3779B1)


def _grams(code: np.ndarray, n: int) -> np.ndarray:
    """Slots of all n-grams of 32-bit numbers, by a polynomial of them."""
    m = max(len(code) - n + 1, 0)
    h = code[:m] + np.uint32(n)
    for i in range(1, n):
        h = h * _P + code[i : i + m]
    return ((h ^ (h >> np.uint32(15))) * _MIX) >> _SHIFT


def slots_of(text: str, word_hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(family, slots) of all n-grams of a whole text; a family of a long text comes in parts."""
    for n in (1, 2):
        yield n - 1, _grams(word_hashes, n)
    for at in range(0, max(len(text), 1), PART):
        points = np.frombuffer(text[at : at + PART + 3].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        for n in (3, 4):
            # n-grams that start in this part
            yield n - 1, _grams(points[: PART + n - 1], n)


def feature_vector(text: str, word_hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slots, values): each family's shares sum to n / (n + PULL)."""
    count = np.zeros((4, SLOTS), dtype=np.int64)
    for family, slots in slots_of(text, word_hashes):
        count[family] += np.bincount(slots, minlength=SLOTS)
    value = (count / (count.sum(axis=1, keepdims=True) + PULL)).ravel()
    at = np.flatnonzero(value)
    return at, value[at]


@dataclass
class Linear:
    """A linear scorer with its calibration: P = sigmoid(a * (bias + weights · x) + b).

    `agreement`: the share of the rows that the fit held out on whose side of one half P falls.
    """

    weights: np.ndarray
    bias: float
    a: float = 1.0
    b: float = 0.0
    agreement: float = float("nan")

    def margin(self, text: str, word_hashes: np.ndarray) -> float:
        """The uncalibrated margin of a whole text."""
        said, n = [0.0] * 4, [0] * 4
        for family, slots in slots_of(text, word_hashes):
            said[family] += float(self.weights[family * SLOTS : (family + 1) * SLOTS][slots].sum(dtype=np.float64))
            n[family] += len(slots)
        return self.bias + sum(s / (k + PULL) for s, k in zip(said, n))

    def probability(self, margin: np.ndarray) -> np.ndarray:
        """Calibrated probability of the positive class."""
        return sigmoid(self.a * np.asarray(margin) + self.b)


def sigmoid(x: np.ndarray) -> np.ndarray:
    """Logistic function without overflow."""
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, dtype=float)))


class Rows:
    """Sparse rows of features."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        self.n = len(rows)
        self.at = np.concatenate([a for a, _ in rows]) if rows else np.zeros(0, np.int64)
        self.value = np.concatenate([v for _, v in rows]) if rows else np.zeros(0)
        self.row = np.repeat(np.arange(self.n), [len(a) for a, _ in rows])

    def dot(self, w: np.ndarray) -> np.ndarray:
        """Row sums of w times the features."""
        return np.bincount(self.row, self.value * w[self.at], minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        """Feature sums of g times the rows."""
        return np.bincount(self.at, self.value * g[self.row], minlength=WIDTH)


def fit_logistic(rows: Rows, target: np.ndarray, weight: np.ndarray, l2: float = 2e-5, steps: int = 60) -> Linear:
    """Logistic regression to soft targets in [0, 1] by L-BFGS."""
    scale = 1.0 / max(weight.sum(), 1e-12)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        z = rows.dot(x[:-1]) + x[-1]
        err = (sigmoid(z) - target) * weight * scale
        value = float((np.logaddexp(0, z) - target * z) @ weight) * scale + 0.5 * l2 * float(x[:-1] @ x[:-1])
        return value, np.append(rows.back(err) + l2 * x[:-1], err.sum())

    x = np.zeros(WIDTH + 1)
    value, grad = loss(x)
    memory: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        q, alphas = grad.copy(), []
        for s, y, rho in reversed(memory):
            alphas.append(rho * float(s @ q))
            q -= alphas[-1] * y
        if memory:
            s, y, rho = memory[-1]
            q *= 1.0 / (rho * float(y @ y))
        else:
            q *= 100.0
        for (s, y, rho), alpha in zip(memory, reversed(alphas)):
            q += (alpha - rho * float(y @ q)) * s
        step, slope = 1.0, -float(grad @ q)
        if slope >= 0:
            break
        for _ in range(20):
            new = x - step * q
            new_value, new_grad = loss(new)
            if new_value <= value + 1e-4 * step * slope:
                break
            step *= 0.5
        else:
            break
        s, y = new - x, new_grad - grad
        if float(s @ y) > 1e-12:
            memory = [*memory[-7:], (s, y, 1.0 / float(s @ y))]
        done = value - new_value < 1e-6
        x, value, grad = new, new_value, new_grad
        if done:
            break
    return Linear(x[:-1].astype(np.float32), float(x[-1]))


def calibrate(margin: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P = sigmoid(a * margin + b) by Newton steps with a weak pull to a = 1, b = 0."""
    ab = np.array([1.0, 0.0])
    design = np.stack([margin, np.ones_like(margin)], axis=1)
    for _ in range(30):
        p = sigmoid(design @ ab)
        grad = design.T @ (p - target) + 0.1 * (ab - [1.0, 0.0])
        hess = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        ab = ab - np.linalg.solve(hess, grad)
    return float(max(ab[0], 1e-3)), float(ab[1])


def fit_calibrated(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, held: np.ndarray, prior: float) -> Linear:
    """Fits on the rows not `held`, both classes weighing alike, and calibrates on the held ones.

    `prior` is the share of the positive class in the corpus; rows are drawn by class, so the
    calibrated odds are corrected for the share that they have in the sample.
    """
    target = np.asarray(target, dtype=float)
    if not len(rows) or target.min() == target.max():
        # one class or none: nothing speaks against any text
        return Linear(np.zeros(WIDTH, np.float32), 4.0)
    train = ~held if target[~held].size and target[~held].min() < target[~held].max() else np.ones_like(held)
    share = float(target[train].mean())
    weight = np.where(target[train] > 0.5, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))
    model = fit_logistic(Rows([r for r, t in zip(rows, train) if t]), target[train], weight)
    check = held if held.any() else train
    kept = Rows([r for r, t in zip(rows, check) if t])
    margin = kept.dot(model.weights.astype(float)) + model.bias
    model.a, model.b = calibrate(margin, target[check])
    model.agreement = float(((model.probability(margin) >= 0.5) == (target[check] >= 0.5)).mean())
    drawn, true = np.clip([float(target[check].mean()), prior], 1e-3, 1 - 1e-3)
    model.b += float(np.log(true / (1 - true)) - np.log(drawn / (1 - drawn)))
    return model


def hashes_of(text: str, numbers: WordNumbers) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, hashes) of the words of a text."""
    at = numbers.of(words_of(text))
    return at, numbers.hashes(at)
