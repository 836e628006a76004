"""A linear-chain conditional random field with binary features."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

Rows = list[list[str]]  # the features of each position of a chain


@dataclass
class Crf:
    """Weights: one row of label scores per feature, label-pair scores per link
    kind, and label scores of a chain's first position."""
    names: dict[str, int]
    unary: np.ndarray
    links: dict[str, int]
    pairs: np.ndarray
    first: np.ndarray = field(default_factory=lambda: np.zeros(2))

    def scores(self, rows: Rows) -> np.ndarray:
        names, unary = self.names, self.unary
        return np.array([unary[[names[f] for f in fs if f in names]].sum(0) for fs in rows]).reshape(len(rows), -1)

    def decode(self, rows: Rows, kinds: list[str]) -> list[int]:
        """The best label sequence (Viterbi); kinds[i] links positions i and i + 1."""
        if not rows:
            return []
        scores = self.scores(rows)
        best, back = scores[0] + self.first, []
        for i in range(1, len(rows)):
            step = best[:, None] + self.pairs[self.links.get(kinds[i - 1], 0)]
            back.append(step.argmax(0))
            best = step.max(0) + scores[i]
        at = int(best.argmax())
        labels = [at]
        for choice in reversed(back):
            at = int(choice[at])
            labels.append(at)
        return labels[::-1]


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def fit(chains: list[tuple[Rows, list[str], list[int]]], labels: int = 2, rounds: int = 60, l2: float = 0.5,
        min_count: int = 2, step_size: float = 0.5) -> Crf:
    """Fit by gradient ascent on the penalised log-likelihood (Adagrad, full
    batches; forward-backward for the expectations).

    ``chains``: (features of each position, link kinds, labels).  Features seen
    fewer than ``min_count`` times are left out.
    """
    counts: dict[str, int] = {}
    for rows, _, _ in chains:
        for fs in rows:
            for f in fs:
                counts[f] = counts.get(f, 0) + 1
    names = {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n >= min_count))}
    links = {k: i for i, k in enumerate(sorted({k for _, kinds, _ in chains for k in kinds} | {""}))}
    chains = [c for c in chains if c[0]]
    model = Crf(names, np.zeros((len(names), labels)), links, np.zeros((len(links), labels, labels)), np.zeros(labels))
    if not chains:
        return model
    # All chains side by side, padded to the longest; ``live`` marks positions.
    count, longest = len(chains), max(len(c[0]) for c in chains)
    live = np.zeros((count, longest), bool)
    truth, kinds = np.zeros((count, longest), int), np.zeros((count, longest), int)
    ids, owner = [], []
    for c, (rows, ks, ys) in enumerate(chains):
        live[c, :len(rows)] = True
        truth[c, :len(rows)], kinds[c, 1:len(rows)] = ys, [links[k] for k in ks]
        for i, fs in enumerate(rows):
            known = [names[f] for f in fs if f in names]
            ids += known
            owner += [c * longest + i] * len(known)
    ids, owner = np.array(ids, int), np.array(owner, int)
    observed = np.eye(labels)[truth] * live[:, :, None]
    both = observed[:, :-1, :, None] * observed[:, 1:, None, :]
    params = [model.unary, model.pairs, model.first]
    squares = [np.full_like(p, 1e-6) for p in params]
    for _ in range(rounds):
        scores = np.zeros((count * longest, labels))
        np.add.at(scores, owner, model.unary[ids])
        scores = scores.reshape(count, longest, labels)
        pair = model.pairs[kinds]
        forward, backward = np.zeros_like(scores), np.zeros_like(scores)
        forward[:, 0] = scores[:, 0] + model.first
        for t in range(1, longest):
            step = scores[:, t] + _logsum(forward[:, t - 1, :, None] + pair[:, t], 1)
            forward[:, t] = np.where(live[:, t, None], step, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = _logsum(pair[:, t + 1] + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(live[:, t + 1, None], step, 0.0)
        total = _logsum(forward[:, -1], 1)[:, None, None]
        node = observed - np.exp(forward + backward - total) * live[:, :, None]
        edge = np.exp(forward[:, :-1, :, None] + pair[:, 1:] + (scores[:, 1:] + backward[:, 1:])[:, :, None, :] - total[..., None])
        edge = both - edge * live[:, 1:, None, None]
        grads = [-l2 * p for p in params]
        np.add.at(grads[0], ids, node.reshape(-1, labels)[owner])
        np.add.at(grads[1], kinds[:, 1:], edge)
        grads[2] += node[:, 0].sum(0)
        for p, g, s in zip(params, grads, squares):
            s += g * g
            p += step_size * g / np.sqrt(s)
    return model
