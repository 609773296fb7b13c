"""A bidirectional gated recurrent network with attention pooling, in numpy.

Works on windows of word vectors: ``index`` (windows, steps) points into a table of vectors,
windows are sorted by length, longest first, so that step t concerns a leading part of them.
"""

from __future__ import annotations

import numpy as np

Parameters = dict[str, np.ndarray]


def new_parameters(inputs: int, hidden: int, attention: int, rng: np.random.Generator) -> Parameters:
    def matrix(rows, columns):
        return (rng.standard_normal((rows, columns)) / np.sqrt(rows)).astype(np.float32)

    p: Parameters = {}
    for side in "fb":
        p[f"{side}W"] = matrix(inputs, 3 * hidden)
        p[f"{side}U"] = matrix(hidden, 3 * hidden)
        p[f"{side}c"] = np.zeros(3 * hidden, dtype=np.float32)
    p["aW"], p["ac"] = matrix(2 * hidden, attention), np.zeros(attention, dtype=np.float32)
    p["av"] = matrix(attention, 1)[:, 0]
    p["ow"], p["oc"] = matrix(2 * hidden, 1)[:, 0], np.zeros(1, dtype=np.float32)
    return p


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def _active(lengths: np.ndarray, steps: int) -> np.ndarray:
    """How many windows reach each step."""
    return np.searchsorted(-lengths, -np.arange(1, steps + 1), side="right")


def _run(p: Parameters, side: str, ahead: np.ndarray, index: np.ndarray, active: np.ndarray, keep: list | None):
    """States (steps, windows, hidden) of one direction; ``ahead`` is the table times W plus c."""
    n, steps = index.shape
    hidden = p[f"{side}U"].shape[0]
    states = np.zeros((steps, n, hidden), dtype=np.float32)
    h = np.zeros((n, hidden), dtype=np.float32)
    u = p[f"{side}U"]
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        k = active[t]
        if not k:
            continue
        before = h[:k]
        x, inner = ahead[index[:k, t]], before @ u
        gates = _sigmoid(x[:, : 2 * hidden] + inner[:, : 2 * hidden])
        update, reset, q = gates[:, :hidden], gates[:, hidden:], inner[:, 2 * hidden :]
        fresh = np.tanh(x[:, 2 * hidden :] + reset * q)
        now = fresh + update * (before - fresh)
        if keep is not None:
            keep.append((t, k, before.copy(), update, reset, q, fresh))
        h[:k] = now
        states[t, :k] = now
    return states


def forward(p: Parameters, table: np.ndarray, index: np.ndarray, lengths: np.ndarray, tape: dict | None = None):
    """The logit of every window."""
    steps = index.shape[1]
    active = _active(lengths, steps)
    kept = {"f": [], "b": []} if tape is not None else {"f": None, "b": None}
    both = [_run(p, s, table @ p[f"{s}W"] + p[f"{s}c"], index, active, kept[s]) for s in "fb"]
    states = np.concatenate(both, axis=2)
    u = np.tanh(states @ p["aW"] + p["ac"])
    energy = u @ p["av"]
    energy[np.arange(steps)[:, None] >= lengths[None, :]] = -np.inf
    weight = np.exp(energy - energy.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = np.einsum("tn,tnh->nh", weight, states)
    if tape is not None:
        tape.update(kept=kept, states=states, u=u, weight=weight, pooled=pooled)
    return pooled @ p["ow"] + p["oc"][0]


def backward(p: Parameters, table: np.ndarray, index: np.ndarray, tape: dict, d_logit: np.ndarray):
    """Gradients of all parameters and of the table."""
    g = {name: np.zeros_like(v) for name, v in p.items()}
    d_table = np.zeros_like(table)
    states, u, weight = tape["states"], tape["u"], tape["weight"]
    g["ow"], g["oc"][0] = tape["pooled"].T @ d_logit, d_logit.sum()
    d_pooled = d_logit[:, None] * p["ow"]
    d_weight = np.einsum("tnh,nh->tn", states, d_pooled)
    d_energy = weight * (d_weight - (weight * d_weight).sum(axis=0))
    g["av"] = np.einsum("tn,tna->a", d_energy, u)
    d_pre = d_energy[:, :, None] * p["av"] * (1 - u * u)
    g["aW"] = np.einsum("tnh,tna->ha", states, d_pre)
    g["ac"] = d_pre.sum(axis=(0, 1))
    d_states = weight[:, :, None] * d_pooled + d_pre @ p["aW"].T
    hidden = states.shape[2] // 2
    for side, part in (("f", slice(0, hidden)), ("b", slice(hidden, None))):
        w, u_ = p[f"{side}W"], p[f"{side}U"]
        d_h = np.zeros((index.shape[0], hidden), dtype=np.float32)
        for t, k, before, update, reset, q, fresh in reversed(tape["kept"][side]):
            d = d_h[:k] + d_states[t, :k, part]
            d_fresh = d * (1 - update) * (1 - fresh * fresh)
            d_update = d * (before - fresh) * update * (1 - update)
            d_reset = d_fresh * q * reset * (1 - reset)
            inner = np.concatenate([d_update, d_reset, d_fresh * reset], axis=1)
            outer = np.concatenate([d_update, d_reset, d_fresh], axis=1)
            d_h[:k] = d * update + inner @ u_.T
            rows = index[:k, t]
            g[f"{side}U"] += before.T @ inner
            g[f"{side}W"] += table[rows].T @ outer
            g[f"{side}c"] += outer.sum(axis=0)
            np.add.at(d_table, rows, outer @ w.T)
    return g, d_table


class Adam:
    def __init__(self, parameters: Parameters, rate: float):
        self.p, self.rate, self.step = parameters, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in parameters.items()}
        self.square = {k: np.zeros_like(v) for k, v in parameters.items()}

    def update(self, gradients: Parameters) -> None:
        self.step += 1
        for k, g in gradients.items():
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.001 * (g * g - self.square[k])
            mean, square = self.mean[k] / (1 - 0.9**self.step), self.square[k] / (1 - 0.999**self.step)
            self.p[k] -= self.rate * mean / (np.sqrt(square) + 1e-8)
