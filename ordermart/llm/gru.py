"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation.

State h predicts the next token, then reads it. The token's class comes from a softmax
over all classes; a word of a head class then from a softmax over its class's words. A
tail class holds many rare words: the model gives the class alone, and the share of the
word within it is a matter of counts. Many texts run side by side in lanes, window by
window; a lane's state goes on from one window to the next, gradients stop at its edge.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

from ordermart.llm.common import spans

SIZE = 16
GROUP = 32
STEPS = 16
LANES = 512
LONG = 256  # steps of a window with few lanes
TOP = 60.0  # no logit comes near it; its exponential still fits


def shapes(heads: int, tails: int, size: int = SIZE) -> dict[str, tuple]:
    groups = -(-heads // GROUP)
    return {"x": (heads + tails, 3 * size), "u": (size, 3 * size), "bu": (3 * size,), "c": (size, groups + tails),
            "bc": (groups + tails,), "w": (groups, size, GROUP), "bw": (groups, GROUP)}


def start(heads: int, tails: int, counts: np.ndarray, size: int = SIZE) -> dict[str, np.ndarray]:
    """Parameters whose biases are the tokens' counts (head words, then tail classes)."""
    rng = np.random.default_rng(1)
    p = {k: (rng.standard_normal(s) * (0.3 if k == "u" else 0.1)).astype(np.float32) for k, s in shapes(heads, tails, size).items()}
    groups = -(-heads // GROUP)
    word = np.full(groups * GROUP, 1e-30)
    word[:heads] = np.maximum(counts[:heads], 0.5)
    word = word.reshape(groups, GROUP)
    share = np.append(word.sum(axis=1), np.maximum(counts[heads:], 0.5))
    p["bc"] = np.log(share / share.sum()).astype(np.float32)
    p["bw"] = np.log(word / word.sum(axis=1, keepdims=True)).astype(np.float32)
    p["c"] *= 0.1
    p["w"] *= 0.1
    p["bu"] *= 0
    return p


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def lanes_of(lengths: np.ndarray, lanes: int = LANES) -> list[list[int]]:
    """Texts dealt to lanes of like total length: longest first, each to the shortest lane."""
    order = np.argsort(-lengths, kind="stable")
    dealt = [[] for _ in range(min(lanes, len(order)))]
    heap = [(0, k) for k in range(len(dealt))]
    for row in order.tolist():
        total, k = heap[0]
        dealt[k].append(row)
        heapq.heapreplace(heap, (total + int(lengths[row]), k))
    return dealt


def windows(ids: np.ndarray, rows: np.ndarray, lanes: int = LANES, steps: int = STEPS, most: int = STEPS) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(place in ids, whether a text begins there, live lanes): steps x live lanes at a
    time. Lanes stand by length, so those still running are the first ones; a place
    past a lane's end is -1. With fewer live lanes a window has up to `most` steps."""
    length = np.diff(rows)
    dealt = lanes_of(length, lanes)
    total = np.array([length[d].sum() for d in dealt], np.int64)
    by = np.argsort(-total, kind="stable")
    total = total[by]
    if not len(total) or not total[0]:
        return
    order = np.concatenate([dealt[k] for k in by]).astype(np.int64)
    order = order[length[order] > 0]
    flat = spans(rows[order], length[order])  # lane after lane
    first = np.zeros(len(flat), bool)
    first[np.cumsum(length[order]) - length[order]] = True
    edge = np.cumsum(total) - total
    t = 0
    while t < total[0]:
        live = int((total > t).sum())
        n = max(steps, min(most, steps * len(total) // live))
        step = t + np.arange(n)[:, None]
        inside = step < total[:live]
        at = np.where(inside, edge[:live] + step, 0)
        yield np.where(inside, flat[at], -1), first[at] & inside, live
        t += n


def _run(p: dict, ids: np.ndarray, begins: np.ndarray, h: np.ndarray, keep: bool):
    """States before each step (steps x lanes x size), the last one, and the gates
    that backward needs."""
    size = p["u"].shape[0]
    steps, lanes = ids.shape
    x = p["x"][ids]
    x += p["bu"]
    states = np.empty((steps, lanes, size), np.float32)
    on = (~begins).astype(np.float32)[:, :, None]  # a text begins with a state of zeros
    kept = np.empty((4, steps, lanes, size), np.float32) if keep else None
    u = p["u"]
    for t in range(steps):
        now = np.multiply(h, on[t], out=states[t])
        g = now @ u
        gate = g[:, :2 * size] + x[t, :, :2 * size]
        _sigmoid(gate)
        z, r, gn = gate[:, :size], gate[:, size:], g[:, 2 * size:]
        n = r * gn
        n += x[t, :, 2 * size:]
        np.tanh(n, out=n)
        if keep:
            kept[0, t], kept[1, t], kept[2, t], kept[3, t] = z, r, gn, n
        h = now - n
        h *= z
        h += n
    return states, h, kept


def _limit(logit: np.ndarray, weights: np.ndarray) -> None:
    """In place. States are within 1, so only weights that could pass TOP need it."""
    if np.abs(weights).sum(axis=-2).max() > TOP:
        np.minimum(logit, TOP, out=logit)


def _output(p: dict, states: np.ndarray, ids: np.ndarray, heads: int, gradient: dict | None):
    """Natural-log probabilities of class and head word at each place, flat; with a
    gradient dict, also the loss's slope by the states."""
    groups, size, width = p["w"].shape
    group = np.where(ids < heads, ids // GROUP, groups + ids - heads).astype(np.uint16)  # sorted by radix
    s = np.ones((len(ids), size + 1), states.dtype)  # the last column takes the biases
    s[:, :size] = states
    c = np.vstack([p["c"], p["bc"]])
    w = np.concatenate([p["w"], p["bw"][:, None]], axis=1)
    logit = s @ c
    _limit(logit, c)
    every = np.arange(len(ids))
    out = logit[every, group].astype(np.float64)
    np.exp(logit, out=logit)
    total = logit @ np.ones(logit.shape[1], logit.dtype)
    out -= np.log(total)
    slope = None
    if gradient is not None:
        logit *= (1 / total)[:, None]
        logit[every, group] -= 1
        g = s.T @ logit
        gradient["c"] += g[:-1]
        gradient["bc"] += g[-1]
        slope = logit @ p["c"].T
    order = np.argsort(group, kind="stable")
    edges = np.searchsorted(group[order], np.arange(groups + 1))
    order = order[:edges[-1]]  # head words, group by group
    used = np.flatnonzero(np.diff(edges)).tolist()
    edges = edges.tolist()
    s = s[order]
    e = np.empty((len(order), width), logit.dtype)
    for k in used:
        np.matmul(s[edges[k]:edges[k + 1]], w[k], out=e[edges[k]:edges[k + 1]])
    _limit(e, w)
    word = ids[order] % GROUP
    line = every[:len(order)]
    hit = e[line, word].astype(np.float64)
    np.exp(e, out=e)
    total = e @ np.ones(width, e.dtype)
    out[order] += hit - np.log(total)
    if gradient is not None:
        e *= (1 / total)[:, None]
        e[line, word] -= 1
        back = np.empty((len(order), size), slope.dtype)
        for k in used:
            part = e[edges[k]:edges[k + 1]]
            g = s[edges[k]:edges[k + 1]].T @ part
            gradient["w"][k] += g[:-1]
            gradient["bw"][k] += g[-1]
            np.matmul(part, p["w"][k].T, out=back[edges[k]:edges[k + 1]])
        slope[order] += back
    return out, slope


def score(p: dict, ids: np.ndarray, rows: np.ndarray, heads: int, lanes: int = LANES) -> np.ndarray:
    """Log10 probability of each token of the texts, which lie end to end in ids: the
    word's for head words, its class's for others. State goes through whole texts."""
    out = np.empty(len(ids))
    h = np.zeros((lanes, p["u"].shape[0]), np.float32)
    for place, begins, live in windows(ids, rows, lanes, most=LONG):
        states, h, _ = _run(p, ids[place], begins, h[:live], False)
        ok = place >= 0
        out[place[ok]] = _output(p, states[ok], ids[place[ok]], heads, None)[0]
    return out / np.log(10)


def train(p: dict, ids: np.ndarray, rows: np.ndarray, heads: int, square: dict, rate: float = 0.1,
          lanes: int = LANES, steps: int = STEPS) -> None:
    """One pass of truncated backpropagation over the texts, with Adagrad in place. State
    goes through whole texts; a window with fewer tokens than a full one moves less."""
    full = steps * max(1, min(lanes, len(rows) - 1))
    size = p["u"].shape[0]
    h = np.zeros((lanes, size), np.float32)
    for place, begins, live in windows(ids, rows, lanes, steps, LONG):
        token = ids[place]
        states, after, kept = _run(p, token, begins, h[:live], True)
        ok = place >= 0
        g = {k: np.zeros_like(v) for k, v in p.items() if k != "x"}
        _, slope = _output(p, states[ok], token[ok], heads, g)
        back = np.zeros_like(states)
        back[ok] = slope
        z, r, gn, n = kept
        to_n = (1 - z) * (1 - n * n)
        to_z = (states - n) * z * (1 - z)
        to_r = gn * r * (1 - r)
        on = (~begins).astype(np.float32)[:, :, None]
        dg = np.empty((len(token), live, 3 * size), np.float32)
        dx = np.empty_like(dg)
        d = np.zeros((live, size), np.float32)
        turned = np.ascontiguousarray(p["u"].T)
        for t in range(len(token) - 1, -1, -1):  # past a lane's end d is 0
            dn = np.multiply(d, to_n[t], out=dx[t, :, 2 * size:])
            now = dg[t]
            np.multiply(d, to_z[t], out=now[:, :size])
            np.multiply(dn, to_r[t], out=now[:, size:2 * size])
            np.multiply(dn, r[t], out=now[:, 2 * size:])
            d *= z[t]
            d += now @ turned
            d *= on[t]
            d += back[t]
        dx[:, :, :2 * size] = dg[:, :, :2 * size]
        g["u"] += states.reshape(-1, size).T @ dg.reshape(-1, 3 * size)
        flat, dx = token[ok], dx[ok]
        g["bu"] += dx.sum(axis=0)
        order = np.argsort(flat.astype(np.uint16) if len(p["x"]) < 2**16 else flat, kind="stable")
        at = np.flatnonzero(np.append(True, np.diff(flat[order]) != 0))
        seen, gx = flat[order][at], np.add.reduceat(dx[order], at, axis=0)
        pace = rate * min(1.0, len(flat) / full)
        norm = np.float32(1 / np.sqrt(max(1, len(flat))))
        for k, v in g.items():
            v *= norm
            square[k] += v * v
            p[k] -= pace * v / (np.sqrt(square[k]) + 1e-6)
        gx *= norm
        square["x"][seen] += gx * gx
        p["x"][seen] -= pace * gx / (np.sqrt(square["x"][seen]) + 1e-6)
        h = after
