"""A small gated recurrent language model in numpy with a class-factored softmax.

Texts run in lockstep, longest first, so that the texts still running are always a prefix of the batch and nothing is
padded. The state is carried through a text from its first token to its last, window after window.
"""

from __future__ import annotations

import heapq

import numpy as np


class Model:
    """Weights; ids are sorted by class, so that a class is a range of ids."""

    names = ("table", "recurrent", "gate_bias", "class_weight", "class_bias", "word_weight", "word_bias")

    def __init__(self, counts: np.ndarray, hidden: int = 16, classes: int = 32, seed: int = 0):
        """counts by id, most frequent first (all over 0): the biases start as the counts' own distribution."""
        rng = np.random.default_rng(seed)
        share = np.sqrt(counts / counts.sum())
        edge = np.searchsorted(np.cumsum(share) / share.sum(), np.linspace(0, 1, classes + 1)[1:-1])
        self.edges = np.unique(np.concatenate([[0], edge + 1, [len(counts)]]))
        self.class_of = np.repeat(np.arange(len(self.edges) - 1), np.diff(self.edges))
        by_class = np.add.reduceat(counts, self.edges[:-1]).astype(float)
        f = np.float32
        self.table = rng.normal(0, 0.3, (len(counts), 3 * hidden)).astype(f)
        self.recurrent = (rng.normal(0, 1, (hidden, 3 * hidden)) / hidden**0.5).astype(f)
        self.gate_bias = np.concatenate([np.zeros(hidden), np.full(hidden, 1.0), np.zeros(hidden)]).astype(f)
        self.class_weight = rng.normal(0, 0.05, (hidden, len(by_class))).astype(f)
        self.class_bias = np.log(by_class / by_class.sum()).astype(f)
        self.word_weight = rng.normal(0, 0.05, (len(counts), hidden)).astype(f)
        self.word_bias = np.log(counts / by_class[self.class_of]).astype(f)

    def vector(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.names])

    def load(self, vector: np.ndarray) -> Model:
        at = 0
        for n in self.names:
            old = getattr(self, n)
            setattr(self, n, vector[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return self


def _gates(m: Model, ids: np.ndarray, h: np.ndarray):
    k = h.shape[1]
    x = m.table[ids]
    x += m.gate_bias
    g = h @ m.recurrent
    rz = x[:, : 2 * k] + g[:, : 2 * k]
    rz *= 0.5
    np.tanh(rz, out=rz)
    rz += 1
    rz *= 0.5
    n = np.tanh(x[:, 2 * k :] + rz[:, :k] * g[:, 2 * k :])
    return rz, n, g


def _softmax(a: np.ndarray) -> np.ndarray:
    """Probabilities of each row, in place. Scores are clipped to +-40, which neither overflows nor loses a probability."""
    np.clip(a, -40, 40, out=a)
    np.exp(a, out=a)
    a /= a @ np.ones((a.shape[1], 1), a.dtype)
    return a


def _by_class(m: Model, targets: np.ndarray):
    """Rows of each class among targets."""
    classes = m.class_of[targets]
    order = np.argsort(classes, kind="stable")
    ends = np.searchsorted(classes[order], np.arange(len(m.edges)))
    for c in range(len(m.edges) - 1):
        if ends[c] < ends[c + 1]:
            yield m.edges[c], m.edges[c + 1], order[ends[c] : ends[c + 1]]


def log_probability(m: Model, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log of P(class) * P(word of class) for each row."""
    classes = m.class_of[targets]
    out = np.log(_softmax(states @ m.class_weight + m.class_bias)[np.arange(len(targets)), classes])
    for a, b, rows in _by_class(m, targets):
        if b - a > 1:
            found = _softmax(states[rows] @ m.word_weight[a:b].T + m.word_bias[a:b])
            out[rows] += np.log(found[np.arange(len(rows)), targets[rows] - a])
    return out


def score(m: Model, texts: list[np.ndarray], cells: int = 16_384) -> np.ndarray:
    """Natural log probability of each whole text (arrays of ids)."""
    total = np.zeros(len(texts))
    order = np.argsort([-len(t) for t in texts], kind="stable")
    lengths = np.asarray([len(texts[i]) for i in order])
    flat = np.concatenate([texts[i] for i in order]) if len(texts) else np.empty(0, np.int32)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(texts) else np.empty(0, np.int64)
    h = np.zeros((len(texts), m.recurrent.shape[0]), np.float32)
    running = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), "right") if len(texts) and lengths[0] else []
    t = 0
    while t < len(running):
        steps = min(max(8, cells // running[t]), len(running) - t)
        before, targets, rows = [], [], []
        for k in range(t, t + steps):
            n = running[k]
            ids = flat[starts[:n] + k]
            before.append(h[:n].copy())
            targets.append(ids)
            rows.append(n)
            rz, new, _ = _gates(m, ids, h[:n])
            z = rz[:, h.shape[1] :]
            h[:n] += (1 - z) * (new - h[:n])
        found = log_probability(m, np.concatenate(before), np.concatenate(targets))
        total += np.bincount(np.concatenate([np.arange(n) for n in rows]), found, len(texts))
        t += steps
    out = np.empty(len(texts))
    out[order] = total
    return out


class Adam:
    def __init__(self, m: Model, rate: float):
        self.rate, self.t = rate, 0
        self.moments = {n: (np.zeros_like(getattr(m, n)), np.zeros_like(getattr(m, n))) for n in m.names}

    def step(self, m: Model, gradients: dict[str, np.ndarray]) -> None:
        self.t += 1
        size = np.sqrt(sum(float((g * g).sum()) for g in gradients.values()))
        scale = np.float32(min(1.0, 1.0 / max(size, 1e-9)))  # gradients are clipped to length 1
        rate = np.float32(self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t))
        for n, g in gradients.items():
            a, b = self.moments[n]
            g = g * scale
            a += np.float32(0.1) * (g - a)
            b += np.float32(0.001) * (g * g - b)
            getattr(m, n)[...] -= rate * a / (np.sqrt(b) + np.float32(1e-7))


def lanes_of(texts: list[np.ndarray], lanes: int, stretch: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids and start marks by step and lane, and the number of lanes still running at each step.

    Texts stand one behind the other in the lanes, each new one in the lane that is shortest; a text longer than stretch
    takes several places. Nothing is padded but the ends of lanes.
    """
    pieces = sorted((t[k : k + stretch] for t in texts for k in range(0, len(t), stretch)), key=len, reverse=True)
    held: list[list[np.ndarray]] = [[] for _ in range(min(lanes, len(pieces)))]
    heap = [(0, i) for i in range(len(held))]
    for piece in pieces:
        size, i = heap[0]
        held[i].append(piece)
        heapq.heapreplace(heap, (size + len(piece), i))
    sizes = sorted(heap, reverse=True)
    ids = np.zeros((sizes[0][0] if sizes else 0, len(held)), np.int64)
    starts = np.zeros(ids.shape, bool)
    rng = np.random.default_rng(1)
    for lane, (_, i) in enumerate(sizes):
        at = 0
        for k in rng.permutation(len(held[i])):
            piece = held[i][k]
            ids[at : at + len(piece), lane], starts[at, lane] = piece, True
            at += len(piece)
    running = np.searchsorted(-np.asarray([n for n, _ in sizes]), -np.arange(1, len(ids) + 1), "right")
    return ids, starts, running


def gradients(m: Model, ids: np.ndarray, starts: np.ndarray, running: np.ndarray, h: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss of a window and its gradients; h is the state before it and becomes the state after it. Gradients end at the window's start."""
    k = h.shape[1]
    tape, targets = [], []
    for t, n in enumerate(running.tolist()):
        now, fresh = ids[t, :n], starts[t, :n]
        h[:n][fresh] = 0
        before = h[:n].copy()
        rz, new, gates = _gates(m, now, before)
        z = rz[:, k:]
        h[:n] = new + z * (before - new)
        tape.append((before, rz, new, gates, fresh))
        targets.append(now)
    states, wanted = np.concatenate([x[0] for x in tape]), np.concatenate(targets)
    share = h.dtype.type(1 / len(wanted))
    grad = {n: np.zeros_like(getattr(m, n)) for n in m.names}
    errors = _softmax(states @ m.class_weight + m.class_bias)
    row, classes = np.arange(len(wanted)), m.class_of[wanted]
    loss = float(np.log(errors[row, classes]).sum())
    errors[row, classes] -= 1
    errors *= share
    grad["class_weight"], grad["class_bias"] = states.T @ errors, errors.sum(axis=0)
    back = errors @ m.class_weight.T
    for a, b, rows in _by_class(m, wanted):
        if b - a > 1:
            held, own = states[rows], wanted[rows] - a
            e = _softmax(held @ m.word_weight[a:b].T + m.word_bias[a:b])
            row = np.arange(len(rows))
            loss += float(np.log(e[row, own]).sum())
            e[row, own] -= 1
            e *= share
            grad["word_weight"][a:b], grad["word_bias"][a:b] = e.T @ held, e.sum(axis=0)
            back[rows] += e @ m.word_weight[a:b]
    dh = np.zeros_like(h)
    inputs = np.empty((len(wanted), 3 * k), h.dtype)
    recurrent = np.empty_like(inputs)
    end = len(wanted)
    for before, rz, new, gates, fresh in reversed(tape):
        n = len(before)
        d, r, z = dh[:n], rz[:, :k], rz[:, k:]
        keep = d * (1 - z)
        dx, dg = inputs[end - n : end], recurrent[end - n : end]
        dx[:, k : 2 * k] = keep * z * (before - new)
        dx[:, 2 * k :] = keep * (1 - new * new)
        dx[:, :k] = dx[:, 2 * k :] * gates[:, 2 * k :] * r * (1 - r)
        dg[:, : 2 * k] = dx[:, : 2 * k]
        dg[:, 2 * k :] = dx[:, 2 * k :] * r
        dh[:n] = d * z + dg @ m.recurrent.T + back[end - n : end]
        dh[:n][fresh] = 0
        end -= n
    grad["recurrent"], grad["gate_bias"] = states.T @ recurrent, inputs.sum(axis=0)
    # one sum for each word of the window
    order = np.argsort(wanted, kind="stable")
    words, first = np.unique(wanted[order], return_index=True)
    grad["table"][words] = np.add.reduceat(inputs[order], first)
    return -loss / len(wanted), grad


def train(m: Model, texts: list[np.ndarray], *, rate: float = 0.012, window: int = 16, lanes: int = 256, updates: int = 100, stretch: int = 1_024) -> int:
    """One pass of truncated backpropagation over whole texts: states run through each stretch of a text, gradients through one window. Returns the tokens seen.

    There are as many lanes, 256 at most, as leave about 100 updates of the weights to the pass.
    """
    adam = Adam(m, rate)
    lanes = min(lanes, max(1, sum(map(len, texts)) // (window * updates)))
    ids, starts, running = lanes_of(texts, lanes, stretch)
    h = np.zeros((ids.shape[1], m.recurrent.shape[0]), m.recurrent.dtype)
    for low in range(0, len(ids), window):
        part = slice(low, low + window)
        adam.step(m, gradients(m, ids[part], starts[part], running[part], h)[1])
    return int(running.sum())
