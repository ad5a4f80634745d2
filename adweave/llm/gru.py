"""A gated recurrent language model in numpy with a class-factored softmax, trained by truncated backpropagation."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

HIDDEN, EMBED = 16, 16
WINDOW = 32  # steps of one truncated backpropagation
TOGETHER = 1 << 15  # states that are scored together


@dataclass
class Net:
    """Ids 0 … n-1 are words in falling frequency, n is any other word. Words share classes of ``per_class`` by rank."""

    n: int
    per_class: int
    weights: dict[str, np.ndarray]

    @property
    def classes(self) -> int:
        return -(-self.n // self.per_class)

    def gates(self) -> np.ndarray:
        return self.weights["embed"] @ self.weights["inward"] + self.weights["bias"]


def new_net(counts: np.ndarray, others: int, seed: int = 7) -> Net:
    """A net that starts as the unigram model of ``counts`` (words by rank) and ``others`` (all other tokens)."""
    n = len(counts)
    per_class = max(1, round(n**0.5))
    classes = -(-n // per_class)
    rng = np.random.default_rng(seed)
    small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    padded = np.full(classes * per_class, -1e9)
    padded[:n] = np.log(counts + 0.5)
    within = padded.reshape(classes, per_class)
    mass = np.append(np.exp(within).sum(axis=1), others + 0.5)
    weights = {
        "embed": small(n + 1, EMBED), "inward": small(EMBED, 3 * HIDDEN), "bias": np.zeros(3 * HIDDEN, np.float32), "recur": small(HIDDEN, 3 * HIDDEN),
        "to_class": np.zeros((HIDDEN, classes + 1), np.float32), "class_bias": np.log(mass / mass.sum()).astype(np.float32),
        "to_word": np.zeros((classes, HIDDEN, per_class), np.float32), "word_bias": within.astype(np.float32),
    }
    return Net(n, per_class, weights)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """Of ``x``, in its place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def step(gate: np.ndarray, h: np.ndarray, recur: np.ndarray) -> tuple:
    """One step of the unit: (new state, update gate, reset gate, candidate)."""
    k = h.shape[1]
    both = h @ recur[:, : 2 * k]
    both += gate[:, : 2 * k]
    both = _sigmoid(both)
    z, r = both[:, :k], both[:, k:]
    c = (r * h) @ recur[:, 2 * k :]
    c += gate[:, 2 * k :]
    c = np.tanh(c, out=c)
    return h + z * (c - h), z, r, c


def _exponents(logits: np.ndarray) -> np.ndarray | float:
    """Replaces logits by their exponentials, less what is returned: 0, or each row's largest where one is large."""
    top = 0.0
    if logits.size and logits.max() > 60:
        top = logits.max(axis=1)
        logits -= top[:, None]
    np.exp(logits, out=logits)
    return top


class _Targets:
    """Ids in the order of their classes, so that the ids of a class are a slice."""

    def __init__(self, ids: np.ndarray, net: Net):
        owner = np.minimum(ids // net.per_class, net.classes)
        owner[ids == net.n] = net.classes
        self.order = np.argsort(owner.astype(np.int32), kind="stable")
        self.owner, ids = owner[self.order], ids[self.order]
        self.within = ids - self.owner * net.per_class
        edges = np.searchsorted(self.owner, np.arange(net.classes + 1)).tolist()
        self.groups = [(c, a, b) for c, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]
        self.rows = np.arange(len(ids))


def log_probs(net: Net, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Natural log probability of each id given its state; for another word that of being one."""
    w, t = net.weights, _Targets(ids, net)
    states = states[t.order]

    def chosen(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
        value = logits[t.rows[: len(at)], at]
        top = _exponents(logits)
        return value - top - np.log(logits.sum(axis=1))

    logits = states @ w["to_class"]
    logits += w["class_bias"]
    found = chosen(logits, t.owner).astype(np.float64)
    for c, a, b in t.groups:
        logits = states[a:b] @ w["to_word"][c]
        logits += w["word_bias"][c]
        found[a:b] += chosen(logits, t.within[a:b])
    out = np.empty(len(ids))
    out[t.order] = found
    return out


def gradients(net: Net, given: np.ndarray, wanted: np.ndarray, real: np.ndarray, h: np.ndarray, end: int) -> tuple[dict, dict, np.ndarray]:
    """(gradients, their rows, last state) of the mean negative log probability of one window.

    ``given`` and ``wanted`` are ids by step and lane, ``real`` says which of the wanted count, ``h`` is the state before.
    Gradients of words and classes have only the rows that the window meets, named in the second result.
    """
    w, k = net.weights, h.shape[1]
    steps, batch = given.shape
    kind = h.dtype
    met_words, place = np.unique(given, return_inverse=True)
    gates = (w["embed"][met_words] @ w["inward"] + w["bias"])[place.reshape(given.shape)]
    alive = (given != end)[:, :, None].astype(kind)
    old, new, z, r, c = (np.empty((steps, batch, k), kind) for _ in range(5))
    for t in range(steps):
        old[t] = h * alive[t]
        h, z[t], r[t], c[t] = step(gates[t], old[t], w["recur"])
        new[t] = h

    counted = np.flatnonzero(real.ravel())
    targets = _Targets(wanted.ravel()[counted], net)
    at = counted[targets.order]
    states, size = new.reshape(-1, k)[at], kind.type(max(len(at), 1))
    grads: dict = {}
    d = states @ w["to_class"]
    d += w["class_bias"]
    _exponents(d)
    d /= d.sum(axis=1, keepdims=True)
    d[targets.rows, targets.owner] -= 1
    grads["to_class"], grads["class_bias"] = states.T @ d, d.sum(axis=0)
    inner = d @ w["to_class"].T
    met = np.asarray([c for c, _, _ in targets.groups], np.int64)
    grads["to_word"] = np.empty((len(met), *w["to_word"].shape[1:]), kind)
    grads["word_bias"] = np.empty((len(met), w["word_bias"].shape[1]), kind)
    for i, (group, a, b) in enumerate(targets.groups):
        here = states[a:b]
        d = here @ w["to_word"][group]
        d += w["word_bias"][group]
        _exponents(d)
        d /= d.sum(axis=1, keepdims=True)
        d[targets.rows[: b - a], targets.within[a:b]] -= 1
        np.matmul(here.T, d, out=grads["to_word"][i])
        np.sum(d, axis=0, out=grads["word_bias"][i])
        inner[a:b] += d @ w["to_word"][group].T

    back = np.zeros((steps * batch, k), kind)
    back[at] = inner
    back = back.reshape(steps, batch, k)
    of_c, of_z, of_r, stay = z * (1 - c * c), (c - old) * z * (1 - z), old * r * (1 - r), 1 - z
    turned, both_turned = w["recur"][:, 2 * k :].T.copy(), w["recur"][:, : 2 * k].T.copy()
    gate_grad = np.empty((steps, batch, 3 * k), kind)
    carry = np.zeros((batch, k), kind)
    for t in range(steps - 1, -1, -1):
        dh = back[t] + carry
        g = gate_grad[t]
        dc = np.multiply(dh, of_c[t], out=g[:, 2 * k :])
        np.multiply(dh, of_z[t], out=g[:, :k])
        drh = dc @ turned
        np.multiply(drh, of_r[t], out=g[:, k : 2 * k])
        dh *= stay[t]
        drh *= r[t]
        dh += drh
        dh += g[:, : 2 * k] @ both_turned
        carry = np.multiply(dh, alive[t], out=dh)
    flat = gate_grad.reshape(-1, 3 * k)
    grads["recur"] = np.concatenate([old.reshape(-1, k).T @ flat[:, : 2 * k], (r * old).reshape(-1, k).T @ flat[:, 2 * k :]], axis=1)
    grads["bias"] = flat.sum(axis=0)
    order = np.argsort(place.ravel(), kind="stable")
    first = np.searchsorted(place.ravel()[order], np.arange(len(met_words)))
    by_word = np.add.reduceat(flat[order], first)
    grads["inward"] = w["embed"][met_words].T @ by_word
    grads["embed"] = by_word @ w["inward"].T
    for g in grads.values():
        g /= size
    everything = slice(None) if len(met) == net.classes else met
    return grads, {"embed": met_words, "to_word": everything, "word_bias": everything}, h


def train(net: Net, stream: np.ndarray, end: int, updates: int = 1_500, batch: int = 64, rate: float = 0.01, last: float = 1e-4) -> None:
    """Fits ``net`` in place to a stream of documents, each closed by ``end``. The state is carried from window to window and starts anew after an end.

    ``batch`` lanes share the stream; the last is filled up with tokens that count nothing. The step size falls from
    ``rate`` to ``last``. Rows of words and classes that a window doesn't meet keep their weights and moments.
    """
    if not len(stream):
        return
    length = -(-len(stream) // batch)
    w = net.weights
    filled = np.concatenate([stream, np.full(length * batch - len(stream), end, stream.dtype)])
    tokens = filled.reshape(batch, length).T
    real = (np.arange(length * batch) < len(stream)).reshape(batch, length).T
    before = np.concatenate([np.full((1, batch), end), tokens[:-1]])
    updates = min(updates, 20 * -(-length // WINDOW))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    h, at = np.zeros((batch, HIDDEN), np.float32), 0
    for turn in range(updates):
        if at >= length:
            at, h = 0, np.zeros_like(h)
        grads, rows, h = gradients(net, before[at : at + WINDOW], tokens[at : at + WINDOW], real[at : at + WINDOW], h, end)
        at += WINDOW
        norm = np.sqrt(sum(float(np.vdot(g, g)) for g in grads.values()))
        scale = np.float32(min(1.0, 1.0 / (norm + 1e-9)))
        pace = last + (rate - last) * (1 - turn / updates)
        pace = np.float32(pace * np.sqrt(1 - 0.99 ** (turn + 1)) / (1 - 0.9 ** (turn + 1)))
        for name, g in grads.items():
            part = rows.get(name, slice(None))
            m, v = (x[part] for x in moments[name])  # views, or copies of the rows met
            g *= scale
            m *= np.float32(0.9)
            v *= np.float32(0.99)
            m += np.float32(0.1) * g
            g *= g
            g *= np.float32(0.01)
            v += g
            if not isinstance(part, slice):
                moments[name][0][part], moments[name][1][part] = m, v
            np.sqrt(v, out=g)
            g += np.float32(1e-6)
            np.divide(m, g, out=g)
            g *= pace
            w[name][part] -= g


class Mean:
    """Weights of copies of a net trained apart, averaged: each word's and each class's by the tokens that taught it."""

    def __init__(self, net: Net):
        self.net = net
        self.sums = {k: np.zeros(v.shape, np.float32) for k, v in net.weights.items()}
        self.shares = {k: np.zeros(self._share(k), np.float32) for k in net.weights}

    def _share(self, name: str) -> tuple[int, ...]:
        shape = self.net.weights[name].shape
        return (shape[0], *[1] * (len(shape) - 1)) if name in ("embed", "to_word", "word_bias") else (1,) * len(shape)

    def learn(self, stream: np.ndarray, end: int, rate: float, last: float) -> None:
        """Adds what a copy learns in one pass over ``stream``; a stream has 32 updates or more, of up to 256 lanes."""
        net = Net(self.net.n, self.net.per_class, {k: v.copy() for k, v in self.net.weights.items()})
        lanes = min(max(len(stream) // (32 * WINDOW), 1), 256)
        train(net, stream, end, -(-len(stream) // (lanes * WINDOW)), lanes, rate, last)
        met = np.bincount(stream, minlength=net.n + 1).astype(np.float32)
        of_class = np.bincount(np.minimum(np.arange(net.n) // net.per_class, net.classes), met[: net.n], net.classes)
        for name, old in self.net.weights.items():
            share = {"embed": met, "to_word": of_class, "word_bias": of_class}.get(name, np.float32(len(stream)))
            share = np.asarray(share, np.float32).reshape(self._share(name))
            self.sums[name] += share * (net.weights[name] - old)
            self.shares[name] += share

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for held in (self.sums, self.shares) for x in held.values()])

    def apply(self, flat: np.ndarray) -> None:
        """Moves the net by the sum of the ``flat`` of all tasks."""
        at = 0
        for held in (self.sums, self.shares):
            for name, x in held.items():
                held[name] = flat[at : at + x.size].reshape(x.shape)
                at += x.size
        for name, x in self.sums.items():
            self.net.weights[name] += x / np.maximum(self.shares[name], 1)


def score(net: Net, sequences: list[np.ndarray], end: int) -> np.ndarray:
    """Natural log probability of each whole sequence (others only as being other words).

    Sequences run side by side, the longest first; the states of some steps are scored together, and the state goes on.
    """
    sizes = np.asarray([len(s) for s in sequences])
    order = np.argsort(-sizes, kind="stable")
    total = np.zeros(len(sequences))
    if not len(sequences) or not sizes.max():
        return total
    flat = np.concatenate([sequences[k] for k in order])
    begin = np.concatenate([[0], np.cumsum(sizes[order])[:-1]])
    ordered = sizes[order]
    h = np.zeros((len(order), HIDDEN), np.float32)
    gate_table, recur = net.gates(), net.weights["recur"]
    given = np.full(len(order), end)
    live_at = np.searchsorted(-ordered, -np.arange(int(ordered[0])), side="left").tolist()
    states, ids, owner, held = [], [], [], 0
    for t, live in enumerate(live_at):
        h = step(gate_table[given[:live]], h[:live], recur)[0]
        given = flat[begin[:live] + t]
        states.append(h)
        ids.append(given)
        owner.append(order[:live])
        held += live
        if held >= TOGETHER or t + 1 == len(live_at):
            total += np.bincount(np.concatenate(owner), log_probs(net, np.concatenate(states), np.concatenate(ids)), minlength=len(total))
            states, ids, owner, held = [], [], [], 0
    return total
