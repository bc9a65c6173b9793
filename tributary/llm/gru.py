"""A gated recurrent language model in numpy: truncated backpropagation, class-factored softmax, state kept across windows.

Token ids: 0 is the end of a document, 1..n_head-1 are the other head words by falling frequency, n_head stands for every
other word. Head words lie in classes of CLASS neighbours in that order; the last class is that of the other words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

CLASS = 64
F32 = np.float32


def shapes(n_head: int, hidden: int) -> dict[str, tuple[int, ...]]:
    groups = -(-n_head // CLASS)
    return {
        "x": (n_head + 1, 3 * hidden), "u": (hidden, 3 * hidden), "b": (3 * hidden,),
        "wc": (hidden, groups + 1), "bc": (groups + 1,), "ww": (groups, hidden, CLASS), "bw": (groups, CLASS),
    }


def initial(head_counts: np.ndarray, other: int, hidden: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Parameters that say what the counts say; training starts from there."""
    n_head = len(head_counts)
    rng = np.random.default_rng(seed)
    p = {k: np.zeros(s, F32) for k, s in shapes(n_head, hidden).items()}
    p["x"] = rng.normal(0, 0.1, p["x"].shape).astype(F32)
    p["u"] = rng.normal(0, 0.5 / np.sqrt(hidden), p["u"].shape).astype(F32)
    groups = len(p["bw"])
    c = np.zeros(groups * CLASS)
    c[:n_head] = head_counts + 0.5
    c = c.reshape(groups, CLASS)
    with np.errstate(divide="ignore"):
        p["bw"] = np.maximum(np.log(c / c.sum(axis=1, keepdims=True)), -60).astype(F32)
    mass = np.append(c.sum(axis=1), other + 0.5)
    p["bc"] = np.log(mass / mass.sum()).astype(F32)
    return p


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([v.ravel() for v in p.values()])


def views(v: np.ndarray, n_head: int, hidden: int) -> dict[str, np.ndarray]:
    """The parts of a flat array, as views of it."""
    out, at = {}, 0
    for k, s in shapes(n_head, hidden).items():
        size = int(np.prod(s))
        out[k] = v[at : at + size].reshape(s)
        at += size
    return out


def shaped(v: np.ndarray, n_head: int, hidden: int) -> dict[str, np.ndarray]:
    return views(np.asarray(v, F32), n_head, hidden)


def step(x: np.ndarray, u: np.ndarray, tokens: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
    """One step of the gated unit for a batch of lanes; x: input table with the bias added."""
    n = h.shape[1]
    g = h @ u
    a = x.take(tokens, axis=0)
    zr = a[:, : 2 * n]
    zr += g[:, : 2 * n]
    zr = logistic(zr)
    z, r = zr[:, :n], zr[:, n:]
    c = r * g[:, 2 * n :]
    c += a[:, 2 * n :]
    c *= F32(2)
    c = logistic(c)  # tanh(x) = 2 logistic(2 x) - 1
    c *= F32(2)
    c -= F32(1)
    new = h - c
    new *= z
    new += c
    return new, (h, z, r, c, g[:, 2 * n :])


def logistic(x: np.ndarray) -> np.ndarray:
    y = np.negative(x)
    np.minimum(y, F32(60), out=y)
    np.exp(y, out=y)
    y += F32(1)
    return np.reciprocal(y, out=y)


def softmax(a: np.ndarray) -> np.ndarray:
    """In place."""
    a -= a.max(axis=1, keepdims=True)
    np.exp(a, out=a)
    a /= (a @ np.ones(a.shape[1], a.dtype))[:, None]
    return a


def log_share(a: np.ndarray, targets: np.ndarray, small: bool) -> np.ndarray:
    """Log softmax at the targets; small: the logits cannot overflow. Overwrites a."""
    if not small:
        a -= a.max(axis=1, keepdims=True)
    picked = a[np.arange(len(a)), targets]
    np.exp(a, out=a)
    return picked - np.log(a @ np.ones(a.shape[1], a.dtype))


def cannot_overflow(w: np.ndarray, b: np.ndarray) -> bool:
    """States lie between -1 and 1, which bounds the logits."""
    return bool((np.abs(w).sum(axis=-2) + np.abs(b)).max() < 80)


def by_class(targets: np.ndarray, groups: int) -> Iterator[tuple[int, np.ndarray]]:
    """(class, positions of its targets); not for the class of the other words."""
    kind = targets // CLASS
    order = np.argsort(kind, kind="stable")
    cut = np.searchsorted(kind[order], np.arange(groups + 1))
    for g in range(groups):
        if cut[g] < cut[g + 1]:
            yield g, order[cut[g] : cut[g + 1]]


def class_of(targets: np.ndarray, n_head: int, groups: int) -> np.ndarray:
    return np.where(targets == n_head, groups, targets // CLASS)


def log_probs(p: dict[str, np.ndarray], h: np.ndarray, targets: np.ndarray, n_head: int) -> np.ndarray:
    """Natural log probability of each target after each state; for other words that of their class."""
    groups = len(p["bw"])
    out = log_share(h @ p["wc"] + p["bc"], class_of(targets, n_head, groups), cannot_overflow(p["wc"], p["bc"])).astype(np.float64)
    for g, at in by_class(np.where(targets == n_head, groups * CLASS, targets), groups):
        inner = h[at] @ p["ww"][g]
        inner += p["bw"][g]
        out[at] += log_share(inner, targets[at] - g * CLASS, cannot_overflow(p["ww"][g], p["bw"][g]))
    return out


def plain_step(x: np.ndarray, u: np.ndarray, tokens: np.ndarray, h: np.ndarray) -> np.ndarray:
    """step() for scoring. Lanes are columns; x and u carry the factors -1, -1, -2 that the exponentials want; overflow to infinity is right."""
    n = len(h)
    g = u @ h
    a = x.take(tokens, axis=0).T
    zr = g[: 2 * n]
    zr += a[: 2 * n]
    np.exp(zr, out=zr)
    zr += F32(1)
    np.reciprocal(zr, out=zr)
    c = zr[n:]
    c *= g[2 * n :]
    c += a[2 * n :]
    np.exp(c, out=c)
    c += F32(1)
    np.reciprocal(c, out=c)
    c *= F32(2)
    c -= F32(1)
    new = h - c
    new *= zr[:n]
    new += c
    return new


def score(p: dict[str, np.ndarray], tokens: np.ndarray, sizes: np.ndarray, n_head: int, lanes: int = 2048, window: int = 64) -> np.ndarray:
    """Log probability of every whole document; the state goes from window to window.

    tokens: the documents' ids one after the other, each ending with 0; sizes: their lengths. Documents of like length run
    side by side, so that few lanes wait for a long one.
    """
    total = np.zeros(len(sizes))
    begins = np.cumsum(sizes) - sizes
    tokens = np.append(tokens, np.zeros(window, tokens.dtype))
    order = np.argsort(-sizes, kind="stable")
    hidden = p["u"].shape[0]
    factor = np.repeat(np.array([-1, -1, -2], F32), hidden)
    x, u = (p["x"] + p["b"]) * factor, np.ascontiguousarray((p["u"] * factor).T)
    for first in range(0, len(order), lanes):
        own = order[first : first + lanes]
        size, begin = sizes[own], begins[own]
        h, last = np.zeros((hidden, len(own)), F32), np.zeros(len(own), np.int64)
        for t0 in range(0, int(size[0]), window):
            width = min(window, int(size[0]) - t0)
            alive = np.searchsorted(-size, -(t0 + np.arange(width)), side="left")  # lanes that go on at each step
            n = int(alive[0])
            ids = tokens[np.minimum(begin[:n, None] + (t0 + np.arange(width))[None], len(tokens) - 1)].T.copy()
            states, targets, lane = [], [], []
            with np.errstate(over="ignore"):
                for t, m in enumerate(alive.tolist()):
                    h = plain_step(x, u, last[:m], h[:, :m] if m < h.shape[1] else h)
                    last = ids[t, :m]
                    states.append(h.T)
                    targets.append(last)
                    lane.append(np.arange(m))
            got = log_probs(p, np.concatenate(states), np.concatenate(targets), n_head)
            total[own[:n]] += np.bincount(np.concatenate(lane), got, minlength=n)
    return total


def blocks_of(docs: Iterable[np.ndarray], lanes: int, window: int, most: int) -> Iterator[np.ndarray]:
    """The documents one after the other, cut into [lanes, steps + 1]: every token is a target exactly once.

    Blocks have about `most` tokens. Few tokens get few lanes, so that they make some windows; what doesn't fill the lanes
    goes to the next block, and at the end into ever fewer lanes.
    """

    def cut(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(stream) - 1
        k = max(1, min(lanes, n // (16 * window))) if n >= 16 * window else max(1, n // window)
        steps = n // k
        return np.stack([stream[i * steps : i * steps + steps + 1] for i in range(k)]), stream[k * steps :]

    held, size = [np.zeros(1, np.int64)], 0
    for doc in docs:
        for part in np.split(doc, range(most, len(doc), most)):
            held.append(part)
            size += len(part)
            if size >= most:
                block, rest = cut(np.concatenate(held))
                yield block
                held, size = [rest], len(rest) - 1
    rest = np.concatenate(held)
    while len(rest) > 1:
        block, rest = cut(rest)
        yield block


def train(p: dict[str, np.ndarray], docs: Iterable[np.ndarray], n_head: int, lanes: int = 256, window: int = 24, rate: float = 0.015, most: int = 400_000) -> tuple[dict[str, np.ndarray], int]:
    """One pass of truncated backpropagation with Adam over all documents, and the number of tokens; the state is carried
    from window to window in a block, Adam's over all of them. A window counts by its tokens."""
    n_hidden = p["u"].shape[0]
    all_p = flat(p)
    p = views(all_p, n_head, n_hidden)
    m1, m2, work = np.zeros_like(all_p), np.zeros_like(all_p), np.zeros_like(all_p)
    i, seen, widest = 0, 0, 1
    for data in blocks_of(docs, lanes, window, most):
        h = np.zeros((len(data), n_hidden), F32)
        for t0 in range(0, data.shape[1] - 1, window):
            part = data[:, t0 : t0 + window + 1]
            size, i = part.shape[0] * (part.shape[1] - 1), i + 1
            seen, widest = seen + size, max(widest, size)
            grad, h = gradient(p, part[:, :-1], part[:, 1:], h, n_head)
            g = flat(grad)
            np.clip(g, -1, 1, out=g)
            g *= F32(size / widest)
            m1 *= F32(0.9)
            np.multiply(g, F32(0.1), out=work)
            m1 += work
            m2 *= F32(0.99)
            g *= g
            g *= F32(0.01)
            m2 += g
            np.multiply(m2, F32(1 / (1 - 0.99**i)), out=work)
            np.sqrt(work, out=work)
            work += F32(1e-6)
            np.divide(m1, work, out=work)
            work *= F32(rate / (1 + 0.002 * i) / (1 - 0.9**i))
            all_p -= work
    return {k: v.copy() for k, v in p.items()}, seen


def gradient(p: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray, h: np.ndarray, n_head: int) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradient of the mean loss over one window [lanes, steps] from state h, and the state after it."""
    lanes, steps = inputs.shape
    groups, hidden = len(p["bw"]), h.shape[1]
    kept, states = [], []
    x, begins = p["x"] + p["b"], inputs == 0
    for t in range(steps):
        if begins[:, t].any():
            h = np.where(begins[:, t, None], F32(0), h)  # a document begins
        h, cache = step(x, p["u"], inputs[:, t], h)
        kept.append(cache)
        states.append(h)
    flat_h, flat_t = np.concatenate(states), targets.T.ravel()
    scale = F32(1 / len(flat_t))
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    d = softmax(flat_h @ p["wc"] + p["bc"])
    d[np.arange(len(flat_t)), class_of(flat_t, n_head, groups)] -= 1
    d *= scale
    grad["wc"], grad["bc"] = flat_h.T @ d, d.sum(axis=0)
    dh = d @ p["wc"].T
    for g, at in by_class(np.where(flat_t == n_head, groups * CLASS, flat_t), groups):
        own = flat_h[at]
        d = softmax(own @ p["ww"][g] + p["bw"][g])
        d[np.arange(len(at)), flat_t[at] - g * CLASS] -= 1
        d *= scale
        grad["ww"][g], grad["bw"][g] = own.T @ d, d.sum(axis=0)
        dh[at] += d @ p["ww"][g].T
    dh = dh.reshape(steps, lanes, hidden)
    later = np.zeros_like(h)
    dx_all = np.empty((steps, lanes, 3 * hidden), F32)
    for t in reversed(range(steps)):
        before, z, r, c, gn = kept[t]
        dt = dh[t] + later
        dc = dt * (1 - z) * (1 - c * c)
        dx = dx_all[t]
        dx[:, :hidden] = dt * (before - c) * z * (1 - z)
        dx[:, hidden : 2 * hidden] = dc * gn * r * (1 - r)
        dx[:, 2 * hidden :] = dc
        dg = dx.copy()
        dg[:, 2 * hidden :] *= r
        grad["u"] += before.T @ dg
        later = dt * z + dg @ p["u"].T
        later[begins[:, t]] = 0
    flat_dx = dx_all.reshape(-1, 3 * hidden)
    grad["b"] = flat_dx.sum(axis=0)
    flat_in = inputs.T.ravel()
    order = np.argsort(flat_in, kind="stable")
    starts = np.flatnonzero(np.diff(flat_in[order], prepend=-1))
    grad["x"][flat_in[order][starts]] = np.add.reduceat(flat_dx[order], starts, axis=0)
    return grad, h
