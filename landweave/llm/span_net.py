"""Character-level bidirectional LSTM with CRF transitions, in numpy: training, marginals, decoding.

Decoding runs the LSTM over every character; the Viterbi search and the marginals are only run for
windows whose emissions leave any path but "no span" a chance, by a bound that is exact.
"""

from __future__ import annotations

from functools import reduce

import numpy as np

#: Characters with a code of their own; digits share one, as do all others.
ALPHABET = "abcdefghijklmnopqrstuvwxyz@.-+_%() \n\t,:;/#&*$!?\"'=[]{}<>|~\\"
DIGIT, OTHER = len(ALPHABET) + 1, len(ALPHABET) + 2
CODES = len(ALPHABET) + 3  # 0: padding
EMBED, HIDDEN = 10, 10
KINDS = ("email", "ip", "card", "phone", "secret")
TAGS = 1 + 2 * len(KINDS)  # none, then begin and inside of each kind

_TABLE = np.full(128, OTHER, dtype=np.int64)
for _i, _c in enumerate(ALPHABET):
    _TABLE[ord(_c)] = _i + 1
    _TABLE[ord(_c.upper())] = _i + 1
_TABLE[48:58] = DIGIT


def codes(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(cp < 128, _TABLE[np.minimum(cp, 127)], OTHER)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def initial(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {"embed": rng.normal(0, 0.3, (CODES, EMBED)), "out": rng.normal(0, 0.2, (2 * HIDDEN, TAGS)), "bias": np.zeros(TAGS), "trans": np.zeros((TAGS, TAGS)), "start": np.zeros(TAGS)}
    for d in ("f", "b"):
        p[f"w{d}"] = rng.normal(0, 1 / np.sqrt(EMBED + HIDDEN), (EMBED + HIDDEN, 4 * HIDDEN))
        p[f"c{d}"] = np.zeros(4 * HIDDEN)
        p[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1.0
    for t in range(2, TAGS, 2):  # inside follows begin or inside of its kind only
        p["trans"][[s for s in range(TAGS) if s not in (t - 1, t)], t] = -8.0
        p["start"][t] = -8.0
    return {k: v.astype(np.float32) for k, v in p.items()}


def _lstm(p: dict, d: str, x: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    steps, batch, _ = x.shape
    h, c = np.zeros((batch, HIDDEN), np.float32), np.zeros((batch, HIDDEN), np.float32)
    out, tape = np.zeros((steps, batch, HIDDEN), np.float32), []
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        inp = np.concatenate([x[t], h], axis=1)
        z = inp @ p[f"w{d}"] + p[f"c{d}"]
        gate = _sigmoid(z[:, : 3 * HIDDEN])
        g = np.tanh(z[:, 3 * HIDDEN :])
        i, f, o = gate[:, :HIDDEN], gate[:, HIDDEN : 2 * HIDDEN], gate[:, 2 * HIDDEN :]
        before, c = c, (f * c + i * g) * mask[t][:, None]
        tanh_c = np.tanh(c)
        h = o * tanh_c * mask[t][:, None]
        out[t] = h
        if keep:
            tape.append((t, inp, gate, g, before, tanh_c))
    return out, tape


def _lstm_back(p: dict, d: str, tape: list, d_out: np.ndarray, mask: np.ndarray, grads: dict) -> np.ndarray:
    steps, batch, _ = d_out.shape
    d_x = np.zeros((steps, batch, EMBED), np.float32)
    dh, dc = np.zeros((batch, HIDDEN), np.float32), np.zeros((batch, HIDDEN), np.float32)
    for t, inp, gate, g, before, tanh_c in reversed(tape):
        m = mask[t][:, None]
        i, f, o = gate[:, :HIDDEN], gate[:, HIDDEN : 2 * HIDDEN], gate[:, 2 * HIDDEN :]
        dh = (dh + d_out[t]) * m
        dc = (dc + dh * o * (1 - tanh_c**2)) * m
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tanh_c * o * (1 - o), dc * i * (1 - g**2)], axis=1)
        grads[f"w{d}"] += inp.T @ dz
        grads[f"c{d}"] += dz.sum(axis=0)
        d_in = dz @ p[f"w{d}"].T
        d_x[t], dh = d_in[:, :EMBED], d_in[:, EMBED:]
        dc = dc * f
    return d_x


def _emissions(p: dict, x: np.ndarray, keep: bool = False):
    """x: codes (steps, batch), 0 beyond a window's end."""
    mask = (x > 0).astype(np.float32)
    embedded = p["embed"][x]
    forward, tape_f = _lstm(p, "f", embedded, mask, keep)
    backward, tape_b = _lstm(p, "b", embedded, mask, keep)
    hidden = np.concatenate([forward, backward], axis=2)
    return hidden @ p["out"] + p["bias"], mask, hidden, tape_f, tape_b


def _forward_backward(p: dict, e: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of each tag, expected counts of each transition, and log of the sum over all paths of each window.

    Probabilities are scaled to sum to 1 at each step; e is (steps, batch, tags).
    """
    steps, batch, _ = e.shape
    top = e.max(axis=2)
    x = np.exp(e - top[:, :, None])
    jump = np.exp(p["trans"])
    a, c = np.empty_like(x), np.ones((steps, batch), x.dtype)
    first = p["start"].max()
    now = np.exp(p["start"] - first) * x[0]
    c[0] = now.sum(axis=1)
    a[0] = now / c[0][:, None]
    for t in range(1, steps):
        new = (a[t - 1] @ jump) * x[t]
        live = mask[t] > 0
        c[t] = np.where(live, new.sum(axis=1), 1)
        a[t] = np.where(live[:, None], new / c[t][:, None], a[t - 1])
    b, come = np.empty_like(x), np.zeros_like(x)  # come: what a step takes over from the one before it
    b[-1] = 1
    back = np.ascontiguousarray(jump.T)
    for t in range(steps - 1, 0, -1):
        come[t] = x[t] * b[t] * (mask[t] / c[t])[:, None]
        b[t - 1] = np.where(mask[t][:, None] > 0, come[t] @ back, b[t])
    tags = e.shape[2]
    pairs = jump * (a[:-1].reshape(-1, tags).T @ come[1:].reshape(-1, tags))
    log_z = first + (mask * (np.log(c) + top)).sum(axis=0)
    return a * b, pairs, log_z


def loss_and_gradients(p: dict, x: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
    """Mean negative log-likelihood of a window's tags and its gradients; x and tags are (steps, batch)."""
    e, mask, hidden, tape_f, tape_b = _emissions(p, x, keep=True)
    steps, batch = x.shape
    marginal, pairs, log_z = _forward_backward(p, e, mask)
    rows = np.arange(batch)
    at = np.arange(steps)[:, None]
    own = mask * e[at, rows[None, :], tags]
    own[1:] += mask[1:] * p["trans"][tags[:-1], tags[1:]]
    gold = p["start"][tags[0]] + own.sum(axis=0)
    d_e = marginal * mask[:, :, None]
    grads = {k: np.zeros_like(v) for k, v in p.items()}
    grads["start"] += d_e[0].sum(axis=0)
    np.subtract.at(grads["start"], tags[0], 1)
    grads["trans"] += pairs
    np.subtract.at(grads["trans"], (tags[:-1], tags[1:]), mask[1:])
    d_e[np.arange(steps)[:, None], rows[None, :], tags] -= mask
    d_e /= batch
    for k in ("start", "trans"):
        grads[k] /= batch
    grads["out"] = np.einsum("tbh,tbk->hk", hidden, d_e)
    grads["bias"] = d_e.sum(axis=(0, 1))
    d_hidden = d_e @ p["out"].T
    d_x = _lstm_back(p, "f", tape_f, d_hidden[:, :, :HIDDEN], mask, grads) + _lstm_back(p, "b", tape_b, d_hidden[:, :, HIDDEN:], mask, grads)
    np.add.at(grads["embed"], x, d_x)
    return float((log_z - gold).mean()), grads


def pad(rows: list[np.ndarray], steps: int) -> np.ndarray:
    out = np.zeros((len(rows), steps), dtype=np.int64)
    for b, r in enumerate(rows):
        out[b, : len(r)] = r
    return np.ascontiguousarray(out.T)


def train(windows: list[np.ndarray], tags: list[np.ndarray], steps: int, batch: int = 32, seed: int = 3, rate: float = 0.03) -> dict:
    """Parameters after `steps` of Adam over the labelled windows."""
    rng = np.random.default_rng(seed)
    p = initial(seed)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for k in range(1, steps + 1):
        chosen = rng.integers(0, len(windows), batch)
        longest = max(len(windows[i]) for i in chosen)
        _, grads = loss_and_gradients(p, pad([windows[i] for i in chosen], longest), pad([tags[i] for i in chosen], longest))
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
        now = rate * min(1.0, 5.0 / max(norm, 1e-9)) * (1 - 0.9 * k / steps)
        for name, g in grads.items():
            first[name] = 0.9 * first[name] + 0.1 * g
            second[name] = 0.999 * second[name] + 0.001 * g * g
            p[name] -= (now * (first[name] / (1 - 0.9**k)) / (np.sqrt(second[name] / (1 - 0.999**k)) + 1e-8)).astype(np.float32)
    return p


def scan(p: dict, x: np.ndarray) -> np.ndarray:
    """The emissions of _emissions() for codes x (steps, batch), as (steps, tags, batch), without what training needs.

    A gate is 1 / (1 + exp(-x)) and tanh is 2 / (1 + exp(-2x)) - 1, as numpy's exp of 32-bit floats costs half of its tanh;
    signs and factors are in the weights, and a gate's 1 + exp(-x) is divided by. An exp that overflows is a gate of 0 or a
    tanh of -1. A window is a column, so that each gate is one run of memory, and both directions go at once, from either end.
    The embedding has two more places: one is always 1, for the constants, and the other is 1 for padding, which closes the
    gates, so that no mask is needed.
    """
    steps, batch = x.shape
    factor = np.full(4 * HIDDEN, -1, np.float32)
    factor[3 * HIDDEN :] = -2
    rows = np.zeros((CODES, EMBED + 2), np.float32)
    rows[:, :EMBED], rows[:, EMBED], rows[0, EMBED + 1] = p["embed"], 1, 1
    shut = np.zeros((1, 4 * HIDDEN), np.float32)
    shut[:, : 2 * HIDDEN] = 120
    weights = [np.vstack([p[f"w{d}"][:EMBED] * factor, p[f"c{d}"] * factor, shut, p[f"w{d}"][EMBED:] * factor]).T.astype(np.float32, order="C") for d in "fb"]
    out = [np.ascontiguousarray(p["out"][at : at + HIDDEN].T, dtype=np.float32) for at in (0, HIDDEN)]
    table = np.ascontiguousarray(rows.T)
    looked = np.empty((steps, EMBED + 2, batch), np.float32)
    for t in range(steps):
        np.take(table, x[t], axis=1, out=looked[t], mode="clip")
    e = np.empty((steps, TAGS, batch), np.float32)
    e[:] = p["bias"][:, None]
    inputs = np.zeros((2, EMBED + 2 + HIDDEN, batch), np.float32)  # a character's places, then what the step before left
    z, c, more = np.empty((2, 4 * HIDDEN, batch), np.float32), np.zeros((2, HIDDEN, batch), np.float32), np.empty((TAGS, batch), np.float32)
    h = inputs[:, EMBED + 2 :]
    i, f, o, g = (z[:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
    with np.errstate(over="ignore"):
        for t in range(steps):
            for d, at in ((0, t), (1, steps - 1 - t)):
                inputs[d, : EMBED + 2] = looked[at]
                np.dot(weights[d], inputs[d], out=z[d])
            np.exp(z, out=z)
            z += 1
            np.divide(-4, g, out=g)
            g += 2
            g /= i
            c /= f  # c is -2 times the cell
            c += g
            np.exp(c, out=h)
            h += 1
            np.divide(2, h, out=h)
            h -= 1
            h /= o
            for d, at in ((0, t), (1, steps - 1 - t)):
                np.dot(out[d], h[d], out=more)
                e[at] += more
    return e


def hopeful(p: dict, e: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which windows may hold a span on their best path; e as scan() gives it.

    The best gain that any run of characters in spans can have over "no span" is bounded by taking at
    each character the best kind and the best transition, whether they fit together or not; only
    that a run begins as one is kept. Where no run has a positive bound, "no span" is the best path.
    """
    none = float(p["trans"][0, 0])
    any_step = max(0.0, float(p["trans"].max()) - none)
    begin_inside = float(max(p["trans"][0, 2::2].max() - none, p["start"][2::2].max() - p["start"][0]))
    first = max(0.0, float(p["start"][1::2].max() - p["start"][0]))
    begin = reduce(np.maximum, (e[:, k] for k in range(1, TAGS, 2))) - e[:, 0] + any_step
    inside = reduce(np.maximum, (e[:, k] for k in range(2, TAGS, 2))) - e[:, 0] + any_step
    begin[0] += first
    go_on, start = np.maximum(begin, inside), np.maximum(begin, inside + begin_inside)
    go_on[x == 0] = start[x == 0] = -1e30
    run, most = np.full(x.shape[1], -1e30, np.float32), np.full(x.shape[1], -1e30, np.float32)
    for t in range(len(x)):
        np.add(run, go_on[t], out=run)
        np.maximum(run, start[t], out=run)
        np.maximum(most, run, out=most)
    return np.flatnonzero(most + any_step >= 0)


def decode(p: dict, windows: list[np.ndarray], together: int = 1 << 18) -> list[list[tuple[int, int, int, float]]]:
    """Spans of each window by the best path: kind, start, end, and the least marginal on the span.

    Windows of like length should stand together; about `together` characters are scanned at a time.
    """
    found: list[list[tuple[int, int, int, float]]] = [[] for _ in windows]
    held: list[tuple[int, np.ndarray]] = []  # hopeful windows and their emissions
    size = 0

    def search() -> None:
        for first in range(0, len(held), 256):
            part = held[first : first + 256]
            x = pad([windows[k] for k, _ in part], max(len(e) for _, e in part))
            e = np.zeros((*x.shape, TAGS), np.float32)
            for b, (_, own) in enumerate(part):
                e[: len(own), b] = own
            for (k, _), spans in zip(part, _best_paths(p, e, x), strict=True):
                found[k] = spans
        held.clear()

    first = 0
    while first < len(windows):
        last = min(len(windows), first + 512)
        last = min(last, first + max(1, together // max(1, *map(len, windows[first:last]))))
        part = windows[first:last]
        x = pad(part, max(map(len, part)))
        e = scan(p, x)
        for k in hopeful(p, e, x).tolist():
            held.append((first + k, e[: len(part[k]), :, k].copy()))
            size += len(part[k])
        if size > 8 * together:
            search()
            size = 0
        first = last
    search()
    return found


def _best_paths(p: dict, e: np.ndarray, x: np.ndarray) -> list[list[tuple[int, int, int, float]]]:
    steps, batch = x.shape
    mask = (x > 0).astype(np.float32)
    best = p["start"] + e[0]
    back = np.zeros(e.shape, dtype=np.int64)
    back[:] = np.arange(TAGS)
    for t in range(1, steps):
        both = best[:, :, None] + p["trans"]
        live = mask[t][:, None] > 0
        back[t] = np.where(live, both.argmax(axis=1), np.arange(TAGS))
        best = np.where(live, both.max(axis=1) + e[t], best)
    rows = np.arange(batch)
    path = np.zeros((steps, batch), dtype=np.int64)
    path[-1] = best.argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        path[t - 1] = back[t, rows, path[t]]
    path *= x > 0
    found: list[list[tuple[int, int, int, float]]] = [[] for _ in range(batch)]
    held = np.flatnonzero(path.any(axis=0))
    if not len(held):
        return found
    e, mask, path = e[:, held], mask[:, held], path[:, held]
    marginal, _, _ = _forward_backward(p, e, mask)
    sure = marginal[np.arange(steps)[:, None], np.arange(len(held))[None, :], path]
    for b, k in enumerate(held.tolist()):
        spans, at = [], None
        for t in [*np.flatnonzero(path[:, b]).tolist(), steps]:
            tag = path[t, b] if t < steps else 0
            if at is not None and (t != at[2] or tag != 2 * at[0] + 2):
                spans.append((at[0], at[1], at[2], float(sure[at[1] : at[2], b].min())))
                at = None
            if tag % 2 == 1:
                at = ((tag - 1) // 2, t, t + 1)
            elif at is not None:
                at = (at[0], at[1], t + 1)
        found[k] = [(int(kind), int(a), int(b), c) for kind, a, b, c in spans]
    return found
