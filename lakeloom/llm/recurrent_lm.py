"""A gated recurrent language model in numpy, over words.

Words of the learned vocabulary have numbers; other words stand for their shape
(ending, length, alphabet). The output is factored: a softmax over classes (of
vocabulary words by frequency, and one class of all shapes), then one over the members
of the class; a word outside the vocabulary takes its add-one share of its shape's
training tokens. Training is truncated back-propagation over windows of text streams;
scoring carries the state from window to window, so a text's probability covers all
of it.

Functions take their sizes from the parameters, so a small model works as well.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Classes of vocabulary words, members of each class, shapes (one class more), size of the state.
CLASSES, PER_CLASS, SHAPES, HIDDEN = 64, 64, 64, 24
VOCABULARY = CLASSES * PER_CLASS
START = VOCABULARY + SHAPES  # what stands before the first word

#: Rows of which scores are taken at once (they fit a core's cache), and rows gathered before that.
BLOCK, GATHERED = 2048, 32_768

#: Weights that are updated at once.
PIECE = 16_384

_NEVER = -1e9

#: Where gates are cut before their exponentials, which end at 88: they are 0 or 1 in 32 bits long before.
MOST = np.float32(80.0)

#: How far under its bound a row's greatest score may lie before the row is searched for it (32-bit exponentials end at -87).
SPAN = 60.0


def _planes(x: np.ndarray) -> np.ndarray:
    """(rows, 3n) of the gates as (3, rows, n), each gate's rows side by side, and scaled so that _step() has their exponentials."""
    n = x.shape[1] // 3
    out = np.ascontiguousarray(x.reshape(len(x), 3, n).transpose(1, 0, 2))
    out[:2] *= -1
    out[2] *= 2
    return out


def _taken(inputs: np.ndarray, words: np.ndarray) -> np.ndarray:
    """(3, words, n): the inputs of words, from planes."""
    out = np.empty((3, *words.shape, inputs.shape[2]), inputs.dtype)
    for of, to in zip(inputs, out):
        np.take(of, words, axis=0, out=to, mode="clip")
    return out


def _shifted(weight: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Biases (..., members) less what no score exceeds, as states lie within -1 and 1; and whether every row's greatest stays over -SPAN.

    Where it does, exponentials neither overflow nor all vanish, and rows need not be
    searched for their greatest score.
    """
    reach = np.abs(weight).sum(-2)
    most = (bias + reach).max(-1, keepdims=True)
    return bias - most, ((bias - reach).max(-1) - most[..., 0] > -SPAN)


def _exponentials(x: np.ndarray, near: bool) -> np.ndarray:
    """In place, over the row's greatest unless that is near; the sums of rows."""
    if not near:
        x -= x.max(1, keepdims=True)
    np.exp(x, out=x)
    return x @ np.ones(x.shape[1], x.dtype)


def _log_share(h: np.ndarray, weight: np.ndarray, bias: np.ndarray, near: bool, pick: np.ndarray) -> np.ndarray:
    """Log of the softmax at pick, row by row, in blocks; bias and near as _shifted() gives them."""
    out = np.empty(len(h), h.dtype)
    for i in range(0, len(h), BLOCK):
        x = h[i : i + BLOCK] @ weight
        x += bias
        rows, want = np.arange(len(x)), pick[i : i + BLOCK]
        if not near:
            x -= x.max(1, keepdims=True)
        got = x[rows, want]
        np.exp(x, out=x)
        out[i : i + BLOCK] = got - np.log(x @ np.ones(x.shape[1], x.dtype))
    return out


@dataclass
class Model:
    """The parameters; p has e (inputs), u, b (gates), c, cb (classes), w, wb (members)."""

    p: dict[str, np.ndarray] = field(default_factory=dict)


def new_model(word_counts: np.ndarray, shape_counts: np.ndarray, seed: int = 11) -> Model:
    """A model whose biases give the unigram distribution; word_counts by falling count."""
    rng = np.random.default_rng(seed)
    words = np.zeros(VOCABULARY)
    words[: len(word_counts)] = word_counts
    by_class = np.vstack([words.reshape(CLASSES, PER_CLASS), shape_counts.reshape(1, SHAPES) + 1.0])
    mass = by_class.sum(1)
    log = lambda x: np.where(x > 0, np.log(np.maximum(x, 1e-9)), _NEVER)
    small = lambda *shape: (rng.standard_normal(shape) * 0.08).astype(np.float32)
    p = {
        "e": small(START + 1, 3 * HIDDEN),
        "u": small(HIDDEN, 3 * HIDDEN),
        "b": np.zeros(3 * HIDDEN, np.float32),
        "c": small(HIDDEN, CLASSES + 1),
        "cb": log(mass / mass.sum()),
        "w": small(CLASSES + 1, HIDDEN, PER_CLASS),
        "wb": log(by_class / np.maximum(by_class.sum(1, keepdims=True), 1e-9)),
    }
    return Model({k: v.astype(np.float32) for k, v in p.items()})


def _step(u: np.ndarray, x: np.ndarray, h: np.ndarray, out: np.ndarray) -> tuple:
    """The next state, into out, from x (inputs with bias, in planes as u) and state h; and what the way back needs."""
    g = np.matmul(h, u)
    zr = x[:2] + g[:2]
    np.minimum(zr, MOST, out=zr)
    np.exp(zr, out=zr)
    zr += 1
    np.reciprocal(zr, out=zr)
    z, r = zr
    c = r * g[2]
    c += x[2]
    np.minimum(c, MOST, out=c)
    np.exp(c, out=c)
    c += 1
    np.divide(-2, c, out=c)
    c += 1
    np.subtract(h, c, out=out)
    out *= z
    out += c
    return z, r, c, g[2]  # the last is doubled, as u is


def _by_class(target: np.ndarray, per: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of words by class, and each class with its first and last place in it."""
    kind = (target // per).astype(np.int16)
    order = np.argsort(kind, kind="stable")
    ranked = kind[order]
    cut = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(order) else np.zeros(0, np.int64)
    return order, list(zip(ranked[cut].tolist(), cut.tolist(), np.append(cut[1:], len(order)).tolist()))


def _log_probabilities(p: dict, h: np.ndarray, target: np.ndarray, shifted: tuple) -> np.ndarray:
    """Natural log of class times member probability, for states h and the words that follow; shifted: those of classes and members."""
    per = p["wb"].shape[1]
    (cb, c_near), (wb, w_near) = shifted
    out = _log_share(h, p["c"], cb, bool(c_near), target // per)
    order, cuts = _by_class(target, per)
    rows, pick, more = h[order], (target % per)[order], np.empty_like(out)
    for k, i, j in cuts:
        more[i:j] = _log_share(rows[i:j], p["w"][k], wb[k], bool(w_near[k]), pick[i:j])
    out[order] += more
    return out


class Trainer:
    """Truncated back-propagation with Adam; the state stays from one group of texts to the next."""

    def __init__(self, model: Model):
        self.p = {k: v.copy() for k, v in model.p.items()}
        self.m1, self.m2 = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        self.updates = 0

    def run(self, texts: list[np.ndarray], lanes: int, window: int, first: float, last: float) -> None:
        """One pass over the texts, laid out as lanes of one stream each; the rate goes from first to last."""
        start = len(self.p["e"]) - 1
        flow = np.concatenate(texts)
        prev = np.concatenate([np.append(start, t[:-1]) for t in texts if len(t)])
        width = min(lanes, max(1, len(flow) // window))
        steps = -(-len(flow) // width)
        # the last lanes may be a word short: padded words have no weight
        real = np.arange(width * steps) < len(flow)
        flow, prev = (np.append(x, np.full(width * steps - len(x), start)) for x in (flow, prev))
        flow, prev, real = (np.ascontiguousarray(x.reshape(width, steps).T) for x in (np.where(real, flow, 0), prev, real))
        h = np.zeros((width, len(self.p["u"])), self.p["u"].dtype)
        for t0 in range(0, steps, window):
            cut = slice(t0, t0 + window)
            grad, h = gradients(self.p, flow[cut], prev[cut], real[cut], h)
            self._update(grad, first + (last - first) * t0 / steps)

    def _update(self, grad: dict[str, np.ndarray], speed: float) -> None:
        clip = np.float32(min(1.0, 1.0 / (np.sqrt(sum(float(np.vdot(g, g)) for g in grad.values())) + 1e-9)))
        self.updates += 1
        one, two = np.float32(speed / (1 - 0.9**self.updates)), np.float32(1 / (1 - 0.99**self.updates))
        for k in grad:
            whole = [x.reshape(-1) for x in (self.p[k], np.ascontiguousarray(grad[k]), self.m1[k], self.m2[k])]
            for i in range(0, whole[0].size, PIECE):
                p, g, m1, m2 = (x[i : i + PIECE] for x in whole)
                g *= clip
                m1 *= np.float32(0.9)
                m1 += np.float32(0.1) * g
                m2 *= np.float32(0.99)
                g *= g
                g *= np.float32(0.01)
                m2 += g
                np.multiply(m2, two, out=g)
                np.sqrt(g, out=g)
                g += np.float32(1e-6)
                np.divide(m1, g, out=g)
                g *= one
                p -= g


def gradients(p: dict[str, np.ndarray], tgt: np.ndarray, inp: np.ndarray, real: np.ndarray, h: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of the mean negative log probability of a window (steps by lanes), and the state after it.

    h is taken as given: errors go back to the window's start and no further. Words
    that are not real have no weight; a lane starts anew where its input is START.
    """
    n, kind, width, per = len(p["u"]), p["u"].dtype, tgt.shape[1], p["wb"].shape[1]
    u, x = _planes(p["u"]), _taken(_planes(p["e"] + p["b"]), inp)
    starts = inp == len(p["e"]) - 1
    fresh = starts.any(1)
    held, hs = [], np.empty((len(tgt) + 1, width, n), kind)
    hs[0] = h
    for t in range(len(tgt)):
        before = hs[t] * ~starts[t][:, None] if fresh[t] else hs[t]
        held.append((before, *_step(u, x[:, t], before, hs[t + 1])))
    flat, want = hs[1:].reshape(-1, n), tgt.reshape(-1)
    weight = (real.reshape(-1) / max(1, int(real.sum()))).astype(kind)

    def error(scores: np.ndarray, near: bool, pick: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Scores to the gradient of their loss, in place."""
        scores *= (share / _exponentials(scores, near))[:, None]
        scores[np.arange(len(scores)), pick] -= share
        return scores

    (cb, c_near), (wb, w_near) = _shifted(p["c"], p["cb"]), _shifted(p["w"], p["wb"])
    grad, dh = {k: np.zeros_like(p[k]) for k in ("c", "cb", "w", "wb")}, np.empty_like(flat)
    ct, kinds = np.ascontiguousarray(p["c"].T), want // per
    for i in range(0, len(flat), BLOCK):
        rows = flat[i : i + BLOCK]
        d = rows @ p["c"]
        d += cb
        d = error(d, bool(c_near), kinds[i : i + BLOCK], weight[i : i + BLOCK])
        grad["c"] += rows.T @ d
        grad["cb"] += d.sum(0)
        np.matmul(d, ct, out=dh[i : i + BLOCK])
    order, cuts = _by_class(want, per)
    rows, pick, share, more = flat[order], (want % per)[order], weight[order], np.empty_like(flat)
    for k, i, j in cuts:
        q = rows[i:j] @ p["w"][k]
        q += wb[k]
        q = error(q, bool(w_near[k]), pick[i:j], share[i:j])
        np.matmul(rows[i:j].T, q, out=grad["w"][k])
        np.sum(q, axis=0, out=grad["wb"][k])
        np.matmul(q, p["w"][k].T, out=more[i:j])
    dh[order] += more
    dh = dh.reshape(len(tgt), width, n)
    carry = np.zeros((width, n), kind)
    # the errors of c, z, r and of what r lets through to c: inputs take the first three, the state the last three
    back = np.empty((len(tgt), width, 4 * n), kind)
    ut = np.ascontiguousarray(p["u"].T)
    for t in range(len(tgt) - 1, -1, -1):
        before, z, r, c, gc = held[t]
        g = dh[t] + carry
        gz = g * z
        dc = c * c
        np.subtract(1, dc, out=dc)
        dc *= g - gz
        back[t, :, :n] = dc
        dz = before - c
        dz *= gz
        dz *= 1 - z
        back[t, :, n : 2 * n] = dz
        dc *= r
        back[t, :, 3 * n :] = dc
        dc *= gc
        dc *= np.subtract(1, r) * np.float32(0.5)
        back[t, :, 2 * n : 3 * n] = dc
        carry = back[t, :, n:] @ ut
        carry += gz
        if fresh[t]:
            carry[starts[t]] = 0
    back = back.reshape(-1, 4 * n)
    grad["u"] = np.concatenate([one[0] for one in held]).T @ back[:, n:]
    word = inp.reshape(-1)
    order = np.argsort(word.astype(np.int16) if len(p["e"]) <= 1 << 15 else word, kind="stable")
    ranked = word[order]
    lead = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    grad["e"] = np.zeros_like(p["e"])
    sums = np.roll(np.add.reduceat(back[:, : 3 * n][order], lead, axis=0), -n, axis=1)
    grad["e"][ranked[lead]], grad["b"] = sums, sums.sum(0)
    return grad, hs[-1]


def packed(model: Model) -> np.ndarray:
    """All weights in one row."""
    return np.concatenate([model.p[k].reshape(-1) for k in sorted(model.p)])


def unpacked(row: np.ndarray, like: Model) -> Model:
    """The model whose packed() row is, shaped as like."""
    keys = sorted(like.p)
    cuts = np.split(row, np.cumsum([like.p[k].size for k in keys])[:-1])
    return Model({k: v.reshape(like.p[k].shape).astype(np.float32) for k, v in zip(keys, cuts)})


def log10_likelihood(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Log10 of class and member probabilities of each text; all texts advance together.

    The state goes on from window to window; a window has about GATHERED states, whose
    scores are taken together.
    """
    p = model.p
    n, start = len(p["u"]), len(p["e"]) - 1
    shifted = _shifted(p["c"], p["cb"]), _shifted(p["w"], p["wb"])
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = np.array([len(texts[i]) for i in order], np.int64)
    out = np.zeros(len(texts))
    base = np.concatenate([[0], np.cumsum(lengths)])
    flow = np.concatenate([texts[i] for i in order]) if len(texts) else np.zeros(0, np.int64)
    u, inputs = _planes(p["u"]), _planes(p["e"] + p["b"])
    live = np.searchsorted(-lengths, -np.arange(int(lengths.max(initial=0))), "left")  # texts longer than t
    # words step by step, after what stands before each text; a step's words follow at[t]
    at = np.concatenate([[0], np.cumsum(live)])
    lane = np.repeat(np.arange(len(order)), lengths)
    words = np.full(len(texts) + len(flow), start)
    words[len(texts) + at[np.arange(len(flow)) - base[lane]] + lane] = flow
    before = np.concatenate([[0], len(texts) + at[:-1]])
    h = np.zeros((len(texts), n), p["u"].dtype)
    t0 = 0
    while t0 < len(live):
        t1 = max(t0 + 1, min(len(live), int(np.searchsorted(at, at[t0] + GATHERED))))
        a, b, many = at[t0], at[t1], live[t0:t1]
        lane = np.arange(a, b) - np.repeat(at[t0:t1], many)
        x = _taken(inputs, words[np.repeat(before[t0:t1], many) + lane])
        hs = np.empty((b - a, n), h.dtype)
        for i, m in zip((at[t0:t1] - a).tolist(), many.tolist()):
            _step(u, x[:, i : i + m], h[:m], hs[i : i + m])
            h = hs[i : i + m]
        sums = np.bincount(lane, weights=_log_probabilities(p, hs, words[len(texts) + a : len(texts) + b], shifted))
        out[: len(sums)] += sums
        t0 = t1
    back = np.zeros(len(texts))
    back[order] = out / np.log(10)
    return back
