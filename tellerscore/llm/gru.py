"""A gated recurrent language model in numpy, with a class-factored output and truncated backpropagation.

Tokens and states are time-major; inside a window, the lanes come last, so that gates are whole rows. A token's
probability is that of its class times that of the token within the class, both softmax functions of the state
before it. The last row of each weight matrix is its bias. Token 0 stands for every token outside the
vocabulary, token 1 for the end of a document, which also comes before its first token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

OUTSIDE, END = 0, 1
Params = dict[str, np.ndarray]


def initial(counts: np.ndarray, hidden: int, per_class: int, seed: int = 3) -> Params:
    """Random weights, and output biases that start at the tokens' frequencies.

    ``counts`` has one number per token; classes take ``per_class`` tokens in this order.
    """
    rng = np.random.default_rng(seed)
    tokens = len(counts)
    classes = -(-tokens // per_class)
    freq = np.zeros(classes * per_class)
    freq[:tokens] = counts + 0.5
    freq = freq.reshape(classes, per_class)
    with np.errstate(divide="ignore"):
        within = np.where(freq > 0, np.log(freq / freq.sum(axis=1, keepdims=True)), -1e9)
    normal = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
    with_bias = lambda weights, bias: np.concatenate([weights, bias[..., None, :]], axis=-2, dtype=np.float32)
    return {
        "inputs": normal(0.1, tokens, 3 * hidden),
        "recurrent": with_bias(normal(1 / np.sqrt(hidden), hidden, 3 * hidden), np.zeros(3 * hidden)),
        "class_out": with_bias(normal(0.01, hidden, classes), np.log(freq.sum(axis=1) / freq.sum())),
        "token_out": with_bias(normal(0.01, classes, hidden, per_class), within),
    }


def states(p: Params, tokens: np.ndarray, state: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
    """States after each of ``tokens`` (time, batch), and what backpropagation needs of all steps."""
    (steps, lanes), hidden = tokens.shape, state.shape[1]
    gated = 2 * hidden
    kind = np.result_type(state, p["recurrent"])
    # A sigmoid is (1 + tanh(x / 2)) / 2.
    halves = np.repeat(np.array([0.5, 1], dtype=kind), [gated, hidden])[:, None]
    recurrent = np.ascontiguousarray(p["recurrent"].T) * halves
    from_input = np.take(p["inputs"], tokens, axis=0).transpose(0, 2, 1) * halves
    found = np.empty((steps + 1, hidden + 1, lanes), dtype=kind)
    found[:, hidden], found[0, :hidden] = 1, state.T
    parts = np.empty((steps if keep else 1, 3 * hidden, lanes), dtype=kind)
    news = np.empty((len(parts), hidden, lanes), dtype=kind)
    for t in range(steps):
        at = t if keep else 0
        part, given, new = parts[at], from_input[t], news[at]
        np.matmul(recurrent, found[t], out=part)
        gates = part[:gated]
        gates += given[:gated]
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        np.multiply(gates[hidden:], part[gated:], out=new)
        new += given[gated:]
        np.tanh(new, out=new)
        after = np.subtract(found[t, :hidden], new, out=found[t + 1, :hidden])
        after *= gates[:hidden]
        after += new
    return np.ascontiguousarray(found[1:, :hidden].transpose(0, 2, 1)), (found, parts, news)


def _log_softmax(logits: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log softmax at one place per row, exponentials, and their sums by row, from one evaluation of the exponential.

    A product is several times as fast as a sum over short rows. Only logits whose exponentials leave the
    range of numbers are shifted.
    """
    places = np.arange(0, logits.size, logits.shape[1]) + at
    ones = np.ones(logits.shape[1], dtype=logits.dtype)
    wanted = logits.take(places)
    with np.errstate(over="ignore"):
        found = np.exp(logits)
    sums = found @ ones
    if not (sums.min(initial=1) > 1e-30 and sums.max(initial=1) < 1e30):
        logits -= logits.max(axis=1, keepdims=True)
        wanted = logits.take(places)
        np.exp(logits, out=found)
        sums = found @ ones
    return wanted - np.log(sums), found, sums


def _gradient(logits: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log softmax at one place per row, and the gradient of minus their mean."""
    out, found, sums = _log_softmax(logits, at)
    scale = found.dtype.type(1 / max(len(at), 1))
    found *= (scale / sums)[:, None]
    found.reshape(-1)[np.arange(0, found.size, found.shape[1]) + at] -= scale
    return out, found


def _log_of(h: np.ndarray, weights: np.ndarray, at: np.ndarray, rows: int = 2048) -> np.ndarray:
    """Log softmax at one place per row, a cache's worth of rows at a time."""
    out = np.empty(len(h), dtype=h.dtype)
    for start in range(0, len(h), rows):
        stop = start + rows
        out[start:stop] = _log_softmax(h[start:stop] @ weights, at[start:stop])[0]
    return out


class _Classes:
    """Products of rows, in the order of their classes, with their classes' matrices.

    Classes of many rows are multiplied one by one; the others have a block of few rows each, and the products of
    all blocks are one call.
    """

    FEW = 16

    def __init__(self, cls: np.ndarray):
        sizes = np.bincount(cls)
        ends = np.cumsum(sizes)
        self.many = [(c, ends[c] - sizes[c], ends[c]) for c in np.flatnonzero(sizes > self.FEW).tolist()]
        self.few = np.flatnonzero((sizes > 0) & (sizes <= self.FEW))
        sizes, ends = sizes[self.few], ends[self.few]
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.rows = np.repeat(ends - sizes, sizes) + within
        self.places = np.repeat(np.arange(len(sizes)) * self.FEW, sizes) + within

    def dealt(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.few) * self.FEW, rows.shape[1]), dtype=rows.dtype)
        out[self.places] = rows[self.rows]
        return out.reshape(len(self.few), self.FEW, rows.shape[1])

    def gathered(self, blocks: np.ndarray, into: np.ndarray) -> None:
        into[self.rows] = blocks.reshape(-1, blocks.shape[2])[self.places]


def log_probs(p: Params, state: np.ndarray, targets: np.ndarray, grads: Params | None = None):
    """Natural log probabilities of ``targets`` (n) after ``state`` (n, hidden).

    With ``grads``, the gradients of minus their mean are added to it, and that of the states is returned too.
    """
    weights, per_class, hidden = p["token_out"], p["token_out"].shape[2], state.shape[1]
    cls = targets // per_class
    # Everything below is in the order of the classes.
    order = np.argsort(cls.astype(np.int16) if len(weights) < 1 << 15 else cls, kind="stable")
    cls, at = cls[order], targets[order] % per_class
    h = np.ones((len(order), hidden + 1), dtype=np.result_type(state, weights))
    h[:, :hidden] = state[order]
    found = np.empty(len(order), dtype=h.dtype)
    if grads is None:
        in_class = np.empty_like(found)
        ends = np.cumsum(np.bincount(cls)).tolist()
        for c, (start, stop) in enumerate(zip([0, *ends], ends)):
            if start < stop:
                in_class[start:stop] = _log_of(h[start:stop], weights[c], at[start:stop])
        found[order] = in_class + _log_of(h, p["class_out"], cls)
        return found
    of_class, d = _gradient(h @ p["class_out"], cls)
    grads["class_out"] += h.T @ d
    d_h = d @ p["class_out"][:hidden].T
    classes = _Classes(cls)
    logits = np.empty((len(h), per_class), dtype=h.dtype)
    for c, start, stop in classes.many:
        np.matmul(h[start:stop], weights[c], out=logits[start:stop])
    h_dealt, own = classes.dealt(h), weights[classes.few]
    classes.gathered(h_dealt @ own, logits)
    in_class, d = _gradient(logits, at)
    into, more = grads["token_out"], np.empty_like(d_h)
    for c, start, stop in classes.many:
        into[c] += h[start:stop].T @ d[start:stop]
        np.matmul(d[start:stop], weights[c, :hidden].T, out=more[start:stop])
    d_dealt = classes.dealt(d)
    into[classes.few] += h_dealt.transpose(0, 2, 1) @ d_dealt
    classes.gathered(d_dealt @ own[:, :hidden].transpose(0, 2, 1), more)
    d_h += more
    d_state = np.empty_like(d_h)
    d_state[order], found[order] = d_h, of_class + in_class
    return found, d_state


def _backward(p: Params, tokens: np.ndarray, kept: tuple, d_states: np.ndarray, grads: Params) -> None:
    """Gradients of the recurrent part over one window; nothing flows to the window before."""
    steps, lanes, hidden = d_states.shape
    found, parts, new = kept
    update, reset, candidate = (parts[:, i * hidden : (i + 1) * hidden] for i in range(3))
    rest = 1 - update
    # What each step's gradient is multiplied with; only the recurrence itself goes step by step.
    through = np.empty((steps, 4, hidden, lanes), dtype=parts.dtype)
    of_update, of_reset, of_new, through[:, 3] = *(through[:, i] for i in range(3)), update
    np.subtract(found[:-1, :hidden], new, out=of_update)
    of_update *= update
    of_update *= rest
    by_new = rest
    by_new -= by_new * new * new
    np.multiply(by_new, reset, out=of_new)
    np.subtract(1, reset, out=of_reset)
    of_reset *= candidate
    of_reset *= of_new
    back = np.concatenate([p["recurrent"][:hidden], np.eye(hidden, dtype=parts.dtype)], axis=1)
    d_total = d_states.transpose(0, 2, 1).astype(parts.dtype, order="C")
    d_all = np.empty_like(through)
    flat_all = d_all.reshape(steps, -1, lanes)
    for t in range(steps - 1, -1, -1):
        np.multiply(d_total[t], through[t], out=d_all[t])
        if t:
            d_total[t - 1] += back @ flat_all[t]
    flat_all = flat_all[:, : 3 * hidden]
    lanes_last = lambda of: of.transpose(1, 0, 2).reshape(of.shape[1], -1)
    grads["recurrent"] += lanes_last(found[:-1]) @ lanes_last(flat_all).T
    np.multiply(d_total, by_new, out=d_all[:, 2])
    rows = flat_all.transpose(0, 2, 1).reshape(-1, 3 * hidden)
    flat = tokens.ravel()
    order = np.argsort(flat.astype(np.int16) if len(p["inputs"]) < 1 << 15 else flat, kind="stable")
    flat = flat[order]
    starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    grads["inputs"][flat[starts]] += np.add.reduceat(rows.take(order, axis=0), starts, axis=0)


def _windows(
    ids: list[np.ndarray], batch: int, window: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents side by side, longest first, cut into windows; a lane whose document ended takes the next one.

    Gives the lanes' documents, (time, lanes) inputs and targets, the lanes of the window before that are left,
    and which lanes start a document here. Targets of -1 are padding.
    """
    if not ids:
        return
    lengths = np.array([len(i) for i in ids])
    order = np.argsort(-lengths, kind="stable")
    flat_ids = np.concatenate([ids[r] for r in order])
    ends = np.cumsum(lengths[order])
    firsts = ends - lengths[order]
    flat_inputs = np.concatenate([[END], flat_ids[:-1]]).astype(flat_ids.dtype)
    flat_inputs[firsts] = END
    docs = np.arange(min(batch, len(ids)))
    following, at = len(docs), firsts[docs]
    left, starts = docs, np.ones(len(docs), dtype=bool)
    while len(docs):
        stop = ends[docs]
        rest = stop - at
        place = at + np.arange(min(window, rest.max()))[:, None]
        if rest.min() >= len(place):
            targets, inputs = flat_ids[place], flat_inputs[place]
        else:
            real = place < stop
            where = np.minimum(place, len(flat_ids) - 1)
            targets, inputs = np.where(real, flat_ids[where], -1), np.where(real, flat_inputs[where], END)
        yield order[docs], inputs, targets, left, starts
        at = at + window
        free = np.nonzero(at >= stop)[0]
        taken, idle = np.split(free, [min(len(free), len(ids) - following)])
        docs = docs.copy()
        docs[taken] = np.arange(following, following + len(taken))
        at[taken] = firsts[docs[taken]]
        following += len(taken)
        starts = np.zeros(len(docs), dtype=bool)
        starts[taken] = True
        left = np.arange(len(docs))
        if len(idle):
            left = np.delete(left, idle)
            docs, at, starts = docs[left], at[left], starts[left]


def _carried(state: np.ndarray, left: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The states that a window begins with."""
    state = state[left]
    state[starts] = 0
    return state


def _real(targets: np.ndarray) -> np.ndarray | slice:
    """Where targets are no padding, among the flattened ones."""
    real = targets.ravel() >= 0
    return slice(None) if real.all() else real


def score(
    p: Params, ids: list[np.ndarray], batch: int = 512, window: int = 32, gathered: int = 1 << 15
) -> np.ndarray:
    """Natural log probability of each document; the state is carried from window to window.

    The outputs of several windows are evaluated together, about ``gathered`` tokens at a time.
    """
    hidden = len(p["recurrent"]) - 1
    out = np.zeros(len(ids))
    waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held = 0

    def evaluate() -> None:
        rows, after, targets = (np.concatenate(part) for part in zip(*waiting))
        np.add.at(out, rows, log_probs(p, after, targets).astype(np.float64))
        waiting.clear()

    state = np.zeros((batch, hidden), dtype=np.float32)
    for rows, inputs, targets, left, starts in _windows(ids, batch, window):
        after, _ = states(p, inputs, _carried(state, left, starts))
        state = after[-1]
        real = _real(targets)
        waiting.append((np.tile(rows, len(targets))[real], after.reshape(-1, hidden)[real], targets.ravel()[real]))
        held += len(waiting[-1][0])
        if held >= gathered:
            evaluate()
            held = 0
    if waiting:
        evaluate()
    return out


class Trainer:
    """Adam over truncated backpropagation; the state is carried, gradients stop at the window's start.

    Input rows and outputs of classes that a window does not meet have no gradient: they rest, and their
    moments' decay is made up when they are met again.
    """

    DENSE, BY_TOKEN, BY_CLASS = ("recurrent", "class_out"), ("inputs",), ("token_out",)

    def __init__(self, params: Params, rate: float):
        self.p = {k: v.copy() for k, v in params.items()}
        self.grads, self.mean, self.square = ({k: np.zeros_like(v) for k, v in params.items()} for _ in range(3))
        self.met = {k: np.zeros(len(params[k]), dtype=np.int64) for k in (*self.BY_TOKEN, *self.BY_CLASS)}
        self.rate, self.steps, self.tokens = rate, 0, 0

    def learn(self, ids: list[np.ndarray], batch: int = 64, window: int = 16) -> None:
        hidden, per_class = len(self.p["recurrent"]) - 1, self.p["token_out"].shape[2]
        state = np.zeros((batch, hidden), dtype=np.float32)
        for _, inputs, targets, left, starts in _windows(ids, batch, window):
            after, kept = states(self.p, inputs, _carried(state, left, starts), keep=True)
            state, after = after[-1], after.reshape(-1, hidden)
            real = _real(targets)
            wanted = targets.ravel()[real]
            d_states = np.zeros_like(after)
            _, d_states[real] = log_probs(self.p, after[real], wanted, self.grads)
            d_states = d_states.reshape(*targets.shape, hidden)
            _backward(self.p, inputs, kept, d_states, self.grads)
            self._update(_met(inputs.ravel()), _met(wanted // per_class))
            self.tokens += len(wanted)

    def _update(self, tokens: np.ndarray, classes: np.ndarray) -> None:
        self.steps += 1
        rate = np.float32(self.rate * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps))
        for name in self.DENSE:
            _move(self.p[name], self.grads[name], self.mean[name], self.square[name], np.float32(1), rate)
        for names, rows in ((self.BY_TOKEN, tokens), (self.BY_CLASS, classes)):
            for name in names:
                self._step(name, rows, rate)

    def _step(self, name: str, rows: np.ndarray, rate: np.float32) -> None:
        """Move ``rows`` of a parameter, which rested for some steps, and clear their gradient.

        Where they are most of its rows, the others stay in place too, unmoved.
        """
        met, parts = self.met[name], (self.p[name], self.grads[name], self.mean[name], self.square[name])
        rested = (self.steps - met[rows]).astype(np.float32)
        met[rows] = self.steps
        if 2 * len(rows) > len(met):
            rests, rates = np.zeros((2, len(met), 1), dtype=np.float32)
            rests[rows, 0], rates[rows] = rested, rate
            _move(*(part.reshape(len(met), -1) for part in parts), rests, rates)
            return
        own = [part.take(rows, axis=0) for part in parts]
        _move(*own, rested.reshape(-1, *[1] * (own[0].ndim - 1)), rate)
        for part, moved in zip(parts, own):
            part[rows] = moved


def _met(numbers: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.bincount(numbers))


def _move(p: np.ndarray, g: np.ndarray, mean: np.ndarray, square: np.ndarray, rested, rate) -> None:
    """A step of Adam in place, which leaves the gradient empty.

    The moments are kept ten and a hundred times as large as usual, which saves two products.
    """
    mean *= np.float32(0.9) ** rested
    mean += g
    g *= g
    square *= np.float32(0.99) ** rested
    square += g
    np.sqrt(square, out=g)
    g += np.float32(1e-5)
    np.divide(mean, g, out=g)
    g *= rate
    p -= g
    g[...] = 0


def flat(p: Params) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def views(values: np.ndarray, like: Params) -> Params:
    """The parts of ``values`` in the shapes of ``like``, without copying."""
    out, at = {}, 0
    for k in sorted(like):
        out[k] = values[at : at + like[k].size].reshape(like[k].shape)
        at += like[k].size
    return out


def shaped(values: np.ndarray, like: Params) -> Params:
    return {k: v.astype(np.float32) for k, v in views(values, like).items()}
