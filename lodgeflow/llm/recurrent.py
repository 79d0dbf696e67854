"""A gated recurrent language model in numpy: class-factored softmax, truncated
backpropagation, state carried across windows. Texts run side by side in lanes. Scores
do not depend on it, so there a lane takes the next text when its own has ended;
training takes a group of like length at a time."""

from __future__ import annotations

import numpy as np

Parameters = dict[str, np.ndarray]


class Layout:
    """Symbols in descending order of count, cut into classes of like weight
    (square roots of counts), so that a softmax is over classes and then over the
    symbols of one class."""

    def __init__(self, counts: np.ndarray, classes: int):
        self.counts = np.maximum(np.asarray(counts, float), 1.0)
        share = np.cumsum(np.sqrt(self.counts)) / np.sqrt(self.counts).sum()
        label = np.minimum((share * classes).astype(int), classes - 1)
        label = np.unique(label, return_inverse=True)[1]
        self.of = label.astype(np.int64)
        self.first = np.concatenate([np.flatnonzero(np.diff(label, prepend=-1)), [len(label)]])
        self.classes = len(self.first) - 1


def start(layout: Layout, hidden: int, seed: int = 5) -> Parameters:
    """Small random weights; biases of the softmax are the log counts."""
    rng = np.random.default_rng(seed)
    v, c = len(layout.counts), layout.classes
    small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    per_class = np.add.reduceat(layout.counts, layout.first[:-1])
    return {
        "g": small(v, 3 * hidden), "u": small(hidden, 3 * hidden),
        "cw": small(hidden, c), "cb": np.log(per_class / per_class.sum()).astype(np.float32),
        "ow": small(hidden, v), "ob": np.log(layout.counts / per_class[layout.of]).astype(np.float32),
    }


class _Space:
    """Arrays that one window after another is worked out in, by name."""

    def __init__(self):
        self.flat: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int, kind=np.float32) -> np.ndarray:
        size = int(np.prod(shape))
        if name not in self.flat or self.flat[name].size < size or self.flat[name].dtype != kind:
            self.flat[name] = np.empty(size, kind)
        return self.flat[name][:size].reshape(shape)


def _unroll(p: Parameters, h: np.ndarray, inputs: np.ndarray, space: _Space, keep: bool = True):
    """The steps of a window (time x batch) from state h: states (one more than there are
    steps), update gates, reset gates and the recurrent parts of candidates in one array
    (time x 3 x batch), candidates; without keep only the states."""
    (steps, batch), k, kind = inputs.shape, h.shape[1], h.dtype
    u = p["u"].reshape(k, 3, k).transpose(1, 0, 2) * np.array([-1, -1, 1], kind)[:, None, None]
    states = space("states", steps + 1, batch, k, kind=kind)
    kept = steps if keep else 1
    parts, candidates = space("parts", kept, 3, batch, k, kind=kind), space("candidates", kept, batch, k, kind=kind)
    x = space("x", batch, 3 * k, kind=kind)
    own = x.reshape(batch, 3, k).transpose(1, 0, 2)
    states[0] = h
    with np.errstate(over="ignore"):  # a gate of 1 / (1 + inf) is closed
        for t in range(steps):
            h, new, part, n = states[t], states[t + 1], parts[t % kept], candidates[t % kept]
            np.take(p["g"], inputs[t], axis=0, out=x, mode="clip")
            np.matmul(h, u, out=part)
            gates = part[:2]
            gates -= own[:2]
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            np.multiply(part[1], part[2], out=n)
            n += own[2]
            np.tanh(n, out=n)
            np.subtract(h, n, out=new)
            new *= part[0]
            new += n
    return states, parts, candidates


def _step(p: Parameters, h: np.ndarray, symbols: np.ndarray):
    """One step for a batch: (new state, update gate, reset gate, candidate, its recurrent part)."""
    states, parts, n = _unroll(p, h, symbols[None, :], _Space())
    return states[1], parts[0, 0], parts[0, 1], n[0], parts[0, 2]


#: Exponentials of logits up to this size are far from overflow and from vanishing.
SAFE = 60.0


class _Softmax:
    """Logits of a batch, cut into rows that begin at starts, as exponentials. Rows are
    lowered by their maximum only if a logit is too large to do without."""

    def __init__(self, logits: np.ndarray, starts: np.ndarray, widths: np.ndarray, at: np.ndarray):
        if logits.size and not (logits.max() < SAFE and logits.min() > -SAFE):
            logits -= np.repeat(np.maximum.reduceat(logits, starts), widths)
        self.target = starts + at
        own = logits[self.target]
        self.values = np.exp(logits, out=logits)
        self.sums = np.add.reduceat(self.values, starts) if len(starts) else own
        self.logs = own - np.log(self.sums)

    def less_targets(self) -> np.ndarray:
        """Sums times the gradients of the loss by the logits."""
        self.values[self.target] -= self.sums
        return self.values


class _Output:
    """States and their targets in the order of the targets' classes."""

    def __init__(self, p: Parameters, layout: Layout, states: np.ndarray, targets: np.ndarray, space: _Space):
        kind, label, n, c = states.dtype, layout.of[targets], len(targets), layout.classes
        self.space = space
        self.order = np.argsort(label.astype(np.uint16) if c < 65536 else label, kind="stable")
        label, targets = label[self.order], targets[self.order]
        self.rows = space("rows", n, states.shape[1] + 1, kind=kind)  # a column of ones for the biases
        self.rows[:, :-1] = states[self.order]
        self.rows[:, -1] = 1
        self.class_weights = np.vstack([p["cw"], p["cb"]])
        self.weights = np.concatenate([p["ow"], p["ob"][None, :]], out=space("weights", *self._shape(p), kind=kind))
        logits = np.matmul(self.rows, self.class_weights, out=space("classes", n, c, kind=kind))
        self.of_class = _Softmax(logits.reshape(-1), np.arange(n) * c, np.full(n, c), label)
        widths = np.diff(layout.first)[label]
        ends = np.cumsum(widths)
        edges = np.searchsorted(label, np.arange(c + 1)).tolist()
        logits = space("inside", int(widths.sum()), kind=kind)
        self.parts, first, begin = [], layout.first.tolist(), 0  # rows of a class, its symbols, its logits
        for a, b, lo, hi in zip(edges, edges[1:], first, first[1:]):
            if a < b:
                size = (b - a) * (hi - lo)
                block = logits[begin:begin + size].reshape(b - a, hi - lo)
                begin += size
                np.matmul(self.rows[a:b], self.weights[:, lo:hi], out=block)
                self.parts.append((a, b, lo, hi, block))
        self.in_class = _Softmax(logits, ends - widths, widths, targets - layout.first[label])

    @staticmethod
    def _shape(p: Parameters) -> tuple[int, int]:
        return p["ow"].shape[0] + 1, p["ow"].shape[1]

    def logs(self) -> np.ndarray:
        """Natural logs of the targets' probabilities, in the order given."""
        out = np.empty(len(self.order))
        out[self.order] = self.of_class.logs.astype(float) + self.in_class.logs
        return out

    def gradients(self, scale: float) -> tuple[Parameters, np.ndarray]:
        """Of the loss times scale: by the weights, and by the states in sorted order."""
        kind, shape = self.rows.dtype, self.rows.shape
        share = (scale / self.of_class.sums).astype(kind)[:, None]
        scaled = np.multiply(self.rows, share, out=self.space("scaled", *shape, kind=kind))
        d = self.of_class.less_targets().reshape(len(self.rows), -1)
        by_class = scaled.T @ d
        ds = np.matmul(d, self.class_weights[:-1].T, out=self.space("by state", shape[0], shape[1] - 1, kind=kind))
        ds *= share
        share = (scale / self.in_class.sums).astype(kind)[:, None]
        self.in_class.less_targets()
        np.multiply(self.rows, share, out=scaled)
        inside = self.space("by state inside", *ds.shape, kind=kind)
        by_symbol, weights = self.space("by symbol", *self.weights.shape, kind=kind), self.weights[:-1]
        by_symbol[:] = 0
        for a, b, lo, hi, d in self.parts:
            by_symbol[:, lo:hi] = scaled[a:b].T @ d
            np.matmul(d, weights[:, lo:hi].T, out=inside[a:b])
        inside *= share
        ds += inside
        return {"cw": by_class[:-1], "cb": by_class[-1], "ow": by_symbol[:-1], "ob": by_symbol[-1]}, ds


def log_probabilities(p: Parameters, layout: Layout, states: np.ndarray, targets: np.ndarray,
                      space: _Space | None = None) -> np.ndarray:
    """Natural log of the probability of each target symbol after each state."""
    return _Output(p, layout, states, targets, space or _Space()).logs()


def _windows(texts: list[np.ndarray], lanes: int, window: int):
    """Texts dealt to lanes, the longest first; a lane takes its next text at the window
    after the end of its last one. Per window: the lanes' texts, which of the lanes
    before go on (they come first), symbols and their use (time x lanes)."""
    lengths = np.array([len(t) for t in texts], np.int64)
    symbols = np.concatenate([*texts, np.zeros(1, np.int64)])
    starts = np.cumsum(lengths) - lengths
    waiting = np.argsort(-lengths, kind="stable")[:np.count_nonzero(lengths)]
    own, at = waiting[:0], np.zeros(0, np.int64)
    while True:
        on = np.flatnonzero(at < lengths[own])
        fresh, waiting = np.split(waiting, [lanes - len(on)])
        own, at = np.concatenate([own[on], fresh]), np.concatenate([at[on], np.zeros(len(fresh), np.int64)])
        if not len(own):
            return
        left = np.minimum(lengths[own] - at, window)
        time = np.arange(left.max())[:, None]
        used = time < left
        yield own, on, np.take(symbols, (starts[own] + at + time) * used) * used, used
        at += window


def _go_on(h: np.ndarray, before: np.ndarray, on: np.ndarray, lanes: int, first: int):
    """States and last symbols of the lanes that go on, and those of fresh ones."""
    states, symbols = np.zeros((lanes, h.shape[1]), h.dtype), np.full(lanes, first, np.int64)
    states[:len(on)], symbols[:len(on)] = h[on], before[on]
    return states, symbols


def score(p: Parameters, layout: Layout, texts: list[np.ndarray], first: int, window: int = 32,
          batch: int = 96) -> np.ndarray:
    """Natural log probability of each whole symbol sequence. Sequences run side by
    side; their state goes on from window to window."""
    total, space = np.zeros(len(texts)), _Space()
    h, before = np.zeros((0, p["u"].shape[0]), np.float32), np.zeros(0, np.int64)
    for own, on, block, used in _windows(texts, batch, window):
        h, before = _go_on(h, before, on, len(own), first)
        # every state has read the symbols before its target
        states = _unroll(p, h, np.vstack([before[None, :], block[:-1]]), space, keep=False)[0]
        h, before = states[-1], block[-1]
        t_at, k_at = np.nonzero(used)
        logs = log_probabilities(p, layout, states[1:][t_at, k_at], block[t_at, k_at], space)
        total[own] += np.bincount(k_at, logs, len(own))
    return total


class _Seen:
    """The symbols of a window and the places of each."""

    FEW = 12  # rows of a symbol that are added along with those of other symbols

    def __init__(self, symbols: np.ndarray, known: int):
        flat = symbols.ravel()
        self.order = np.argsort(flat.astype(np.uint16) if known <= 65536 else flat, kind="stable")
        flat = flat[self.order]
        self.begin = np.flatnonzero(np.diff(flat, prepend=-1))
        self.rows = flat[self.begin]

    def sums(self, x: np.ndarray) -> np.ndarray:
        """Rows of x summed by symbol: the first, second, ... row of all symbols that have
        one, and the rest of the frequent ones at once."""
        times = np.diff(self.begin, append=len(self.order))
        by_times = np.argsort(-times, kind="stable")
        times, begin = times[by_times], self.begin[by_times]
        out = x[self.order[begin]]
        for n in range(1, self.FEW):
            some = int(np.searchsorted(-times, -n))  # with more than n rows
            if not some:
                break
            out[:some] += x[self.order[begin[:some] + n]]
        for i in range(int(np.searchsorted(-times, -self.FEW))):
            out[i] += x[self.order[begin[i] + self.FEW:begin[i] + times[i]]].sum(axis=0)
        back = np.empty_like(by_times)
        back[by_times] = np.arange(len(by_times))
        return out[back]


def _back(p: Parameters, layout: Layout, h: np.ndarray, inputs: np.ndarray, targets: np.ndarray,
          used: np.ndarray, seen: _Seen, space: _Space) -> tuple[Parameters, np.ndarray, float]:
    """As gradients, with "g" for the rows of the seen symbols only."""
    (steps, batch), k, kind = inputs.shape, h.shape[1], h.dtype
    states, parts, n = _unroll(p, h, inputs, space)
    at = np.flatnonzero(used.ravel())
    out = _Output(p, layout, states[1:].reshape(-1, k)[at], targets.ravel()[at], space)
    loss = -float(out.logs().sum())
    grad, ds = out.gradients(1 / max(1, len(at)))
    into, whole = space("into", steps * batch, k, kind=kind), (steps, batch, k)
    into[:] = 0
    into[at[out.order]] = ds
    into = into.reshape(whole)
    # what a state's gradient is multiplied by on its way to gates and candidates
    z, r, inner, before = parts[:, 0], parts[:, 1], parts[:, 2], states[:-1]
    to_n, to_z, to_r = (space(name, *whole, kind=kind) for name in ("to n", "to z", "to r"))
    spare = space("spare", *whole, kind=kind)
    np.subtract(1, z, out=to_n)
    np.subtract(before, n, out=to_z)
    to_z *= z
    to_z *= to_n
    np.multiply(n, n, out=spare)
    np.subtract(1, spare, out=spare)
    to_n *= spare
    np.subtract(1, r, out=to_r)
    to_r *= r
    to_r *= inner
    dn, da = space("dn", *whole, kind=kind), space("da", steps, batch, 3 * k, kind=kind)
    dh, through, back = np.zeros((batch, k), kind), np.empty((batch, k), kind), p["u"].T.copy()
    for t in range(steps - 1, -1, -1):
        d, a = dn[t], da[t]
        dh += into[t]
        np.multiply(dh, to_n[t], out=d)
        np.multiply(dh, to_z[t], out=a[:, :k])
        np.multiply(d, to_r[t], out=a[:, k:2 * k])
        np.multiply(d, r[t], out=a[:, 2 * k:])
        np.matmul(a, back, out=through)
        dh *= z[t]
        dh += through
    grad["u"] = before.reshape(-1, k).T @ da.reshape(-1, 3 * k)
    da[..., 2 * k:] = dn
    grad["g"] = seen.sums(da.reshape(-1, 3 * k))
    return grad, states[-1], loss


def gradients(p: Parameters, layout: Layout, h: np.ndarray, inputs: np.ndarray, targets: np.ndarray,
              used: np.ndarray) -> tuple[Parameters, np.ndarray, float]:
    """Back through one window (time x batch) that starts in state h: gradients of the
    mean loss over used places, last state, summed loss."""
    seen = _Seen(inputs, len(p["g"]))
    grad, h, loss = _back(p, layout, h, inputs, targets, used, seen, _Space())
    rows, grad["g"] = grad["g"], np.zeros_like(p["g"])
    grad["g"][seen.rows] = rows
    return grad, h, loss


class Adam:
    """Symbols that a window does not read have no gradient, but the steps that their
    fading means still call for. These are summed as one factor a symbol and made
    when the symbol is next read (``settle``), so a step costs by what the window
    reads, not by the vocabulary."""

    MEAN, SQUARE, LEAST, BLOCK = 0.9, 0.999, 1e-7, 16384

    def __init__(self, p: Parameters, rate: float):
        self.rate, self.t = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}
        self.pace = np.zeros_like(p["g"])  # mean over root at the last own step
        self.late = np.zeros_like(p["g"])  # by how much it falls as LEAST gains on the fading root
        rows = len(p["g"])
        self.age, self.fade, self.gain = np.zeros(rows), np.ones(rows), np.ones(rows)
        self.owed, self.less = np.zeros(rows), np.zeros(rows)  # factors of pace and late

    def settle(self, p: Parameters, rows=slice(None)) -> None:
        """Makes the steps these symbols are owed."""
        kind = self.pace.dtype
        p["g"][rows] -= (self.pace[rows] * self.owed[rows].astype(kind)[:, None]
                         - self.late[rows] * self.less[rows].astype(kind)[:, None])
        self.owed[rows], self.less[rows] = 0, 0

    def _root(self, m: np.ndarray, v: np.ndarray, g: np.ndarray, x: np.ndarray, shrink: float) -> np.ndarray:
        """Adds the gradient to m and v, which have faded already."""
        np.multiply(g, shrink * (1 - self.MEAN), out=x)
        m += x
        np.multiply(x, x, out=x)
        x *= (1 - self.SQUARE) / (1 - self.MEAN) ** 2
        v += x
        np.sqrt(v, out=x)
        x += self.LEAST
        return x

    def apply(self, p: Parameters, grad: Parameters, rows: np.ndarray, clip: float = 1.0) -> None:
        """grad["g"] is of these symbols' rows, which are settled."""
        norm = float(np.sqrt(sum(float(np.vdot(g, g)) for g in grad.values())))
        shrink = min(1.0, clip / (norm + 1e-9))
        self.t += 1
        fix = float(self.rate * np.sqrt(1 - self.SQUARE ** self.t) / (1 - self.MEAN ** self.t))
        spare = np.empty(self.BLOCK, p["u"].dtype)
        for k, g in grad.items():
            if k == "g":
                continue
            flat = [a.reshape(-1) for a in (self.m[k], self.v[k], g, p[k])]
            for at in range(0, flat[0].size, self.BLOCK):  # blocks that stay in the cache
                m, v, g, w = (a[at:at + self.BLOCK] for a in flat)
                m *= self.MEAN
                v *= self.SQUARE
                x = self._root(m, v, g, spare[:len(m)], shrink)
                np.divide(m, x, out=x)
                x *= fix
                w -= x
        self.age += 1
        self.fade *= self.MEAN / np.sqrt(self.SQUARE)
        self.gain /= np.sqrt(self.SQUARE)
        self.owed += fix * self.fade
        self.less += fix * self.fade * (self.gain - 1)
        age, kind = self.age[rows], self.pace.dtype
        m = self.m["g"][rows] * (self.MEAN ** age).astype(kind)[:, None]
        v = self.v["g"][rows] * (self.SQUARE ** age).astype(kind)[:, None]
        root = self._root(m, v, grad["g"], np.empty_like(m), shrink)
        pace = m / root
        self.m["g"][rows], self.v["g"][rows], self.pace[rows] = m, v, pace
        np.divide(self.LEAST, root, out=root)
        root *= pace
        self.late[rows] = root
        pace *= fix
        p["g"][rows] -= pace
        self.age[rows], self.fade[rows], self.gain[rows] = 0, 1, 1
        self.owed[rows], self.less[rows] = 0, 0


def train(p: Parameters, layout: Layout, texts: list[np.ndarray], first: int, optimiser: Adam,
          window: int = 24, batch: int = 96) -> tuple[float, int]:
    """One pass over the texts with truncated backpropagation; (loss, symbols)."""
    loss, symbols, space = 0.0, 0, _Space()
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    for at in range(0, len(order), batch):
        h, before = np.zeros((0, p["u"].shape[0]), np.float32), np.zeros(0, np.int64)
        for _, on, block, used in _windows([texts[i] for i in order[at:at + batch]], batch, window):
            h, before = _go_on(h, before, on, block.shape[1], first)
            inputs = np.vstack([before[None, :], block[:-1]])
            seen = _Seen(inputs, len(p["g"]))
            optimiser.settle(p, seen.rows)
            grad, h, lost = _back(p, layout, h, inputs, block, used, seen, space)
            optimiser.apply(p, grad, seen.rows)
            before = block[-1]
            loss, symbols = loss + lost, symbols + int(used.sum())
    optimiser.settle(p)
    return loss, symbols
