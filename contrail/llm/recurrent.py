"""A gated recurrent language model in numpy: class-factored output, truncated backpropagation.

Inputs and outputs are ids: explicit words first, by falling frequency and with the end mark among
them, then one id per tail class, which stands for all other words of that class.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Shape:
    """Sizes of the model. ``starts`` are the first ids of the output classes of explicit words and
    the number of these words; every tail class is an output class of its own."""

    starts: tuple[int, ...]
    tails: int
    hidden: int = 24

    @property
    def words(self) -> int:
        return self.starts[-1]

    @property
    def classes(self) -> int:
        return len(self.starts) - 1 + self.tails

    def parts(self) -> list[tuple[int, ...]]:
        h, inputs = self.hidden, self.words + self.tails
        return [
            (inputs, h), (h, 3 * h), (h, 3 * h), (3 * h,),
            (h, self.classes), (self.classes,), (self.words, h), (self.words,),
        ]

    def split(self, flat: np.ndarray) -> list[np.ndarray]:
        """Views of a flat vector: embeddings, input and recurrent weights, their bias, class
        weights and bias, word weights and bias."""
        out, at = [], 0
        for shape in self.parts():
            size = int(np.prod(shape))
            out.append(flat[at : at + size].reshape(shape))
            at += size
        return out

    @property
    def size(self) -> int:
        return sum(int(np.prod(p)) for p in self.parts())

    def class_of(self) -> np.ndarray:
        """Output class of every id."""
        widths = np.diff(self.starts)
        words = np.repeat(np.arange(len(widths)), widths)
        return np.append(words, len(widths) + np.arange(self.tails))


def class_starts(counts: np.ndarray, classes: int) -> tuple[int, ...]:
    """Cuts words of falling counts into classes of about equal mass of square-rooted counts."""
    mass = np.cumsum(np.sqrt(counts.astype(float)))
    cuts = np.searchsorted(mass, mass[-1] * np.arange(1, classes) / classes) + 1
    return tuple(dict.fromkeys([0, *cuts.tolist(), len(counts)]))


def first_weights(shape: Shape, counts: np.ndarray, seed: int) -> np.ndarray:
    """Small random weights; the biases give the unigram model of ``counts`` (one per id)."""
    rng = np.random.default_rng(seed)
    flat = rng.normal(0, 0.1, shape.size).astype(np.float32)
    parts = shape.split(flat)
    for k in (1, 2):
        parts[k] *= 10 / np.sqrt(shape.hidden)
    parts[3][:] = 0
    parts[3][: shape.hidden] = 1.0  # update gates begin by keeping
    by_class = np.bincount(shape.class_of(), counts, shape.classes)
    parts[5][:] = np.log(by_class + 1.0)
    parts[6][:] *= 0.1
    parts[7][:] = np.log(counts[: shape.words] + 0.5)
    return flat


_HALF = np.float32(0.5)


class _Spread:
    """Scratch room for one softmax over the classes and one over the words of each class.

    Rows are sorted by class, so a class is a slice. A row holds a state and a one; the last row of
    ``wc`` and the last column of ``wo`` are the biases. Exponentials are not divided by their sums:
    whoever needs probabilities scales the rows instead.
    """

    def __init__(self, shape: Shape):
        starts = np.array(shape.starts)
        self.hidden, self.starts, self.widths = shape.hidden, starts[:-1], np.diff(starts)
        kind = np.uint16 if shape.classes < 2**16 else np.int64
        self.class_of = shape.class_of().astype(kind)  # short ids are sorted by radix
        self.n = shape.classes
        self.ones = np.ones(max(self.n, int(self.widths.max())), np.float32)
        self.room = np.empty(0, np.float32)

    def sort(self, ids: np.ndarray) -> np.ndarray:
        """The order of ``ids`` by class, which the next call expects."""
        classes = self.class_of[ids]
        order = np.argsort(classes, kind="stable")
        self.classes, self.ids = classes[order], ids[order]
        per_class = np.bincount(classes, minlength=self.n)[: len(self.widths)]
        edges, sizes = np.cumsum(per_class), per_class * self.widths
        ends, live = np.cumsum(sizes), np.flatnonzero(per_class)
        self.explicit, self.size = int(edges[-1]), int(ends[-1])
        wide = self.classes[: self.explicit]
        first = (ends - sizes - (edges - per_class) * self.widths - self.starts)[wide]
        self.own = first + np.arange(self.explicit) * self.widths[wide] + self.ids[: self.explicit]
        if len(self.room) < self.size:
            self.room = np.empty(self.size * 5 // 4, np.float32)
        a, w = (edges - per_class)[live], self.widths[live]
        p, s = (ends - sizes)[live], self.starts[live]
        self.slices = [
            (slice(a0, b0), slice(s0, s0 + w0), self.room[p0 : p0 + (b0 - a0) * w0].reshape(b0 - a0, w0))
            for a0, b0, s0, w0, p0 in zip(a.tolist(), edges[live].tolist(), s.tolist(), w.tolist(), p.tolist())
        ]
        return order

    def over_classes(self, hs: np.ndarray, wc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Exponentials, their sums per row, and the logarithm of the own class's share; the
        positions of the own classes."""
        x = hs @ wc
        at = np.arange(len(hs)) * self.n + self.classes
        own = x.ravel()[at]
        top = x.max() if x.size else np.float32(0)
        if x.size and top - own.min() > 60:  # rows far apart: each by its own greatest entry
            top = x.max(1)
            x -= top[:, None]
        else:
            x -= top
        np.exp(x, out=x)
        sums = x @ self.ones[: self.n]
        return x, sums, own - top - np.log(sums), at

    def over_words(self, hs: np.ndarray, wo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for the words of the rows' classes, laid end to end; rows of tail classes have none."""
        for rows, columns, x in self.slices:
            np.matmul(hs[rows], wo[columns].T, out=x)
        x, sums = self.room[: self.size], np.empty(self.explicit, np.float32)
        own = x[self.own]
        top = x.max() if x.size else np.float32(0)
        if x.size and top - own.min() > 60:
            top = np.empty(self.explicit, np.float32)
            for rows, _, part in self.slices:
                top[rows] = part.max(1)
                part -= top[rows, None]
        else:
            x -= top
        np.exp(x, out=x)
        for rows, _, part in self.slices:
            np.matmul(part, self.ones[: part.shape[1]], out=sums[rows])
        return x, sums, own - top - np.log(sums)


def _packed(shape: Shape) -> tuple[np.ndarray, list[tuple[int, ...]]]:
    """Where the flat vector's entries go so that biases stand beside the weights of their softmax,
    and the shapes of the parts: embeddings, input and recurrent weights, their bias, class weights
    with a last row of biases, word weights with a last column of them."""
    emb, wx, u, b, wc, bc, wo, bo = shape.split(np.arange(shape.size))
    parts = [emb, wx, u, b, np.vstack([wc, bc]), np.column_stack([wo, bo])]
    return np.concatenate([p.ravel() for p in parts]), [p.shape for p in parts]


def _views(flat: np.ndarray, shapes: list[tuple[int, ...]]) -> list[np.ndarray]:
    ends = np.cumsum([int(np.prod(s)) for s in shapes])
    return [flat[e - int(np.prod(s)) : e].reshape(s) for e, s in zip(ends, shapes)]


def _halved(h_size: int) -> np.ndarray:
    """Factors of the three gates' columns: a sigmoid is made of the tanh of half its argument."""
    return np.repeat(np.array([0.5, 0.5, 1.0], np.float32), h_size)


def _blocks(x: np.ndarray, g: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Views for :func:`_step` of what input and state give to the gates of ``k`` units."""
    return x[: 2 * k], g[: 2 * k], x[:k], x[k : 2 * k], x[2 * k :], g, g[2 * k :]


def _step(blocks: tuple[np.ndarray, ...], u_t: np.ndarray, h: np.ndarray, out: np.ndarray, room: np.ndarray) -> None:
    """One step of all lanes, a column each: the input's part becomes the gates, ``out`` the new
    state. Input and weights are halved for the first two gates."""
    zr, g_zr, z, r, n, g, g_n = blocks
    np.matmul(u_t, h, out=g)
    zr += g_zr
    np.tanh(zr, out=zr)
    zr *= _HALF
    zr += _HALF
    np.multiply(r, g_n, out=room)
    n += room
    np.tanh(n, out=n)
    np.subtract(h, n, out=out)
    out *= z
    out += n


def score(flat: np.ndarray, shape: Shape, docs: list[np.ndarray], lanes: int = 192, window: int = 32) -> np.ndarray:
    """Natural log probability of every document's ids, from its first to its last.

    Documents are dealt to lanes, longest first; a lane runs through its documents window by window
    and carries its state on, back to zero only where a document begins.
    """
    where, shapes = _packed(shape)
    emb, wx, u, b, wc, wo = _views(flat[where], shapes)
    h_size, spread = shape.hidden, _Spread(shape)
    half = _halved(h_size)
    u_t, into = np.ascontiguousarray((u * half).T), np.ascontiguousarray(((emb @ wx + b) * half))
    fresh_x = (b * half)[:, None]
    lanes = max(1, min(lanes, len(docs)))
    order = sorted(range(len(docs)), key=lambda d: -len(docs[d]))
    lengths, dealt = np.zeros(lanes, np.int64), [[] for _ in range(lanes)]
    for d in order:
        lane = int(lengths.argmin())
        dealt[lane].append(d)
        lengths[lane] += len(docs[d])
    longest = np.argsort(-lengths, kind="stable")
    lengths, dealt = lengths[longest], [dealt[k] for k in longest]
    steps = int(lengths.max()) if len(docs) else 0
    # Column per lane, longest first: the ids, the document of each, and whether it is the first.
    targets, owner = np.zeros((steps, lanes), np.int32), np.full((steps, lanes), -1, np.int32)
    begins = np.zeros((steps, lanes), bool)
    for lane, own in enumerate(dealt):
        at = 0
        for d in own:
            n = len(docs[d])
            targets[at : at + n, lane], owner[at : at + n, lane] = docs[d], d
            begins[at, lane] = n > 0
            at += n
    totals, h = np.zeros(len(docs)), np.zeros((h_size, lanes), np.float32)
    for t0 in range(0, steps, window):
        t1 = min(t0 + window, steps)
        n_live = int((lengths > t0).sum())  # lanes that are not through
        before = np.zeros((t1 - t0, n_live), np.int32)
        before[1:] = targets[t0 : t1 - 1, :n_live]
        if t0:
            before[0] = targets[t0 - 1, :n_live]
        x = np.ascontiguousarray(np.take(into, before, 0).transpose(0, 2, 1))
        states = np.empty((t1 - t0, h_size, n_live), np.float32)
        fresh, h = begins[t0:t1, :n_live], np.ascontiguousarray(h[:, :n_live])
        clear = fresh.any(1)
        g, room = np.empty((3 * h_size, n_live), np.float32), np.empty((h_size, n_live), np.float32)
        for t in range(t1 - t0):
            if clear[t]:
                h = np.where(fresh[t], np.float32(0), h)
                x[t][:, fresh[t]] = fresh_x  # nothing comes before a first token
            _step(_blocks(x[t], g, h_size), u_t, h, states[t], room)
            h = states[t]
        live = owner[t0:t1, :n_live].ravel()
        used = np.flatnonzero(live >= 0)
        by_class = used[spread.sort(targets[t0:t1, :n_live].ravel()[used])]
        hs = np.ones((len(used), h_size + 1), np.float32)
        hs[:, :h_size] = np.take(states.transpose(0, 2, 1).reshape(-1, h_size), by_class, 0)
        logs = spread.over_classes(hs, wc)[2].astype(np.float64)
        logs[: spread.explicit] += spread.over_words(hs, wo)[2]
        totals += np.bincount(live[by_class], logs, len(docs))
    return totals


def learn(
    flat: np.ndarray,
    shape: Shape,
    docs: list[np.ndarray],
    memory: np.ndarray,
    rate: float,
    stride: int = 1,
    excerpt: int = 64,
    lanes: int = 128,
    window: int = 16,
) -> None:
    """One pass of truncated backpropagation over the documents, changing ``flat`` and AdaGrad's
    ``memory`` in place. The documents are laid end to end, and of every ``stride`` excerpts one is
    learned from; excerpts are spread evenly over all documents and cut into lanes. Gradients stop at
    the edge of a window. States are carried on over windows, and begin at zero with a document or an
    excerpt, whose first token is then read but not learned."""
    if not docs:
        return
    hs_ = shape.hidden
    stream = np.concatenate(docs)
    begins = np.zeros(len(stream), bool)
    begins[np.cumsum([0, *map(len, docs[:-1])])] = True
    before = np.append(0, stream[:-1]).astype(np.int32)
    if stride > 1:
        place = np.arange(len(stream))
        chosen = place // excerpt % stride == 0
        cut = chosen & (place % excerpt == 0) & ~begins
        stream = np.where(cut, -1, stream)[chosen]
        before, begins = before[chosen], (begins | cut)[chosen]
    lanes = max(1, min(lanes, len(stream) // window))
    steps = len(stream) // lanes
    if steps == 0:
        return
    left = len(stream) - steps * lanes  # fewer than one per lane; they lengthen the last window
    pad = (steps + (left > 0)) * lanes - len(stream)
    shaped = [
        np.append(a, np.full(pad, fill, a.dtype)).reshape(lanes, -1).T
        for a, fill in ((stream, -1), (before, 0), (begins, True))
    ]
    targets, before, begins = shaped
    where, shapes = _packed(shape)
    own, held = flat[where], memory[where]
    grad, room = np.empty_like(own), np.empty_like(own)
    emb, wx, u, b, wc, wo = _views(own, shapes)
    g_emb, g_wx, g_u, g_b, g_wc, g_wo = _views(grad, shapes)
    half, spread = _halved(hs_), _Spread(shape)
    entries = np.arange(emb.size).reshape(emb.shape)
    # A column per lane; blocks of gates one below the other, so that every block lies in one piece.
    x_all, g_all = np.empty((2, window, 3 * hs_, lanes), np.float32)
    blocks = [_blocks(x, g, hs_) for x, g in zip(x_all, g_all)]
    states = np.zeros((window + 1, hs_, lanes), np.float32)
    inputs = np.ones((window, hs_ + 1, lanes), np.float32)
    dg_all = np.empty((window, 3, hs_, lanes), np.float32)
    small, carried = np.empty((2, hs_, lanes), np.float32)
    for t0 in range(0, len(targets), window):
        y, x_ids, new = targets[t0 : t0 + window], before[t0 : t0 + window], begins[t0 : t0 + window]
        steps = len(y)
        clear, known = new.any(1), ~new
        x, gates = x_all[:steps], g_all[:steps]
        e = np.take(emb, x_ids, 0)
        e[new] = 0
        inputs[:steps, :hs_] = e.transpose(0, 2, 1)
        u_t = np.ascontiguousarray((u * half).T)
        np.matmul(np.ascontiguousarray((np.vstack([wx, b]) * half).T), inputs[:steps], out=x)
        cleared = {}
        for t in range(steps):
            h = states[t]
            if clear[t]:
                h = cleared[t] = h * known[t]
            _step(blocks[t], u_t, h, states[t + 1], small)
        # The states before the steps, those of beginnings cleared, and after them, uncleared.
        prior = states[:steps].copy()
        for t, h in cleared.items():
            prior[t] = h
        y = y.ravel()
        used = np.flatnonzero(y >= 0)
        at = used[spread.sort(y[used])]
        hs = np.ones((len(at), hs_ + 1), np.float32)
        hs[:, :hs_] = np.take(states[1 : steps + 1].transpose(0, 2, 1).reshape(-1, hs_), at, 0)
        share = np.float32(1 / max(len(at), 1))
        d, sums, _, own_class = spread.over_classes(hs, wc)
        d.ravel()[own_class] -= sums
        per = share / sums[:, None]
        np.matmul((hs * per).T, d, out=g_wc)
        dh_used = d @ wc[:hs_].T
        dh_used *= per
        g_wo[:] = 0
        d, sums, _ = spread.over_words(hs, wo)
        d[spread.own] -= sums
        per, weights = share / sums[:, None], wo[:, :hs_]
        scaled, by_words = hs[: len(sums)] * per, np.empty((len(sums), hs_), np.float32)
        for rows, columns, part in spread.slices:
            np.matmul(part.T, scaled[rows], out=g_wo[columns])
            np.matmul(part, weights[columns], out=by_words[rows])
        by_words *= per
        dh_used[: len(sums)] += by_words
        dh = np.zeros((steps * lanes, hs_), np.float32)
        dh[at] = dh_used
        dh = np.ascontiguousarray(dh.reshape(steps, lanes, hs_).transpose(0, 2, 1))
        z, r, n = x[:, :hs_], x[:, hs_ : 2 * hs_], x[:, 2 * hs_ :]
        # What a state's gradient is multiplied by to become that of each block of gates.
        dg, new_part = dg_all[:steps], 1 - z
        of_z, of_r, of_n = dg[:, 0], dg[:, 1], dg[:, 2]
        np.subtract(prior, n, out=of_z)
        of_z *= z
        of_z *= new_part
        np.multiply(n, n, out=n)
        n *= new_part
        new_part -= n
        np.multiply(new_part, r, out=of_n)
        np.multiply(of_n, gates[:, 2 * hs_ :], out=of_r)
        of_r *= np.subtract(1, r, out=r)
        carried[:] = 0
        for t in range(steps - 1, -1, -1):
            dh_t, dg_t = dh[t], dg[t]
            dh_t += carried
            dg_t *= dh_t
            np.matmul(u, dg_t.reshape(3 * hs_, lanes), out=carried)
            np.multiply(dh_t, z[t], out=small)
            carried += small
            if clear[t]:
                carried *= known[t]
        dx = dg.reshape(steps, 3 * hs_, lanes)
        g_u[:] = np.matmul(dx, prior.transpose(0, 2, 1)).sum(0).T
        np.multiply(new_part, dh, out=of_n)
        np.sum(dx.sum(0), 1, out=g_b)
        g_wx[:] = np.matmul(dx, e).sum(0).T
        de = np.matmul(dx.transpose(0, 2, 1), wx.T)
        de[new] = 0
        places = np.take(entries, x_ids.ravel(), 0).ravel()
        g_emb[:] = np.bincount(places, de.ravel(), emb.size).reshape(emb.shape)
        norm = float(np.sqrt(grad @ grad))
        if norm > 1:
            grad /= norm
        np.multiply(grad, grad, out=room)
        held += room
        np.sqrt(held, out=room)
        np.divide(grad, room, out=room)
        room *= rate
        own -= room
        states[0] = states[steps]
    flat[where], memory[where] = own, held
