"""A gated recurrent network with a class-factored output, in numpy: forward, truncated backpropagation, streams."""

from __future__ import annotations

import heapq
import io
from dataclasses import dataclass

import numpy as np

F32 = np.float32


@dataclass(frozen=True)
class Shape:
    """words: numbers 0 .. words-1, in classes of ``per_class`` in that order; then ``tails`` classes of one number each."""

    words: int
    tails: int
    per_class: int = 36
    hidden: int = 24

    @property
    def word_classes(self) -> int:
        return -(-self.words // self.per_class)

    @property
    def classes(self) -> int:
        return self.word_classes + self.tails

    @property
    def numbers(self) -> int:
        return self.words + self.tails

    @property
    def begin(self) -> int:
        """The number that is read before a document's first token; it is never predicted."""
        return self.numbers

    def class_of(self, numbers: np.ndarray) -> np.ndarray:
        return np.where(numbers < self.words, numbers // self.per_class, numbers - self.words + self.word_classes)


Net = dict[str, np.ndarray]


def fresh(shape: Shape, counts: np.ndarray, seed: int) -> Net:
    """A network that starts as the unigram model of ``counts`` (of each number), split into class and word."""
    rng, h = np.random.default_rng(seed), shape.hidden
    mass = counts.astype(np.float64) + 1
    classes = np.bincount(shape.class_of(np.arange(shape.numbers)), mass, shape.classes)
    return {
        "read": rng.normal(0, 0.3, (shape.numbers + 1, 3 * h)).astype(F32),
        "turn": (rng.normal(0, 1 / np.sqrt(h), (h, 3 * h))).astype(F32),
        "class_w": np.zeros((h, shape.classes), F32),
        "class_b": np.log(classes / classes.sum()).astype(F32),
        "word_w": np.zeros((shape.words, h), F32),
        "word_b": np.log(mass[: shape.words]).astype(F32),
    }


def packed(net: Net) -> bytes:
    out = io.BytesIO()
    np.savez(out, **net)
    return out.getvalue()


def unpacked(blob: bytes) -> Net:
    with np.load(io.BytesIO(blob)) as saved:
        return {k: saved[k] for k in saved.files}


@dataclass
class _Laid:
    """A network's arrays as the steps use them, made from a ``Net`` and written back to it.

    read: (number, gates side by side); turn: (gate, hidden, hidden); kind: (hidden + 1, classes); word: (class, hidden + 1,
    word). A bias is the last of hidden + 1, read by a state of one. Places without a word in the last class have a bias
    that leaves them no probability.
    """

    read: np.ndarray
    turn: np.ndarray
    kind: np.ndarray
    word: np.ndarray

    @classmethod
    def of(cls, net: Net, shape: Shape, spare: tuple[float, float] = (0.0, -1e4)) -> _Laid:
        h = shape.hidden
        word = np.empty((shape.word_classes * shape.per_class, h + 1), net["word_w"].dtype)
        word[shape.words :, :h], word[shape.words :, h] = spare
        word[: shape.words, :h], word[: shape.words, h] = net["word_w"], net["word_b"]
        return cls(
            net["read"],
            np.ascontiguousarray(net["turn"].reshape(h, 3, h).transpose(1, 0, 2)),
            np.concatenate([net["class_w"], net["class_b"][None]]),
            np.ascontiguousarray(word.reshape(shape.word_classes, shape.per_class, h + 1).transpose(0, 2, 1)),
        )

    def back_to(self, net: Net, shape: Shape) -> None:
        h, word = shape.hidden, self.word.transpose(0, 2, 1).reshape(-1, shape.hidden + 1)
        net["turn"][:] = self.turn.transpose(1, 0, 2).reshape(h, 3 * h)
        net["class_w"][:], net["class_b"][:] = self.kind[:h], self.kind[h]
        net["word_w"][:], net["word_b"][:] = word[: shape.words, :h], word[: shape.words, h]


@dataclass
class _Steps:
    """What backpropagation needs of a window, each (steps, nets, streams, hidden); ``before`` less ``new`` is ``apart``."""

    before: np.ndarray
    gates: np.ndarray  # (2, ...): reset, update
    new: np.ndarray
    turned: np.ndarray  # (3, ...): the state before, times ``turn``
    apart: np.ndarray


def advance(nets: list[_Laid], read: np.ndarray, state: np.ndarray, restarts: np.ndarray, shared: bool) -> tuple[np.ndarray, _Steps]:
    """States after each step of a window. read: (steps, nets, streams) numbers; a stream restarts where ``restarts`` holds.

    ``shared``: every step writes over what the one before it left in the second result, for which nobody asks.
    """
    (steps, count, width), h = read.shape, state.shape[-1]
    half, kept = F32(0.5), 1 if shared else steps
    x = np.empty((3, steps, count, width, h), F32)
    for i, net in enumerate(nets):
        rows = net.read.take(read[:, i].ravel(), axis=0).reshape(steps, width, 3, h).transpose(2, 0, 1, 3)
        np.multiply(rows[:2], half, out=x[:2, :, i])  # a sigmoid is half of one plus tanh of the half
        x[2, :, i] = rows[2]
    turn = np.stack([net.turn for net in nets], axis=1)
    turn[:2] *= half
    states = np.empty((steps, *state.shape), F32)
    before, new, apart = (np.empty((kept, *state.shape), F32) for _ in range(3))
    gates, turned = np.empty((2, kept, *state.shape), F32), np.empty((3, kept, *state.shape), F32)
    some = restarts.any(axis=(1, 2)).tolist()
    for t in range(steps):
        k = 0 if shared else t
        old, fresh_, u, g, apart_ = before[k], new[k], turned[:, k], gates[:, k], apart[k]
        old[:] = state
        if some[t]:
            old[restarts[t]] = 0
        np.matmul(old, turn, out=u)
        np.add(x[:2, t], u[:2], out=g)
        np.tanh(g, out=g)
        g *= half
        g += half
        np.multiply(g[0], u[2], out=fresh_)
        fresh_ += x[2, t]
        np.tanh(fresh_, out=fresh_)
        np.subtract(old, fresh_, out=apart_)
        state = states[t]
        np.multiply(apart_, g[1], out=state)
        state += fresh_
    return states, _Steps(before, gates, new, turned, apart)


def _bounded(weights: np.ndarray, most: float = 80.0) -> bool:
    """Whether no state, whose values are within one, can make the softmax of (..., hidden + 1, words) leave the floats."""
    reach, bias = np.ones(weights.shape[-2] - 1, weights.dtype) @ np.abs(weights[..., :-1, :]), weights[..., -1, :]
    return bool((bias + reach).max() < most and (bias - reach).max(axis=-1).min() > -most)


def _exp(logits: np.ndarray, bounded: bool) -> np.ndarray | float:
    """Leaves in place of the logits their exp, less their largest unless ``bounded``; returns what was taken off."""
    top = 0.0 if bounded else logits.max(axis=-1)
    if not bounded:
        logits -= top[..., None]
    np.exp(logits, out=logits)
    return top


def _slopes(logits: np.ndarray, bounded: bool, rows: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Leaves in place of the logits the gradient of -log softmax at the targets of ``rows``; others have none."""
    _exp(logits, bounded)
    scale = 1 / (logits @ np.ones(logits.shape[-1], logits.dtype))
    if scale.size > len(rows):
        kept = np.zeros(scale.size, scale.dtype)
        kept[rows] = scale.reshape(-1)[rows]
        scale = kept.reshape(scale.shape)
    logits *= scale[..., None]
    logits.reshape(-1)[rows * logits.shape[-1] + targets] -= 1
    return logits


@dataclass
class _Sorted:
    """Places of a window's targets in the order of their classes; ``spans``: (class, start, stop) of those with words."""

    order: np.ndarray
    classes: np.ndarray
    within: np.ndarray  # of targets that are words: which one of their class
    spans: list[tuple[int, int, int]]

    @classmethod
    def of(cls, shape: Shape, targets: np.ndarray) -> _Sorted:
        classes = shape.class_of(np.arange(shape.numbers)).astype(np.int16 if shape.classes < 2**15 else np.int64)[targets]
        order = np.argsort(classes, kind="stable")
        classes = classes[order]
        cuts = np.searchsorted(classes, np.arange(shape.word_classes + 1, dtype=classes.dtype)).tolist()
        spans = [(c, a, b) for c, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
        words = cuts[-1]
        return cls(order, classes, targets[order[:words]] % shape.per_class, spans)

    def states(self, states: np.ndarray) -> np.ndarray:
        """States (place, hidden) in the order of the classes, with a one for the bias; behind them one that is all zeros."""
        out = np.empty((len(self.order) + 1, states.shape[1] + 1), states.dtype)
        out[:-1, :-1], out[:-1, -1], out[-1] = states.take(self.order, axis=0), 1, 0
        return out


def predict(laid: _Laid, shape: Shape, states: np.ndarray, targets: np.ndarray, bounded: tuple[bool, bool]) -> np.ndarray:
    """Log-probability of each target: that of its class, plus that of the word among its class's words."""
    at = _Sorted.of(shape, targets)
    s = at.states(states)[:-1]
    words = np.empty((len(at.within), shape.per_class), s.dtype)
    for c, start, stop in at.spans:
        np.matmul(s[start:stop], laid.word[c], out=words[start:stop])
    found = np.zeros(len(targets))
    for logits, own, safe in ((s @ laid.kind, at.classes, bounded[0]), (words, at.within, bounded[1])):
        picked = logits.reshape(-1)[np.arange(len(own)) * logits.shape[1] + own].astype(np.float64)
        top = _exp(logits, safe)
        # Summed row by row: a text's score must not depend on those beside it.
        found[: len(own)] += picked - np.log(logits.sum(axis=1), dtype=np.float64) - top
    out = np.empty(len(targets))
    out[at.order] = found
    return out


def _words_back(laid: _Laid, at: _Sorted, s: np.ndarray, few: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Of the words inside their classes: gradients of the states and of ``word``.

    Classes of ``few`` targets or less are filled up with the row of zeros and multiplied together, others one by one.
    """
    bounded, h = _bounded(laid.word), s.shape[1] - 1
    back, grad = np.empty((len(at.within), h), s.dtype), np.zeros_like(laid.word)
    for c, start, stop in at.spans:
        if stop - start > few:
            own, weights = s[start:stop], laid.word[c]
            q = _slopes(own @ weights, bounded, np.arange(stop - start), at.within[start:stop])
            np.matmul(own.T, q, out=grad[c])
            np.matmul(q, weights[:h].T, out=back[start:stop])
    light = np.array([span for span in at.spans if span[2] - span[1] <= few], np.int64).reshape(-1, 3)
    if len(light):
        c, start, stop = light.T
        place = start[:, None] + np.arange(few)
        filled = place < stop[:, None]
        own, weights = s.take(np.where(filled, place, -1), axis=0, mode="wrap"), laid.word[c]
        rows, place = np.flatnonzero(filled), place[filled]
        q = _slopes(own @ weights, bounded, rows, at.within[place])
        grad[c] = own.transpose(0, 2, 1) @ q
        back[place] = (q @ weights[:, :h].transpose(0, 2, 1)).reshape(-1, h)[rows]
    return back, grad


def _predict_back(laid: _Laid, shape: Shape, states: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of the summed negative log-probability: of the states, of ``kind``, of ``word``."""
    at, h = _Sorted.of(shape, targets), shape.hidden
    s = at.states(states)
    p = _slopes(s[:-1] @ laid.kind, _bounded(laid.kind), np.arange(len(at.order)), at.classes)
    back = p @ laid.kind[:h].T
    through, word = _words_back(laid, at, s)
    back[: len(through)] += through
    out = np.empty_like(back)
    out[at.order] = back
    return out, s[:-1].T @ p, word


def _summed(rows: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and, for each, the sum of its ``rows``, of which the last is all zeros and has no number.

    Numbers that come about equally often, up to the next power of two, are filled up with zeros and summed together.
    """
    order = np.append(np.argsort(numbers.astype(np.int16 if numbers.max() < 2**15 else np.int64), kind="stable"), len(numbers))
    found = numbers[order[:-1]]
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    times = np.diff(first, append=len(found))
    sums = rows.take(order[first], axis=0)
    least, most = 2, 2
    while least <= times.max():
        own = np.flatnonzero((times >= least) & (times <= most))
        if len(own):
            k = np.arange(most)
            place = np.where(k < times[own, None], first[own, None] + k, len(numbers))
            sums[own] = rows.take(order[place], axis=0).sum(axis=1)
        least, most = most + 1, most * 2
    return found[first], sums


def streams(
    texts: list[np.ndarray], width: int, begin: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """Documents laid end to end in ``width`` streams: numbers read, targets, the streams' ends, the texts' places.

    Longer texts are laid first, each into the stream that is shortest so far. Streams are in the order of their ends,
    the longest first, so those that still run are always the first ones. A place is (stream, start, end) of a text.
    """
    width = max(1, min(width, len(texts)))
    heap = [(0, i) for i in range(width)]
    laid: list[tuple[int, int, int]] = [(0, 0, 0)] * len(texts)
    for i in sorted(range(len(texts)), key=lambda i: (-len(texts[i]), i)):
        end, stream = heapq.heappop(heap)
        laid[i] = (stream, end, end + len(texts[i]))
        heapq.heappush(heap, (end + len(texts[i]), stream))
    heap.sort(reverse=True)
    column = {stream: i for i, (_, stream) in enumerate(heap)}
    ends = np.array([end for end, _ in heap], np.int64)
    places = [(column[stream], start, end) for stream, start, end in laid]
    read = np.full((int(ends[0]), width), begin, np.int32)
    target = np.zeros((int(ends[0]), width), np.int32)
    for (stream, start, end), text in zip(places, texts):
        target[start:end, stream] = text
        read[start + 1 : end, stream] = text[:-1]
    return read, target, ends, places


def _windows(ends: np.ndarray, window: int):
    """(start, stop, running streams) of each window."""
    for start in range(0, int(ends[0]), window):
        yield start, min(start + window, int(ends[0])), int((ends > start).sum())


def log_likelihood(net: Net, shape: Shape, texts: list[np.ndarray], width: int = 512, window: int = 32) -> np.ndarray:
    """Natural log-probability of each whole text (one token at least), the state carried from window to window.

    Texts much longer than a stream's share are scored by themselves, so memory follows the tokens and not the longest
    text times the streams.
    """
    if not texts:
        return np.zeros(0)
    lengths = np.array([len(t) for t in texts])
    long = lengths > 4 * lengths.sum() / min(width, len(texts))
    if long.any():
        out = np.empty(len(texts))
        for part in (long, ~long):
            at = np.flatnonzero(part)
            out[at] = log_likelihood(net, shape, [texts[i] for i in at], width, window)
        return out
    read, target, ends, places = streams(texts, width, shape.begin)
    laid = _Laid.of(net, shape)
    bounded = _bounded(laid.kind), _bounded(laid.word)
    state = np.zeros((1, read.shape[1], shape.hidden), F32)
    upto = np.zeros((len(read) + 1, read.shape[1]))
    for start, stop, running in _windows(ends, window):
        now = read[start:stop, :running]
        states, _ = advance([laid], now[:, None], state[:, :running], (now == shape.begin)[:, None], shared=True)
        state, states = states[-1], states[:, 0]
        live = np.arange(start, stop)[:, None] < ends[:running]
        found = np.zeros(live.shape)
        found[live] = predict(laid, shape, states[live], target[start:stop, :running][live], bounded)
        upto[start + 1 : stop + 1, :running] = upto[start, :running] + np.cumsum(found, axis=0)
    return np.array([upto[end, stream] - upto[start, stream] for stream, start, end in places])


def pieces(texts: list[np.ndarray], most: int = 512) -> list[np.ndarray]:
    """Texts cut for training, so that streams are of like length; scoring never cuts."""
    return [t[i : i + most] for t in texts for i in range(0, len(t), most)]


def train(net: Net, shape: Shape, texts: list[np.ndarray], width: int, window: int, rate: float, past: Net | None = None) -> Net:
    """One pass over the texts by truncated backpropagation; updates ``net`` in place, returns the squared gradients."""
    return train_together([net], shape, [texts], width, window, rate, [past])[0]


def train_together(
    nets: list[Net], shape: Shape, texts: list[list[np.ndarray]], width: int, window: int, rate: float, pasts: list[Net | None]
) -> list[Net]:
    """``train`` for networks that know nothing of one another, each with its texts, step by step together."""
    pasts = [past if past is not None else {k: np.full_like(v, 1e-2) for k, v in net.items()} for net, past in zip(nets, pasts)]
    own = [i for i, t in enumerate(texts) if t]
    if not own:
        return pasts
    found = [streams(pieces(texts[i]), width, shape.begin) for i in own]
    longest, widest = max(len(f[0]) for f in found), max(len(f[2]) for f in found)
    read = np.full((longest, len(own), widest), shape.begin, np.int32)
    target, ends = np.zeros_like(read), np.zeros((len(own), widest), np.int64)
    for i, (r, t, e, _) in enumerate(found):
        read[: len(r), i, : len(e)], target[: len(r), i, : len(e)], ends[i, : len(e)] = r, t, e
    laid = [_Laid.of(nets[i], shape) for i in own]
    squares = [_Laid.of(pasts[i], shape, (1.0, 1.0)) for i in own]
    state = np.zeros((len(own), widest, shape.hidden), F32)
    for start in range(0, longest, window):
        # Networks and streams that have come to their ends take part in no further window.
        on, stop = np.flatnonzero(ends[:, 0] > start), min(start + window, longest)
        running = int((ends[on] > start).sum(axis=1).max())
        now, aim = read[start:stop, on, :running], target[start:stop, on, :running]
        live = np.arange(start, stop)[:, None, None] < ends[on, :running]
        states = _train_window([laid[i] for i in on], [squares[i] for i in on], shape, now, aim, live, state[on, :running], rate)
        state[on, :running] = states[-1]
    for i, one, square in zip(own, laid, squares):
        one.back_to(nets[i], shape)
        square.back_to(pasts[i], shape)
    return pasts


def _train_window(
    nets: list[_Laid], squares: list[_Laid], shape: Shape, read: np.ndarray, target: np.ndarray, live: np.ndarray, state: np.ndarray, rate: float
) -> np.ndarray:
    """One step of every network by the gradients of a window (steps, nets, streams); returns the states."""
    h, restarts = shape.hidden, read == shape.begin
    states, steps = advance(nets, read, state, restarts, shared=False)
    above, outer = np.zeros_like(states), []
    for i, net in enumerate(nets):
        own = live[:, i]
        above[:, i][own], *grads = _predict_back(net, shape, states[:, i][own], target[:, i][own])
        outer.append(grads)
    # By how much the gradient of a state moves each gate as it is turned, and the new state as it reads. Places are used again.
    (r, z), into_new, through = steps.gates, steps.new, steps.turned
    into_new *= into_new
    np.subtract(1, into_new, out=into_new)
    rest = 1 - z
    into_new *= rest
    rest *= z
    np.multiply(steps.apart, rest, out=through[1])
    np.subtract(1, r, out=rest)
    rest *= through[2]
    np.multiply(into_new, r, out=through[2])
    np.multiply(through[2], rest, out=through[0])
    carried, sent = np.zeros_like(state), np.empty((3, *state.shape), F32)
    turn_back, some = np.stack([net.turn.T.transpose(2, 0, 1) for net in nets], axis=1), restarts.any(axis=(1, 2)).tolist()
    for t in range(len(read) - 1, -1, -1):
        d, moved = above[t], through[:, t]
        d += carried
        moved *= d
        np.matmul(moved, turn_back, out=sent)
        np.multiply(d, z[t], out=carried)
        carried += sent[0]
        carried += sent[1]
        carried += sent[2]
        if some[t]:
            carried[restarts[t]] = 0
    into_new *= above
    for i, (net, square, (kind, word)) in enumerate(zip(nets, squares, outer)):
        scale = F32(1 / live[:, i].sum())
        moved = through[:, :, i].reshape(3, -1, h)
        turn = steps.before[:, i].reshape(-1, h).T @ moved
        for grad, value, past in ((turn, net.turn, square.turn), (kind, net.kind, square.kind), (word, net.word, square.word)):
            grad *= scale
            past += grad * grad
            grad *= F32(rate)
            grad /= np.sqrt(past)
            value -= grad
    rows = np.zeros((read.size + 1, 3 * h), F32)
    for gate, into in enumerate((through[0], through[1], into_new)):
        rows[:-1, gate * h : (gate + 1) * h] = into.reshape(-1, h)
    every = shape.numbers + 1
    numbers, read_grads = _summed(rows, (read + (np.arange(len(nets)) * every)[:, None]).ravel())
    cuts = np.searchsorted(numbers, np.arange(len(nets) + 1) * every).tolist()
    for i, (net, square) in enumerate(zip(nets, squares)):
        own, grad = numbers[cuts[i] : cuts[i + 1]] - i * every, read_grads[cuts[i] : cuts[i + 1]]
        grad *= F32(1 / live[:, i].sum())
        past = square.read.take(own, axis=0)
        past += grad * grad
        square.read[own] = past
        net.read[own] -= F32(rate) * grad / np.sqrt(past)
    return states
