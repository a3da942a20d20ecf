"""A gated recurrent language model in numpy, with a class-factored softmax.

The network predicts a token's class from its state, and a frequent word from its class and the
state. Words that are not frequent form classes by how often they occur; within those the counts
alone decide. Training is truncated backpropagation: the state is carried from window to window
and the gradient stops at the window's start. In scoring the state is carried through the whole
document.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterable

import numpy as np

HIDDEN = 16
#: Frequent words with outputs of their own, in classes of CLASS_WORDS by rank.
HEAD_WORDS = 1024
CLASS_WORDS = 32
HEAD_CLASSES = HEAD_WORDS // CLASS_WORDS
#: Classes of the other words: those seen at most once, then one for each power of two of the count.
BANDS = 48
CLASSES = HEAD_CLASSES + BANDS
#: Inputs: frequent words, classes of other words, and the start of a document.
START = HEAD_WORDS + BANDS
INPUTS = START + 1
WINDOW = 32
#: How many times as wide a window is where only a few lanes hold tokens.
WIDEST = 8
LANES = 256
#: Tokens whose classes are predicted at a time; their probabilities stay in a core's cache.
BLOCK = 2048
RATE = 0.2
#: What the sums of squared gradients start at. Gradients are means over a window, about 1e-4 for a word.
FIRST_SQUARE = 1e-8

SHAPES = {
    "inputs": (INPUTS, 3 * HIDDEN),
    "state": (HIDDEN, 3 * HIDDEN),
    "to_class": (HIDDEN, CLASSES),
    "class_bias": (CLASSES,),
    "to_word": (HEAD_WORDS, HIDDEN),
    "word_bias": (HEAD_WORDS,),
}

Weights = dict[str, np.ndarray]


def pack(weights: Weights) -> bytes:
    return np.concatenate([weights[k].ravel() for k in SHAPES]).astype("<f4").tobytes()


def unpack(raw: bytes) -> Weights:
    flat, out, at = np.frombuffer(raw, "<f4"), {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = flat[at : at + size].reshape(shape).copy()
        at += size
    return out


def initial(class_counts: np.ndarray, word_counts: np.ndarray) -> Weights:
    """Weights that give every token its share of the training tokens, whatever the state.

    Classes without training tokens, which no token has, share the output of the last of them; the
    others of them get none, which a bias of minus infinity says. Words not seen have a class of their own.
    """
    rng = np.random.default_rng(7)
    out = {k: rng.normal(0, 0.1, shape).astype(np.float32) for k, shape in SHAPES.items()}
    out["to_class"] *= 0.1
    out["to_word"] *= 0.1
    mass = class_counts + 0.5
    empty = np.flatnonzero((np.asarray(class_counts) == 0) & (np.arange(CLASSES) != HEAD_CLASSES))
    if len(empty):
        mass[empty[-1]], mass[empty[:-1]] = mass[empty].sum(), 0.0
    with np.errstate(divide="ignore"):
        out["class_bias"] = np.log(mass).astype(np.float32)
    out["word_bias"] = np.log(word_counts + 0.5).astype(np.float32)
    return out


def classes_of(tokens: np.ndarray) -> np.ndarray:
    return np.where(tokens < HEAD_WORDS, tokens // CLASS_WORDS, tokens - HEAD_WORDS + HEAD_CLASSES)


def by_part(weights: np.ndarray) -> np.ndarray:
    """Weights (row, part and feature) as (part, row, feature); the parts are both gates and the new state."""
    return np.ascontiguousarray(weights.reshape(len(weights), 3, HIDDEN).transpose(1, 0, 2))


def steps(weights: Weights, inputs: np.ndarray, state: np.ndarray, reset: np.ndarray, kept: bool = True) -> tuple[np.ndarray, list[np.ndarray]]:
    """States after each input of a window (lanes, time), and what backpropagation needs if ``kept``.

    Arrays are kept as (time, lane, feature), so that what one time step needs lies together.
    """
    dtype = weights["state"].dtype
    half = np.array([0.5, 0.5, 1], dtype)[:, None, None]  # a sigmoid is a tanh of half its input
    by_state, by_input = by_part(weights["state"]) * half, by_part(weights["inputs"]) * half
    lanes, length = inputs.shape
    at = np.ascontiguousarray(inputs.T, np.intp)
    given, out = np.empty((3, lanes, HIDDEN), dtype), np.empty((length, lanes, HIDDEN), dtype)
    before, new, last = (np.empty((length, lanes, HIDDEN), dtype) for _ in range(3)) if kept else (None,) * 3
    gates = np.empty((length, 2, lanes, HIDDEN), dtype) if kept else None
    new_documents = reset.any(axis=0)
    h = np.ascontiguousarray(state)
    for t in range(length):
        if new_documents[t]:
            h = h.copy()
            h[reset[:, t]] = 0
        np.take(by_input, at[t], axis=1, out=given, mode="clip")
        u = h @ by_state
        g, n = u[:2], u[2]
        if kept:
            before[t], last[t] = h, n
        g += given[:2]
        np.tanh(g, out=g)
        g += 1
        g *= 0.5
        n *= g[1]
        n += given[2]
        np.tanh(n, out=n)
        if kept:
            gates[t], new[t] = g, n
        h = np.subtract(h, n, out=out[t])
        h *= g[0]
        h += n
    return out.transpose(1, 0, 2), [before, gates, new, last]


def softmax(x: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Natural log of the chosen row's probability in each column, all probabilities times the
    column's sum, and that sum; ``x`` is overwritten."""
    x -= x.max(axis=0)
    logs = x[chosen, np.arange(x.shape[1])]
    np.exp(x, out=x)
    total = x.sum(axis=0)
    return logs - np.log(total), x, total


def outputs_of(weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Classes that have an output, and the place of each class among them."""
    has = np.isfinite(weights["class_bias"])
    return np.flatnonzero(has), np.cumsum(has) - 1


def with_ones(states: np.ndarray) -> np.ndarray:
    """States (token, feature) and a last feature of ones, which biases are multiplied by."""
    return np.concatenate([states, np.ones((len(states), 1), states.dtype)], axis=1)


def class_weights(weights: Weights, outputs: np.ndarray) -> np.ndarray:
    return np.concatenate([weights["to_class"].T[outputs], weights["class_bias"][outputs, None]], axis=1)


def frequent(weights: Weights, flat: np.ndarray, tokens: np.ndarray, classes: np.ndarray):
    """Places of frequent words in order of their classes, their numbers in the class, their states, the
    logits of all words of their classes, and for each class found its words with their weights and its part."""
    order = np.argsort(classes.astype(np.uint8), kind="stable")
    edges = np.searchsorted(classes[order], np.arange(HEAD_CLASSES + 1)).tolist()
    order = order[: edges[-1]]
    flat = np.take(flat, order, axis=0)
    by_word = np.concatenate([weights["to_word"], weights["word_bias"][:, None]], axis=1)
    x, parts = np.empty((CLASS_WORDS, len(order)), flat.dtype), []
    for c, (a, b) in enumerate(itertools.pairwise(edges)):
        if a < b:
            words, own = slice(c * CLASS_WORDS, (c + 1) * CLASS_WORDS), slice(a, b)
            x[:, own] = by_word[words] @ flat[own].T
            parts.append((words, by_word[words], own))
    return order, tokens[order] % CLASS_WORDS, flat, x, parts


def log_probabilities(weights: Weights, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Natural log of each token's class, and of a frequent word in its class, given the states."""
    flat, classes, (outputs, place) = with_ones(states), classes_of(tokens), outputs_of(weights)
    by_class, logs = class_weights(weights, outputs), np.empty(len(tokens), flat.dtype)
    for start in range(0, len(tokens), BLOCK):
        own = slice(start, start + BLOCK)
        logs[own] = softmax(by_class @ flat[own].T, place[classes[own]])[0]
    order, word, _, x, _ = frequent(weights, flat, tokens, classes)
    logs[order] += softmax(x, word)[0]
    return logs


def gradients(weights: Weights, inputs: np.ndarray, tokens: np.ndarray, state: np.ndarray, reset: np.ndarray, held: np.ndarray) -> tuple[Weights, np.ndarray, float]:
    """Gradient of the mean negative log-likelihood of a window, the state after it, and the mean."""
    states, (before, gates, new, last) = steps(weights, inputs, state, reset)
    grad = {k: np.zeros(s, np.float32) for k, s in SHAPES.items()}
    lanes, length = inputs.shape
    flat = with_ones(states.transpose(1, 0, 2).reshape(-1, HIDDEN))
    tokens = tokens.T.ravel().astype(np.int64)
    classes, (outputs, place) = classes_of(tokens), outputs_of(weights)
    by_class = class_weights(weights, outputs)
    share = held.T.ravel() * np.float32(1 / max(1, int(held.sum())))
    at = np.arange(len(tokens))
    logs, d_states, d_by_class = np.empty(len(tokens), flat.dtype), np.empty((len(tokens), HIDDEN), flat.dtype), 0
    for start in range(0, len(tokens), BLOCK):
        own = slice(start, start + BLOCK)
        chosen = place[classes[own]]
        logs[own], d, total = softmax(by_class @ flat[own].T, chosen)
        d *= share[own] / total
        d[chosen, at[: len(chosen)]] -= share[own]
        d_by_class += d @ flat[own]
        d_states[own] = d.T @ by_class[:, :HIDDEN]
    grad["to_class"][:, outputs], grad["class_bias"][outputs] = d_by_class[:, :HIDDEN].T, d_by_class[:, HIDDEN]
    order, word, flat, x, parts = frequent(weights, flat, tokens, classes)
    more, d, total = softmax(x, word)
    logs[order] += more
    d *= share[order] / total
    d[word, at[: len(word)]] -= share[order]
    d_frequent = np.empty((len(order), HIDDEN), flat.dtype)
    for words, by_word, own in parts:
        both = d[:, own] @ flat[own]
        grad["to_word"][words], grad["word_bias"][words] = both[:, :HIDDEN], both[:, HIDDEN]
        d_frequent[own] = d[:, own].T @ by_word[:, :HIDDEN]
    d_states[order] += d_frequent
    d_states = d_states.reshape(length, lanes, HIDDEN)
    # By both gates, by the new state through the last one, and by the new state through the input, which goes past the gate r.
    d_parts = [np.empty((length, lanes, HIDDEN), flat.dtype) for _ in range(4)]
    back_by_state = by_part(weights["state"]).transpose(0, 2, 1).copy()
    new_documents = reset.any(axis=0)
    back = 0
    for t in range(length - 1, -1, -1):
        (to_z, to_r, to_last, to_new), g, n, dh = (d[t] for d in d_parts), gates[t], new[t], d_states[t]
        dh += back
        rest = 1 - g
        np.multiply(n, n, out=to_new)
        np.subtract(1, to_new, out=to_new)
        to_new *= rest[0]
        to_new *= dh
        rest *= g
        np.subtract(before[t], n, out=to_z)
        to_z *= rest[0]
        to_z *= dh
        np.multiply(last[t], rest[1], out=to_r)
        to_r *= to_new
        np.multiply(to_new, g[1], out=to_last)
        dh *= g[0]
        back = dh
        for d, by_state in zip((to_z, to_r, to_last), back_by_state, strict=True):
            back += d @ by_state
        if new_documents[t]:
            back[reset[:, t]] = 0
    to_z, to_r, to_last, to_new = (d.reshape(-1, HIDDEN) for d in d_parts)
    grad["state"] = np.concatenate([before.reshape(-1, HIDDEN).T @ d for d in (to_z, to_r, to_last)], axis=1)
    named = inputs.T.ravel().astype(np.uint16)
    order = np.argsort(named, kind="stable")
    named = named[order]
    first = np.flatnonzero(np.concatenate(([True], named[1:] != named[:-1])))
    grad["inputs"][named[first]] = np.concatenate([np.add.reduceat(np.take(d, order, axis=0), first, axis=0) for d in (to_z, to_r, to_new)], axis=1)
    return grad, states[:, -1], -float((logs * share).sum())


class Lanes:
    """Documents dealt to lanes that run side by side, the longest lane first.

    Lanes lie end to end, so memory goes with the tokens however long a single document is.
    """

    def __init__(self, documents: list[np.ndarray], lanes: int, rng: np.random.Generator | None = None):
        """``rng`` puts the documents of each lane in random order; else the longest is first."""
        ends: list[tuple[int, int]] = [(0, i) for i in range(min(lanes, len(documents)))]
        dealt: list[list[int]] = [[] for _ in ends]
        for i in sorted(range(len(documents)), key=lambda i: -len(documents[i])):
            length, lane = heapq.heappop(ends)
            dealt[lane].append(i)
            heapq.heappush(ends, (length + len(documents[i]), lane))
        if rng:
            dealt = [rng.permutation(lane).tolist() for lane in dealt]
        dealt.sort(key=lambda lane: -sum(len(documents[i]) for i in lane))
        self.lengths = np.array([sum(len(documents[i]) for i in lane) for lane in dealt], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.longest = int(self.lengths[0]) if dealt else 0
        numbers = [i for lane in dealt for i in lane]
        sizes = np.array([len(documents[i]) for i in numbers], np.int64)
        self.tokens = np.concatenate([documents[i] for i in numbers]).astype(np.uint16) if numbers else np.empty(0, np.uint16)
        self.owner = np.repeat(np.array(numbers, np.int32), sizes)
        self.reset = np.zeros(len(self.tokens), bool)
        self.reset[(np.cumsum(sizes) - sizes)[sizes > 0]] = True

    def windows(self):
        """Inputs, tokens, starts of documents and places of each window's part of the lanes that
        still hold tokens there, and where they hold some. Windows are wider where fewer lanes are left."""
        start = 0
        while start < self.longest:
            live = int((self.lengths > start).sum())
            width = WINDOW * max(1, min(WIDEST, LANES // (2 * live)))
            along = start + np.arange(min(width, self.longest - start))
            start += len(along)
            held = along < self.lengths[:live, None]
            at = self.starts[:live, None] + np.minimum(along, self.lengths[:live, None] - 1)
            reset = self.reset[at] & held
            inputs = np.where(reset, START, self.tokens[at - 1])
            yield inputs, self.tokens[at], reset, at, held


def train(weights: Weights, parts: Iterable[list[np.ndarray]], lanes: int = LANES) -> Weights:
    """Weights after one pass over all tokens of whole documents, given in parts that fit the memory.

    The state is carried from window to window and starts anew with each document.
    """
    weights = {k: v.copy() for k, v in weights.items()}
    squares = {k: np.full(v.shape, FIRST_SQUARE, np.float32) for k, v in weights.items()}
    rng = np.random.default_rng(3)
    for documents in parts:
        dealt = Lanes(documents, lanes, rng)
        state = np.zeros((len(dealt.lengths), HIDDEN), np.float32)
        for inputs, tokens, reset, _, held in dealt.windows():
            grad, state, _ = gradients(weights, inputs, tokens, state[: len(held)], reset, held)
            # Windows with few tokens count less, so that every token of a part has the same weight.
            share = np.float32(held.sum() / (len(dealt.lengths) * WINDOW))
            for k, d in grad.items():
                d = d * share
                squares[k] += d * d
                weights[k] -= RATE * d / np.sqrt(squares[k])
    return weights


def score(weights: Weights, documents: list[np.ndarray]) -> np.ndarray:
    """Natural log of each whole document's probability, but for what counts alone decide.

    Documents are dealt to lanes that run side by side; the state is carried from window to
    window and starts anew with each document.
    """
    dealt = Lanes(documents, LANES)
    logs = np.empty(len(dealt.tokens), np.float32)
    state = np.zeros((len(dealt.lengths), HIDDEN), np.float32)
    for inputs, tokens, reset, at, held in dealt.windows():
        states, _ = steps(weights, inputs, state[: len(held)], reset, kept=False)
        state = states[:, -1]
        flat, at, tokens = states.transpose(1, 0, 2).reshape(-1, HIDDEN), at.T.ravel(), tokens.T.ravel()
        if not held.all():
            own = np.flatnonzero(held.T)
            flat, at, tokens = flat[own], at[own], tokens[own]
        logs[at] = log_probabilities(weights, flat, tokens.astype(np.int64))
    return np.bincount(dealt.owner, logs, len(documents))
