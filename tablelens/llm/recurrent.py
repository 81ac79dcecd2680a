"""Language-model scoring with a gated recurrent network.

Tokens are words between ASCII white space, A-Z lower-cased, and one end of text.
Their counts over all training rows are one grouped sum.  The network (gated
recurrent units, in numpy) reads the classes of the tokens so far and predicts the
next one through a class-factored softmax: first the class, then the word in it.
The ``HEAD`` most frequent words form classes of ``WIDTH`` words whose second
softmax follows the state; all other words fall in ``TAIL`` classes by the letters
they begin and end with, and their share of a class is (c + 1) / (sum of c + 1 over
the class, + 1 for all unknown words), so every training count takes part and the
probabilities of all outcomes add up to one.

Training is truncated backpropagation: windows of ``WINDOW`` tokens in ``LANES``
parallel streams, the state carried from window to window and cleared where a text
starts.  A first task trains on about ``WARM_TOKENS`` tokens (a documented bound) to
give all replicas one starting point.  Then every training row takes part: in each
of ``ROUNDS`` rounds, every partition trains a replica on its part of one share of
the rows (chosen by a hash of the row; the shares together are all rows), and the
replicas are averaged by their tokens, in groups of about the square root of their
number.

Scoring reads texts one after another in lanes of about equal length side by side;
states are carried over the windows to the end of every text and cleared there.  Counts of the ``KNOWN`` most frequent tokens are
broadcast (bounded number and length); all other tokens get theirs by a join.

Cases: null and empty texts are one end token; a null doc_id counts as the empty
text for the fold; repeated rows count each and get their row each; a long text is
read in pieces of ``RUN`` bytes and kept as codes of 4 bytes a token and its distinct
words a piece, and, as the network is recurrent, it is scored token by token (some
25 us each for one very long text on its own); without training rows all counts are zero and the network
stays as it is made; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelens.llm.common import fold, materialise, pieces, runs, tidy, with_uid

STATE = 32
HEAD, WIDTH, TAIL = 1024, 32, 64
KNOWN, KNOWN_BYTES = 1 << 17, 64
WINDOW, LANES = 16, 256
WARM_TOKENS, WARM_RATE, WARM_LANES = 400_000, 0.01, 64
ROUNDS, LEAST_TOKENS, RATE = 2, 1_000_000, 0.004  # tables of fewer tokens are read whole in every round
CLIP = 1.0
APART = 40.0  # class logits within this bound need no largest one subtracted: their exponentials fit in 32 bits
BLOCK = 1024  # tokens whose class probabilities are held at once (what a core's cache holds)
SCORE_WINDOW, SCORE_LANES, SCORE_CELLS = 256, 512, 8192  # longest window; texts side by side; tokens in a window of many texts
FLUSH = 1 << 17  # distinct tokens held by a counting task before they are passed on
RUN = 1 << 23  # bytes of text split into words at once
END = b"\n"  # no word holds white space

_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, place among them of each word, words of each text) of texts: only A-Z lower-cased, split at 09-0D and 20, whatever the bytes."""
    texts = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    sizes = np.diff(parts.offsets.to_numpy())
    coded = parts.values.dictionary_encode()
    index, distinct = coded.indices.to_numpy(), coded.dictionary
    gap = pc.index(distinct, "").as_py()  # white space at an end of a text gives an empty word
    if gap >= 0:
        kept = index != gap
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[kept], minlength=len(sizes))
        index = index[kept]
    return distinct.cast(pa.binary()), index, sizes


def words(column: pa.Array) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray, bool]]:
    """(first row, distinct words, place of each word, words of each text, whether the texts end here) for runs of texts, or pieces of a long one."""
    for first, _, data, offsets in runs(column, RUN):
        if len(data) <= RUN:
            yield first, *_words(data, offsets), True
            continue
        for piece in pieces(data.tobytes(), _SPACE, RUN):
            yield first, *_words(np.frombuffer(piece, np.uint8), np.array([0, len(piece)])), False
        yield first, *_words(data[:0], np.zeros(2, np.int64)), True


# ---------------------------------------------------------------- counts


def counts(train: DataFrame) -> DataFrame:
    """(token, c) over the texts of train, ends included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, ends = [], 0, 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.concat_arrays([w for w, _ in held]), pa.array(np.concatenate([k for _, k in held]))], ["token", "c"])

        for batch in batches:
            ends += batch.num_rows
            for _, distinct, index, _, _ in words(batch.column("text")):
                times = np.bincount(index, minlength=len(distinct))
                met = np.flatnonzero(times)
                held.append((distinct.take(pa.array(met)), times[met]))
                n += len(met)
                if n >= FLUSH:
                    yield out()
                    held, n = [], 0
        if ends:
            held.append((pa.array([END], pa.binary()), np.array([ends])))
            yield out()

    return train.select("text").mapInArrow(tidy(run), "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def tail_class(word: bytes) -> int:
    """Class of a word outside the head, by its first two bytes and its last."""
    return zlib.crc32(word[:2] + word[-1:]) % TAIL


def _tail_class():
    return F.pmod(F.crc32(F.concat(F.substring("token", 1, 2), F.substring("token", -1, 1))), F.lit(TAIL)).cast("int")


def tail_classes(distinct: pa.Array) -> np.ndarray:
    """The same for an array of words; what they share is computed once."""
    offsets = np.frombuffer(distinct.buffers()[1], np.int32)[distinct.offset : distinct.offset + len(distinct) + 1].astype(np.int64)
    data = np.frombuffer(distinct.buffers()[2] or b"", np.uint8)
    byte = lambda at: data[np.clip(at, 0, max(0, len(data) - 1))].astype(np.int64) if len(data) else np.zeros(len(at), np.int64)
    size = np.diff(offsets)
    key = byte(offsets[:-1]) << 16 | np.where(size > 1, byte(offsets[:-1] + 1), 0) << 8 | byte(offsets[1:] - 1) | np.minimum(size, 2) << 24
    some, at, back = np.unique(key, return_index=True, return_inverse=True)
    return np.array([tail_class(distinct[i].as_py()) for i in at.tolist()], np.int32)[back] if len(some) else np.empty(0, np.int32)


class Codes:
    """Code of each word: its rank in the head, or HEAD and its tail class.  ``more``: other words whose rank is wanted, after the head's."""

    def __init__(self, head: list[bytes], more: list[bytes] | tuple = ()):
        self.heads, self.ranked = len(head), pa.array([*head, *more], pa.binary())
        self.end = int(self.codes(pa.array([END], pa.binary()))[0][0])

    def codes(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(code, rank among head and more, or -1) of each word."""
        rank = pc.fill_null(pc.index_in(distinct, self.ranked), -1).to_numpy()
        return np.where((rank >= 0) & (rank < self.heads), rank, HEAD + tail_classes(distinct)).astype(np.int32), rank

    def ended(self, code: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """The codes of each text, the end included, from those of all their words."""
        out = np.full(len(code) + len(sizes), self.end, np.int32)
        out[np.arange(len(code)) + np.repeat(np.arange(len(sizes)), sizes)] = code
        return np.split(out, np.cumsum(sizes + 1)[:-1])

    def of(self, column: pa.Array, note=None) -> list[np.ndarray]:
        """Codes of the tokens of each text; ``note`` is told of every run of words, with their codes and ranks."""
        texts, begun = [], []
        for first, distinct, index, sizes, whole in words(column):
            code, rank = self.codes(distinct)
            if note is not None:
                note(first, distinct, index, sizes, code, rank)
            if whole:
                texts += self.ended(code[index], sizes)
                if begun:
                    texts[-1], begun = np.concatenate([*begun, texts[-1]]), []
            else:
                begun.append(code[index])
        return texts


# ---------------------------------------------------------------- network


def initial(head: list[int], tail: list[int], dtype=np.float32) -> dict[str, np.ndarray]:
    """Weights that start near the counts' own distribution.  ``head``: counts of the head words; ``tail``: masses of the tail classes."""
    rnd = np.random.default_rng(12)
    draw = lambda scale, *shape: (rnd.standard_normal(shape) * scale).astype(dtype)
    slots = np.full(HEAD, -1e4)  # a slot without a word has probability zero
    slots[: len(head)] = np.log(np.array(head, float) + 1)
    slots = slots.reshape(-1, WIDTH)
    mass = np.where(slots > -1e4, np.exp(slots), 0).sum(axis=1)
    empty = mass == 0
    classes = np.concatenate([np.where(empty, -1e4, np.log(np.maximum(mass, 1))), np.log(np.array(tail, float))])
    classes[classes > -1e4] -= np.log(np.exp(classes[classes > -1e4]).sum())
    top = slots.max(axis=1, keepdims=True)
    slots = np.where(slots > -1e4, slots - top, -1e4)
    slots[empty] = 0  # never drawn: its class has probability zero
    return {
        "input": draw(0.1, HEAD + TAIL + 1, 3 * STATE),  # the last row opens a text
        "state": draw(1 / math.sqrt(STATE), STATE, 3 * STATE),
        "classes": draw(0.05, STATE, HEAD // WIDTH + TAIL),
        "class_bias": classes.astype(dtype),
        "words": draw(0.05, HEAD // WIDTH, STATE, WIDTH),
        "word_bias": slots.astype(dtype),
    }


class Room:
    """Arrays used again from window to window: touching fresh memory would cost as much as the work done in it."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, like: np.ndarray, *shape: int) -> np.ndarray:
        """An array of that shape and of like's type, with any content; its former user is done with it."""
        size, a = math.prod(shape), self.held.get(name)
        if a is None or a.size < size or a.dtype != like.dtype:
            a = self.held[name] = np.empty(size, like.dtype)
        return a[:size].reshape(shape)


def units(w: dict) -> tuple[np.ndarray, np.ndarray]:
    """What ``forward`` needs of the weights, gate by gate; those of the two sigmoids negated."""
    gates = [np.ascontiguousarray(w[k].reshape(-1, 3, STATE).transpose(1, 0, 2)) for k in ("input", "state")]
    for g in gates:
        np.negative(g[:2], out=g[:2])
    return tuple(gates)


def forward(gates: tuple, into: np.ndarray, starts: np.ndarray, h: np.ndarray, room: Room):
    """States after each step of (steps, lanes) tokens, from h, cleared at starts; and what backpropagation needs."""
    x = room("x", h, 3, into.size, STATE)  # becomes z, r and n
    x = gates[0].take(into.ravel(), axis=1, out=x, mode="clip").reshape(3, *into.shape, STATE)
    before, un, after = (room(name, h, *x.shape[1:]) for name in ("before", "un", "after"))
    u, clear = room("u", h, 3, *h.shape), starts.any(axis=1)
    with np.errstate(over="ignore"):  # exp(large) is inf, and 1 / inf the 0 that is meant
        for t in range(len(into)):
            was, zr, n, now = before[t], x[:2, t], x[2, t], after[t]
            was[:] = h
            if clear[t]:
                was[starts[t]] = 0
            np.matmul(was, gates[1], out=u)
            zr += u[:2]
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            un[t] = u[2]
            n += np.multiply(zr[1], u[2], out=u[2])
            np.tanh(n, out=n)
            np.subtract(was, n, out=now)
            now *= zr[0]
            now += n
            h = now
    return after, (x, before, un)


def _softmax(logits: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability of row ``at`` of each column, and the sum of each column of logits, which become their exponentials (less the largest)."""
    logits -= logits.max(axis=0)
    picked = logits[at, np.arange(len(at))]
    total = np.exp(logits, out=logits).sum(axis=0)
    return picked - np.log(total), total


def class_of(code: np.ndarray) -> np.ndarray:
    return np.where(code < HEAD, code // WIDTH, code - HEAD + HEAD // WIDTH)


def outputs(w: dict, h: np.ndarray, code: np.ndarray, room: Room, grads: dict | None = None):
    """Log-probability of each code after state h (for tail classes: of the class); with ``grads``, adds to them and returns d loss / d h too."""
    cls, classes, bias = class_of(code), w["classes"], w["class_bias"]
    apart = (np.abs(classes).sum(axis=0) + np.abs(bias)).max() < APART  # states are within -1 and 1: no exponential overflows
    if apart:  # the biases are factors of the exponentials: small matrices take them, and nothing has to be subtracted first
        scale = np.exp(bias)
        biased = classes * scale
    else:
        scale, biased = np.ones_like(bias), classes
    logp, dh = np.empty(len(code), h.dtype), None if grads is None else room("dh", h, *h.shape)
    for lo in range(0, len(code), BLOCK):
        part = slice(lo, lo + BLOCK)
        some, at = h[part], cls[part]
        p = np.matmul(classes.T, some.T, out=room("classes", h, classes.shape[1], len(at)))
        if apart:
            picked = p[at, np.arange(len(at))].astype(np.float64) + np.log(scale, dtype=np.float64)[at]
            total = scale @ np.exp(p, out=p)
            logp[part] = np.minimum(picked - np.log(total, dtype=np.float64), 0)  # near 0 the two nearly cancel
        else:
            p += bias[:, None]
            logp[part], total = _softmax(p, at)
        if grads is not None:
            p[at, np.arange(len(at))] -= total / scale[at]
            share = 1 / total
            grads["classes"] += (p @ np.multiply(some, share[:, None], out=dh[part])).T * scale
            grads["class_bias"] += (p @ share) * scale
            np.matmul(p.T, biased.T, out=dh[part])
            dh[part] *= share[:, None]
    rows = np.flatnonzero(code < HEAD)
    if not len(rows):
        return logp, dh
    rows = rows[np.argsort(cls[rows].astype(np.uint16), kind="stable")]
    of, at = cls[rows], code[rows] % WIDTH
    first = np.flatnonzero(np.diff(of, prepend=-1))
    met = of[first]
    parts = [(c, slice(lo, hi)) for c, lo, hi in zip(met.tolist(), first.tolist(), [*first[1:].tolist(), len(rows)], strict=True)]
    some = h.take(rows, axis=0, out=room("some", h, len(rows), STATE), mode="clip")
    p = room("words", h, WIDTH, len(rows))
    for c, part in parts:
        np.matmul(w["words"][c].T, some[part].T, out=p[:, part])
    p += w["word_bias"].T.take(of, axis=1, out=room("bias", h, *p.shape), mode="clip")
    more, total = _softmax(p, at)
    logp[rows] += more
    if grads is not None:
        p /= total
        p[at, np.arange(len(at))] -= 1
        back = room("back", h, len(rows), STATE)
        for c, part in parts:
            grads["words"][c] += some[part].T @ p[:, part].T
            np.matmul(p[:, part].T, w["words"][c].T, out=back[part])
        grads["word_bias"][met] += np.add.reduceat(p, first, axis=1).T
        back += dh.take(rows, axis=0, out=some, mode="clip")
        dh[rows] = back
    return logp, dh


def _sums(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the runs of rows that begin at ``first``; two numbers at a time are added as one complex number."""
    if rows.shape[1] % 2:
        return np.add.reduceat(rows, first)
    return np.add.reduceat(rows.view(np.result_type(rows.dtype, np.complex64)), first).view(rows.dtype)


def window_gradients(w: dict, into: np.ndarray, code: np.ndarray, starts: np.ndarray, h: np.ndarray, room: Room | None = None):
    """(loss, gradients, last state) of a window: into, code, starts are (steps, lanes); gradients stop at the window's start."""
    room = room or Room()
    grads = {k: room(f"d {k}", v, *v.shape) for k, v in w.items()}
    for g in grads.values():
        g[...] = 0
    after, (x, before, un) = forward(units(w), into, starts, h, room)
    logp, dflat = outputs(w, after.reshape(-1, STATE), code.ravel(), room, grads)
    dflat = dflat.reshape(after.shape)
    state = np.concatenate([w["state"][:, 2 * STATE :], w["state"][:, : 2 * STATE]], axis=1).T
    dh, spare, dn = np.zeros_like(h), np.empty_like(h), np.empty_like(h)
    rows, clear = room("rows", h, *code.shape, 4 * STATE), starts.any(axis=1)  # d loss / d of un, then of what the tokens give to z, r and n
    for t in range(len(code) - 1, -1, -1):
        z, r, n = x[:, t]
        dun, dz, dr, dx = (rows[t, :, k : k + STATE] for k in range(0, 4 * STATE, STATE))
        dh += dflat[t]
        np.subtract(1, z, out=spare)
        np.multiply(dh, spare, out=dn)
        np.subtract(before[t], n, out=spare)
        spare *= z
        np.multiply(spare, dn, out=dz)
        np.multiply(n, n, out=spare)
        np.subtract(1, spare, out=spare)
        dn *= spare
        dx[:] = dn
        dn *= r
        dun[:] = dn
        np.subtract(1, r, out=spare)
        spare *= un[t]
        np.multiply(spare, dn, out=dr)
        dh *= z
        dh += np.matmul(rows[t, :, : 3 * STATE], state, out=spare)
        if clear[t]:
            dh[starts[t]] = 0
    rows, read = rows.reshape(-1, 4 * STATE), into.ravel()
    du = before.reshape(-1, STATE).T @ rows[:, : 3 * STATE]
    grads["state"][:, : 2 * STATE], grads["state"][:, 2 * STATE :] = du[:, STATE:], du[:, :STATE]
    order = np.argsort(read.astype(np.uint16), kind="stable")
    read = read[order]
    first = np.flatnonzero(np.diff(read, prepend=-1))
    rows = rows[:, STATE:].take(order, axis=0, out=room("sorted", h, len(order), 3 * STATE), mode="clip")
    grads["input"][read[first]] = _sums(rows, first)
    return -float(logp.sum()), grads, after[-1]


class Adam:
    def __init__(self, w: dict, rate: float):
        self.rate, self.t = rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))

    def update(self, w: dict, grads: dict, n: int) -> None:
        self.t += 1
        size = math.sqrt(sum(float(np.vdot(g, g)) for g in grads.values())) / n
        scale = 1 / n / max(1.0, size / CLIP)
        rate = self.rate * math.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in grads.items():  # g is used up
            m, v, spare = self.m[k], self.v[k], np.empty_like(g)
            g *= scale
            np.subtract(g, m, out=spare)
            spare *= 0.1
            m += spare
            g *= g
            g -= v
            g *= 0.001
            v += g
            np.sqrt(v, out=spare)
            spare += 1e-8
            np.divide(m, spare, out=spare)
            spare *= rate
            w[k] -= spare


def train(w: dict, texts: list[np.ndarray], optimiser: Adam, most: int | None = None) -> float:
    """Train w in place on every token of texts (codes), in ``most`` (``LANES``) lanes at most; returns the loss per token."""
    stream = np.concatenate(texts)
    opens = np.zeros(len(stream), bool)
    opens[np.cumsum([0, *map(len, texts[:-1])])] = True
    into = np.empty_like(stream)
    into[1:] = stream[:-1]
    into[opens] = HEAD + TAIL
    lanes = max(1, min(most or LANES, len(stream) // WINDOW))
    steps = -(-len(stream) // lanes)
    begin = np.arange(lanes) * (len(stream) - steps) // max(1, lanes - 1)  # lanes overlap by a few tokens and leave none out
    at = np.arange(steps)[:, None] + begin
    into, code, opens = into[at], stream[at], opens[at]
    h, loss, room = np.zeros((lanes, STATE), w["state"].dtype), 0.0, Room()
    for at in range(0, steps, WINDOW):
        part = slice(at, at + WINDOW)
        more, grads, h = window_gradients(w, into[part], code[part], opens[part], h, room)
        optimiser.update(w, grads, code[part].size)
        loss += more
    return loss / (lanes * steps)


def log_likelihood(w: dict, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log-probability of each text's codes; states are carried over the windows to its end."""
    out = np.zeros(len(texts))
    lengths = np.array([len(t) for t in texts], np.int64)
    lanes: list[list[int]] = [[] for _ in range(min(SCORE_LANES, len(texts)))]
    shortest = [(0, k) for k in range(len(lanes))]
    for i in np.argsort(-lengths, kind="stable").tolist():
        if lengths[i]:
            size, k = shortest[0]
            lanes[k].append(i)
            heapq.heapreplace(shortest, (size + int(lengths[i]), k))
    lanes = [lanes[k] for _, k in sorted(shortest, reverse=True) if lanes[k]]  # longest first
    if not lanes:
        return out
    order = np.concatenate(lanes)
    flat = np.concatenate([texts[i] for i in order.tolist()])
    first = np.cumsum(lengths[order]) - lengths[order]
    opens = np.zeros(len(flat), bool)
    opens[first] = True
    size = np.array([lengths[lane].sum() for lane in lanes])
    begin = np.cumsum(size) - size
    logp, gates, at = np.empty(len(flat), w["state"].dtype), units(w), 0
    room = Room()
    h = np.zeros((len(lanes), STATE), w["state"].dtype)
    while at < size[0]:
        n = int(np.searchsorted(-size, -at))  # lanes that still have tokens
        width = min(SCORE_WINDOW, max(1, SCORE_CELLS // n), int(size[0]) - at)
        when = at + np.arange(width)[:, None]
        here = begin[:n] + np.minimum(when, size[:n] - 1)
        starts = opens[here]
        states, _ = forward(gates, np.where(starts, HEAD + TAIL, flat[here - 1]), starts, h[:n], room)
        h, at = states[-1], at + width
        on = when < size[:n]
        here = here[on]
        logp[here] = outputs(w, states.reshape(-1, STATE) if on.all() else states[on], flat[here], room)[0]
    out[order] = np.add.reduceat(logp, first, dtype=np.float64)
    return out


# ---------------------------------------------------------------- Spark


def _packed(w: dict) -> bytes:
    return b"".join(w[k].tobytes() for k in w)


def _unpacked(data: bytes, like: dict) -> dict:
    out, at = {}, 0
    for k, v in like.items():
        out[k] = np.frombuffer(data, v.dtype, v.size, at).reshape(v.shape).copy()
        at += v.nbytes
    return out


def _replicas(train_rows: DataFrame, w: dict, head: list[bytes], rate: float, lanes: int, name: str) -> DataFrame:
    """(weights, tokens) of a replica for every partition with rows."""
    shared = train_rows.sparkSession.sparkContext.broadcast((w, head))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, head = shared.value
        mine, codes, n = {k: v.copy() for k, v in mine.items()}, Codes(head), 0
        optimiser = Adam(mine, rate)
        for batch in batches:
            texts = codes.of(batch.column("text"))
            if texts:
                train(mine, texts, optimiser, lanes)
                n += sum(map(len, texts))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([_packed(mine)], pa.binary()), pa.array([n], pa.int64())], ["weights", "tokens"])

    return materialise(train_rows.select("text").mapInArrow(tidy(run), "weights binary, tokens long"), name)


def _averaged(replicas: DataFrame, w: dict) -> dict:
    """Weights averaged by tokens: in groups first, so neither a task nor the driver holds more than the square root of the replicas."""
    n = replicas.count()
    groups = max(1, math.isqrt(max(0, n - 1)) + 1)

    def run(table: pa.Table) -> pa.Table:
        data, times = table.column("weights"), table.column("tokens").to_numpy()
        total = sum(np.frombuffer(d.as_py(), np.float32) * np.float32(k / times.sum()) for d, k in zip(data, times.tolist(), strict=True))
        return pa.table({"weights": pa.array([total.astype(np.float32).tobytes()], pa.binary()), "tokens": pa.array([int(times.sum())], pa.int64())})

    sums, whole = None, 0
    merged = replicas.withColumn("_g", F.pmod(F.xxhash64("weights"), F.lit(groups))).groupBy("_g").applyInArrow(run, "weights binary, tokens long")
    for r in merged.toLocalIterator():
        more = np.frombuffer(bytes(r["weights"]), np.float32).astype(np.float64) * r["tokens"]
        sums, whole = more if sums is None else sums + more, whole + r["tokens"]
    return w if not whole else _unpacked((sums / whole).astype(np.float32).tobytes(), w)


class Fitted:
    """What scoring needs: counts (a written table), their totals, the frequent tokens and the network."""

    def __init__(self, table: DataFrame, total: int, distinct: int, head: list[bytes], known: dict[bytes, int], masses: list[int], weights: dict):
        self.table, self.total, self.distinct, self.head, self.known, self.masses, self.weights = table, total, distinct, head, known, masses, weights


def _frequent(table: DataFrame) -> dict[bytes, int]:
    """Counts of the end and of the most frequent short tokens: of whole bands of counts, KNOWN tokens at most."""
    short = table.filter((F.length("token") <= KNOWN_BYTES) & (F.col("token") != F.lit(END))).withColumn("_band", F.floor(F.log2("c") * 16))
    least, n = math.inf, 0
    for r in sorted(short.groupBy("_band").count().collect(), reverse=True):  # 16 bands for each power of two
        n += r["count"]
        if n > KNOWN:
            break
        least = r["_band"]
    rows = table.filter(F.col("token") == F.lit(END)).select("token", "c").collect()
    if least < math.inf:
        rows += short.filter(F.col("_band") >= least).select("token", "c").collect()
    return {bytes(r["token"]): r["c"] for r in rows}


def fit(train_rows: DataFrame) -> Fitted:
    """Counts over all of train_rows (doc_id, text) and the network trained on all of them, share by share."""
    table = materialise(counts(train_rows), "counts")
    total, distinct = table.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    known = _frequent(table)
    head = sorted(known, key=lambda x: (x != END, -known[x], x))[:HEAD]  # the end always has a place of its own
    masses = [1] * TAIL  # one for the unknown words of each class
    outside = table.select("token", "c", _tail_class().alias("k")).groupBy("k").agg(F.sum(F.col("c") + 1).alias("m")).collect()
    for r in outside:
        masses[r["k"]] += int(r["m"])
    for x in head:
        masses[tail_class(x)] -= known[x] + 1
    w = initial([known[x] for x in head], masses)
    if total:
        place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / (1 << 20)
        rows = train_rows.select("text", place.alias("_place"))
        warm = rows.filter(F.col("_place") < min(1.0, WARM_TOKENS / total)).repartition(1)
        w = _averaged(_replicas(warm, w, head, WARM_RATE, WARM_LANES, "warm"), w)
        share = min(1.0, max(1 / ROUNDS, LEAST_TOKENS / total))
        for k in range(ROUNDS):
            lo = 1 - share * (k + 1) if share * (k + 1) <= 1 else 0.0
            part = rows.filter((F.col("_place") >= lo) & (F.col("_place") < lo + share))
            w = _averaged(_replicas(part, w, head, RATE, LANES, f"round{k}"), w)
    return Fitted(table, int(total), int(distinct), head, known, masses, w)


def score(docs: DataFrame, fitted: Fitted) -> DataFrame:
    """docs' columns doc_id and held_out, n_tokens, n_known, train_tokens, base_score, score."""
    shared = docs.sparkSession.sparkContext.broadcast((fitted.head, fitted.known, fitted.masses, fitted.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, known, masses, w = shared.value
        in_head = set(head)
        codes = Codes(head, [x for x in known if x not in in_head])
        logs = np.log10(np.array([known[x] for x in codes.ranked.to_pylist()], float) + 1)
        masses = np.concatenate([np.zeros(HEAD), np.log10(np.array(masses, float))])
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            n_known, plain, tail = np.full(n, int(END in known)), np.full(n, math.log10(known.get(END, 0) + 1)), np.full(n, -float(masses[codes.end]))
            held: list[tuple[np.ndarray, pa.Array, np.ndarray]] = [(np.empty(0, np.int64), pa.array([], pa.binary()), np.empty(0, np.int64))]

            def note(first: int, distinct: pa.Array, index: np.ndarray, sizes: np.ndarray, code: np.ndarray, rank: np.ndarray) -> None:
                here, of = slice(first, first + len(sizes)), np.repeat(np.arange(len(sizes)), sizes)
                mine = np.append(logs, 0.0)[rank]  # rank -1: the last
                outside = np.where(rank < codes.heads, 0, mine) - masses[code]
                n_known[here] += np.bincount(of[(rank >= 0)[index]], minlength=len(sizes))
                plain[here] += np.bincount(of, mine[index], len(sizes))
                tail[here] += np.bincount(of, outside[index], len(sizes))
                rare = (rank < 0)[index]
                pairs, times = np.unique(of[rare] * np.int64(max(1, len(distinct))) + index[rare], return_counts=True)
                held.append((pairs // max(1, len(distinct)) + first, distinct.take(pa.array(pairs % max(1, len(distinct)))), times))

            texts = codes.of(batch.column("text"), note)
            rows, rest, times = (list(x) for x in zip(*held, strict=True))
            cuts = pa.array(np.searchsorted(np.concatenate(rows), np.arange(n + 1)), pa.int32())  # rows ascend
            likely = log_likelihood(w, texts) / math.log(10) + tail
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("_uid", "doc_id", "held_out")), pa.array([len(c) for c in texts], pa.int64()), pa.array(n_known, pa.int64()),
                 pa.array(plain, pa.float64()), pa.array(likely, pa.float64()),
                 pa.ListArray.from_arrays(cuts, pa.concat_arrays(rest)), pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(times), pa.int64()))],
                ["_uid", "doc_id", "held_out", "n_tokens", "n_known", "plain", "likely", "rest", "times"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"_uid long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, plain double, likely double, rest array<binary>, times array<long>"
    base = materialise(with_uid(docs.select("doc_id", "text", "held_out")).select("_uid", "doc_id", "held_out", "text").mapInArrow(tidy(run), schema), "scored")
    rare = base.select("_uid", F.explode(F.arrays_zip("rest", "times")).alias("r")).select("_uid", F.col("r.rest").alias("token"), F.col("r.times").alias("k"))
    rare = rare.join(fitted.table, "token").groupBy("_uid").agg(F.sum("k").alias("_k"), F.sum(F.col("k") * F.log10(F.col("c") + 1)).alias("_s"))
    none = F.coalesce("_s", F.lit(0.0))
    whole = math.log10(fitted.total + fitted.distinct + 1)
    return base.drop("rest", "times").join(rare, "_uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("_k", F.lit(0))).alias("n_known"), F.lit(fitted.total).cast("long").alias("train_tokens"),
        (F.col("plain") + none - F.col("n_tokens") * F.lit(whole)).alias("base_score"), (F.col("likely") + none).alias("score"),
    )


def score_all(docs: DataFrame, modulus: int = 7, remainder: int = 2) -> DataFrame:
    """Fit on the documents whose crc32(doc_id) mod ``modulus`` is not ``remainder``, score all."""
    rows = docs.select("doc_id", "text", (fold(F.col("doc_id"), modulus) == remainder).alias("held_out"))
    return score(rows, fit(rows.filter(~F.col("held_out"))))
