"""Personal data: fixed patterns, and a character-level BiLSTM with CRF transitions trained in numpy."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")
SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
]))

# ---------------------------------------------------------------- fixed patterns

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that starts inside a run of digits ends as one that starts with the run, so only starts of
# runs are tried; parts are taken whole.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and a domain with a dot, in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
            done = domain.end()
        else:
            # No match can start at or before this sign.
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the fixed patterns, by kind as listed, then start."""
    found = [("email", *span) for span in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        # Longer runs fail; they are not worth copying.
        if m.end() - m.start() <= 37:
            digits = _DIGITS.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


# ---------------------------------------------------------------- the model

# Classes of characters: printable ASCII one by one, then white space, other letters, other digits,
# all else, and what lies outside of the text.
_SPACE, _LETTER, _DIGIT, _OTHER, _OUTSIDE = range(95, 100)
CLASSES = 100
TAGS = 1 + len(KINDS)
HIDDEN = 10
# Windows that are decoded, what neighbours share, and windows that are decoded at a time.
WINDOW, OVERLAP, BATCH = 320, 64, 1024
# Characters of a text that are cut into windows at a time.
BLOCK_CHARS = 1 << 19
# Training: rows at most (drawn by a hash of the doc_id), windows, their length, passes.
TRAIN_ROWS, TRAIN_WINDOWS, TRAIN_CHARS, PASSES = 6_000, 1_500, 64, 8
# Spans of each kind, and other places, of a drawn row.
TRAIN_SPANS, TRAIN_PLACES = 2, 3


def _class_table() -> np.ndarray:
    table = np.full(0x2000, _OTHER, np.uint8)
    for code in range(len(table)):
        c = chr(code)
        table[code] = code - 32 if 32 <= code < 127 else _SPACE if c.isspace() else _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _OTHER
    return table


_CLASS = _class_table()


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < len(_CLASS), _CLASS[np.minimum(codes, len(_CLASS) - 1)], _LETTER).astype(np.uint8)


@dataclass
class Net:
    """Two LSTMs (``x``: input and bias per class, ``u``: recurrence; forward, backward), emissions
    ``v`` and ``e``, and transitions ``a`` (from, to).

    Gates and states are bounded by clipping; rows of ``x`` and ``u``: input, forget and output gate,
    then the new state.
    """

    x: np.ndarray
    u: np.ndarray
    v: np.ndarray
    e: np.ndarray
    a: np.ndarray


def _parts(net: Net) -> tuple[np.ndarray, ...]:
    """What is sent to the executors, as a broadcast names classes by module."""
    return net.x, net.u, net.v, net.e, net.a


def new_net(rng: np.random.Generator, hidden: int = HIDDEN) -> Net:
    x = rng.normal(0, 0.3, (2, 4 * hidden, CLASSES))
    x[:, : 3 * hidden] = x[:, : 3 * hidden] * 0.25 + 0.5
    x[:, hidden : 2 * hidden] += 0.25
    u = rng.normal(0, 0.3 / np.sqrt(hidden), (2, 4 * hidden, hidden))
    return Net(x, u, rng.normal(0, 0.3, (TAGS, 2 * hidden)), np.array([1.0, *[-0.25] * (TAGS - 1)])[:, None], np.eye(TAGS) * 1.0)


def run_lstm(x: np.ndarray, u: np.ndarray, codes: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """States (time, hidden, batch) of one direction over ``codes`` (time, batch).

    ``keep`` collects what the gradient needs.
    """
    steps, batch = codes.shape
    hidden = u.shape[1]
    low = np.zeros((4 * hidden, 1), x.dtype)
    low[3 * hidden :] = -1
    states = np.zeros((steps, hidden, batch), x.dtype)
    c, h = np.zeros((hidden, batch), x.dtype), np.zeros((hidden, batch), x.dtype)
    gates, recurrent, part = (np.empty((4 * hidden, batch), x.dtype) for _ in range(2)), None, np.empty_like(c)
    gates, recurrent = gates
    for t in range(steps):
        np.take(x, codes[t], axis=1, out=gates, mode="clip")
        np.matmul(u, h, out=recurrent)
        gates += recurrent
        if keep is not None:
            keep.setdefault("raw", []).append(gates.copy())
            keep.setdefault("c_before", []).append(c.copy())
        np.maximum(gates, low, out=gates)
        np.minimum(gates, 1, out=gates)
        c *= gates[hidden : 2 * hidden]
        np.multiply(gates[:hidden], gates[3 * hidden :], out=part)
        c += part
        h = states[t]
        np.clip(c, -1, 1, out=h)
        h *= gates[2 * hidden : 3 * hidden]
        if keep is not None:
            keep.setdefault("gates", []).append(gates.copy())
            keep.setdefault("c", []).append(c.copy())
    return states


def emissions(net: Net, codes: np.ndarray) -> np.ndarray:
    """(time, tags, batch)."""
    forward = run_lstm(net.x[0], net.u[0], codes)
    backward = run_lstm(net.x[1], net.u[1], codes[::-1])[::-1]
    hidden = net.u.shape[2]
    return np.matmul(net.v[:, :hidden], forward) + np.matmul(net.v[:, hidden:], backward) + net.e


# Slope of a clipped unit outside of its bounds, so that it can come back.
_LEAK = 0.05


def _lstm_gradient(u: np.ndarray, codes: np.ndarray, states: np.ndarray, keep: dict, dh_all: np.ndarray):
    steps, hidden, batch = states.shape
    dx, du = np.zeros((CLASSES, 4 * hidden)), np.zeros_like(u)
    dh, dc = np.zeros((hidden, batch)), np.zeros((hidden, batch))
    low = np.zeros((4 * hidden, 1))
    low[3 * hidden :] = -1
    for t in range(steps - 1, -1, -1):
        raw, gates, c, before = keep["raw"][t], keep["gates"][t], keep["c"][t], keep["c_before"][t]
        i, f, o, g = (gates[k * hidden : (k + 1) * hidden] for k in range(4))
        dh = dh + dh_all[t]
        dc = dc + dh * o * np.where(np.abs(c) < 1, 1, _LEAK)
        d = np.concatenate((dc * g, dc * before, dh * np.clip(c, -1, 1), dc * i))
        d *= np.where((raw > low) & (raw < 1), 1, _LEAK)
        np.add.at(dx, codes[t], d.T)
        du += d @ (states[t - 1].T if t else np.zeros((batch, hidden)))
        dh, dc = u.T @ d, dc * f
    return dx.T, du


def _log_sum(scores: np.ndarray, axis: int) -> np.ndarray:
    top = scores.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(scores - top).sum(axis=axis))


def loss_and_gradient(net: Net, codes: np.ndarray, tags: np.ndarray) -> tuple[float, Net]:
    """Mean negative log likelihood of ``tags`` (time, batch) under the CRF, and its gradient."""
    steps, batch = codes.shape
    hidden = net.u.shape[2]
    keeps = ({}, {})
    forward = run_lstm(net.x[0], net.u[0], codes, keeps[0])
    back_states = run_lstm(net.x[1], net.u[1], codes[::-1], keeps[1])
    backward = back_states[::-1]
    scores = np.matmul(net.v[:, :hidden], forward) + np.matmul(net.v[:, hidden:], backward) + net.e
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    alpha[0] = scores[0]
    for t in range(1, steps):
        alpha[t] = scores[t] + _log_sum(alpha[t - 1][:, None] + net.a[:, :, None], 0)
    for t in range(steps - 2, -1, -1):
        beta[t] = _log_sum(net.a[:, :, None] + (scores[t + 1] + beta[t + 1])[None], 1)
    total = _log_sum(alpha[-1], 0)
    ds = np.exp(alpha + beta - total)
    pairs = np.exp(alpha[:-1, :, None] + net.a[None, :, :, None] + (scores[1:] + beta[1:])[:, None] - total)
    da = pairs.sum(axis=(0, 3))
    at, of = np.meshgrid(np.arange(steps), np.arange(batch), indexing="ij")
    gold = scores[at, tags, of].sum() + net.a[tags[:-1], tags[1:]].sum()
    ds[at, tags, of] -= 1
    np.subtract.at(da, (tags[:-1], tags[1:]), 1)
    ds /= batch
    dv = np.concatenate((np.einsum("tkb,thb->kh", ds, forward), np.einsum("tkb,thb->kh", ds, backward)), axis=1)
    dforward, dbackward = np.matmul(net.v[:, :hidden].T, ds), np.matmul(net.v[:, hidden:].T, ds)
    dx0, du0 = _lstm_gradient(net.u[0], codes, forward, keeps[0], dforward)
    dx1, du1 = _lstm_gradient(net.u[1], codes[::-1], back_states, keeps[1], dbackward[::-1])
    return float((total.sum() - gold) / batch), Net(
        np.stack((dx0, dx1)), np.stack((du0, du1)), dv, ds.sum(axis=(0, 2))[:, None], da / batch
    )


def viterbi(net: Net, scores: np.ndarray) -> np.ndarray:
    """Best tags (time, batch)."""
    steps, tags, batch = scores.shape
    back = np.empty((steps, tags, batch), np.int8)
    best = scores[0]
    for t in range(1, steps):
        ways = best[:, None] + net.a[:, :, None]
        back[t] = ways.argmax(axis=0)
        best = scores[t] + ways.max(axis=0)
    path = np.empty((steps, batch), np.int8)
    path[-1] = best.argmax(axis=0)
    columns = np.arange(batch)
    for t in range(steps - 1, 0, -1):
        path[t - 1] = back[t, path[t], columns]
    return path


def decode_windows(net: Net, codes: np.ndarray) -> np.ndarray:
    """Tags (time, batch).

    Where leaving tag 0 costs more at every character than transitions can ever give back, the best
    path stays at tag 0; the other windows are decoded.
    """
    scores = emissions(net, codes)
    gain = 2 * max(float((net.a.max() - net.a[0, 0])), 0.0)
    margin = (scores[:, :1] - scores[:, 1:]).min(axis=(0, 1))
    unsure = np.flatnonzero(margin <= gain)
    tags = np.zeros(codes.shape, np.int8)
    if len(unsure):
        tags[:, unsure] = viterbi(net, scores[:, :, unsure])
    return tags


# ---------------------------------------------------------------- training

def _variant(kind: str, text: str, rng: np.random.Generator) -> str:
    """Another way to write a span of this kind, with other digits."""
    fresh = "".join(str(rng.integers(0, 10)) if c in "0123456789" else c for c in text)
    pick = int(rng.integers(0, 4))
    if kind == "email":
        return [text, text.upper(), text.replace("@", " @ "), text.replace("@", " (at) ").replace(".", " (dot) ")][pick]
    if kind == "ip":
        parts = [str(rng.integers(1, 256)) for _ in range(4)]
        return [".".join(parts), ".".join(parts), " . ".join(parts), "[.]".join(parts)][pick]
    if kind == "card":
        digits = [str(rng.integers(1, 10))] + [str(rng.integers(0, 10)) for _ in range(14)]
        digits.append(next(d for d in "0123456789" if luhn("".join(digits) + d)))
        groups = ["".join(digits[i : i + 4]) for i in range(0, 16, 4)]
        return [["", " ", "-", "."][pick]][0].join(groups)
    digits = [str(rng.integers(2, 10)) for _ in range(10)]
    area, middle, last = "".join(digits[:3]), "".join(digits[3:6]), "".join(digits[6:])
    return [fresh, f"({area}) {middle}-{last}", f"{area}-{middle}-{last}", f"+{rng.integers(1, 100)} {area} {middle} {last}"][pick]


def _decoy(rng: np.random.Generator) -> str:
    """Numbers and signs that are no personal data."""
    n = lambda k: "".join(str(rng.integers(0, 10)) for _ in range(k))
    return [
        n(4), n(2), f"{n(1)}.{n(3)},{n(2)}", f"20{n(2)}-0{rng.integers(1, 10)}-1{n(1)}", f"{n(1)}.{n(1)}.{n(2)}", f"{n(2)}:{n(2)}",
        f"{n(5)}", f"{n(3)} %", f"#{n(6)}", f"({n(4)})", f"{n(1)}/{n(1)}", "@", "+", f"v{n(1)}.{n(1)}",
    ][int(rng.integers(0, 14))]


def training_windows(texts: list[str], count: int, size: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(codes, tags), both (time, batch): half the windows hold a labelled span, as it is or varied,
    the others none; some get a decoy."""
    rng = np.random.default_rng(seed)
    spans = [(t, *s) for t in texts for s in base_spans(t)]
    by_kind = {k: [s for s in spans if s[1] == k] for k in KINDS}
    plain = [t for t in texts if len(t) > 1] or ["a b"]
    codes, tags = np.full((count, size), _OUTSIDE, np.uint8), np.zeros((count, size), np.int8)
    known = [k for k in KINDS if by_kind[k]]
    for row in range(count):
        if known and row % 2:
            kind = known[(row // 2) % len(known)]
            text, _, begin, end = by_kind[kind][int(rng.integers(0, len(by_kind[kind])))]
            inner = text[begin:end] if rng.random() < 0.4 else _variant(kind, text[begin:end], rng)
            before, after = text[max(0, begin - size) : begin], text[end : end + size]
        else:
            text = plain[int(rng.integers(0, len(plain)))]
            at = int(rng.integers(0, len(text)))
            kind, inner = None, (" " + _decoy(rng) + " ") if rng.random() < 0.5 else ""
            before, after = text[max(0, at - size) : at], text[at : at + size]
        whole = before + inner + after
        marks = np.zeros(len(whole), np.int8)
        # Labels of the text round it; the varied span is known by its place.
        for k, b, e in base_spans(whole):
            marks[b:e] = 1 + KINDS.index(k)
        if kind:
            marks[len(before) : len(before) + len(inner)] = 1 + KINDS.index(kind)
        first = int(np.clip(len(before) - rng.integers(0, max(1, size - min(len(inner), size) + 1)), 0, max(0, len(whole) - size)))
        part = classes(whole[first : first + size])
        codes[row, : len(part)], tags[row, : len(part)] = part, marks[first : first + len(part)]
    return codes.T.copy(), tags.T.copy()


def train(texts: list[str], count: int = TRAIN_WINDOWS, size: int = TRAIN_CHARS, passes: int = PASSES, seed: int = 7) -> Net:
    """A network fitted by Adam to windows of these texts, in 32 bits.  The order of texts is of no
    consequence."""
    codes, tags = training_windows(sorted(texts), count, size, seed)
    rng = np.random.default_rng(seed + 1)
    net = new_net(rng)
    names = ("x", "u", "v", "e", "a")
    first, second = ({n: np.zeros_like(getattr(net, n)) for n in names} for _ in range(2))
    step, batch = 0, 100
    steps = passes * (count // batch)
    for _ in range(passes):
        order = rng.permutation(count)
        for i in range(0, count - batch + 1, batch):
            step += 1
            rate = 0.03 * (1 - 0.9 * step / steps)
            gradient = loss_and_gradient(net, codes[:, order[i : i + batch]], tags[:, order[i : i + batch]].astype(np.int64))[1]
            for n in names:
                g = np.clip(getattr(gradient, n), -5, 5)
                first[n] = 0.9 * first[n] + 0.1 * g
                second[n] = 0.99 * second[n] + 0.01 * g * g
                getattr(net, n)[...] -= rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.99**step)) + 1e-6)
    return Net(*(getattr(net, n).astype(np.float32) for n in names))


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Net:
    """A network trained on spans labelled by the fixed patterns in about ``train_rows`` rows at most.

    The rows are drawn by a hash of the doc_id; of each only the surroundings of a few labels of
    each kind and of a few other places, drawn by a hash too, are taken to train on.  Without any labels the network finds nothing
    new.
    """
    part = F.pmod(F.xxhash64(F.lit("pii"), "doc_id"), F.lit(1 << 30))
    drawn = docs.where(part < int((1 << 30) * min(1.0, train_rows / max(docs.count(), 1))))
    return train([r["t"] for r in drawn.select(_surroundings(F.coalesce("text", F.lit(""))).alias("t")).collect()])


def _places(text: str) -> list[tuple[int, int]]:
    """(begin, end) of pieces to train on: round spans of each kind, and elsewhere, drawn by a hash
    of their place from the whole text.  No piece ends within a span."""
    seed = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    drawn = lambda place: zlib.crc32(b"%d" % place, seed)
    spans = base_spans(text)
    pieces = []
    for kind in KINDS:
        own = sorted(((b, e) for k, b, e in spans if k == kind), key=lambda s: (drawn(s[0]), s))
        pieces += own[:TRAIN_SPANS]
    pieces += [(at, at) for at in (drawn(-1 - i) % len(text) for i in range(TRAIN_PLACES))]
    out = []
    for begin, end in pieces:
        begin, end = max(0, begin - TRAIN_CHARS), min(len(text), end + TRAIN_CHARS)
        for _, b, e in spans:
            if b < begin < e:
                begin = b
            if b < end < e:
                end = e
        out.append((begin, end))
    # Pieces that overlap are one.
    return [(b, e) for _, b, e in _united([("", *piece) for piece in out])]


@F.pandas_udf(T.StringType())
def _surroundings(texts: pd.Series) -> pd.Series:
    """At most a few thousand characters to train on."""

    def part(text: str) -> str:
        if len(text) <= 6 * TRAIN_CHARS:
            return text
        # A line feed is part of no span.
        return "\n".join(text[b:e] for b, e in _places(text))

    return texts.map(part)


# ---------------------------------------------------------------- finding

_GOES_BEFORE = re.compile(r"[0-9][+.\-]?$")
_GOES_ON = re.compile(r"[.\-]?[0-9]")


def _cut_out(text: str, begin: int, end: int) -> bool:
    """Whether a number goes on beyond the span: with a digit, or with a sign and a digit."""
    before, after = text[max(begin - 2, 0) : begin], text[end : end + 2]
    return bool(_GOES_BEFORE.search(before) or _GOES_ON.match(after))


def _fits(kind: str, whole: str, begin: int, end: int) -> bool:
    """What any span of a kind must have, however it is written."""
    text = whole[begin:end]
    if kind != "email" and _cut_out(whole, begin, end):
        return False
    digits = _DIGITS.sub("", text)
    if kind == "email":
        return bool(re.search(r"[A-Za-z0-9]\s*(?:@|\(at\)|\[at\])\s*[A-Za-z0-9]", text, re.I)) and bool(re.search(r"\.|\(dot\)|\[dot\]", text))
    if kind == "ip":
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts) and not re.search(r"[A-Za-z]", text)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits) and bool(re.fullmatch(r"[0-9][0-9 .\-]+[0-9]", text))
    return 8 <= len(digits) <= 15 and bool(re.fullmatch(r"[+(]?[0-9][0-9 ().\-]+[0-9]", text))


def _trimmed(text: str, begin: int, end: int) -> tuple[int, int]:
    """The span without blanks, and without marks that do not belong to it, at its ends."""
    while begin < end and text[begin] not in "+(" and not text[begin].isalnum():
        begin += 1
    while end > begin and not text[end - 1].isalnum():
        end -= 1
    return begin, end


def _runs(tags: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(window, tag, begin, end) of runs of one tag other than 0."""
    hot = np.flatnonzero(tags.any(axis=0))
    for w in hot.tolist():
        row = tags[:, w]
        edges = np.flatnonzero(np.diff(row, prepend=0, append=0))
        for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if row[begin]:
                yield w, int(row[begin]), begin, end


def _united(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """What the overlapping spans of a kind cover together."""
    out: list[tuple[str, int, int]] = []
    for kind, begin, end in sorted(spans):
        if out and out[-1][0] == kind and begin < out[-1][2]:
            out[-1] = (kind, out[-1][1], max(end, out[-1][2]))
        else:
            out.append((kind, begin, end))
    return out


def model_spans(net: Net, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Spans that the network finds in whole texts.

    Texts are cut into overlapping windows, which are decoded apart; round a run that reaches an edge
    within the text another window is decoded.  What windows find in their common part is settled
    for the whole text: runs of a kind that overlap are united, and of overlapping spans the longest
    that fits its kind stays (then the first).
    """
    edges: set[tuple[int, int]] = set()
    found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    codes, owners, size = [], [], 0
    stride = WINDOW - OVERLAP

    def flush() -> None:
        if not owners:
            return
        joined = np.concatenate([*codes, np.full(WINDOW, _OUTSIDE, np.uint8)])
        starts = np.array([o[2] for o in owners])
        lengths = np.array([o[3] for o in owners])
        for i in range(0, len(owners), BATCH):
            at = starts[i : i + BATCH]
            steps = np.arange(int(lengths[i : i + BATCH].max()))[:, None]
            part = np.where(steps < lengths[i : i + BATCH], joined[at + steps], _OUTSIDE)
            for w, tag, begin, end in _runs(decode_windows(net, part)):
                text, offset, _, length = owners[i + w]
                if begin < length:
                    begin, end = offset + begin, offset + min(end, length)
                    found[text].append((KINDS[tag - 1], begin, end))
                    if begin == offset > 0:
                        edges.add((text, max(0, end + OVERLAP - WINDOW)))
                    if end == offset + length < len(texts[text]):
                        edges.add((text, max(0, begin - OVERLAP)))
        codes.clear()
        owners.clear()

    for number, text in enumerate(texts):
        for block in range(0, max(len(text) - OVERLAP, 1), BLOCK_CHARS):
            part = text[block : block + BLOCK_CHARS + OVERLAP]
            if not part:
                continue
            codes.append(classes(part))
            for offset in range(0, max(len(part) - OVERLAP, 1), stride):
                owners.append((number, block + offset, size + offset, min(WINDOW, len(part) - offset)))
            size += len(part)
            if size >= BLOCK_CHARS:
                flush()
                size = 0
    flush()
    again = sorted(edges)
    for i in range(0, len(again), BATCH):
        group = again[i : i + BATCH]
        part = np.full((WINDOW, len(group)), _OUTSIDE, np.uint8)
        for w, (number, offset) in enumerate(group):
            own = classes(texts[number][offset : offset + WINDOW])
            part[: len(own), w] = own
        for w, tag, begin, end in _runs(decode_windows(net, part)):
            number, offset = group[w]
            end = min(offset + end, len(texts[number]))
            if offset + begin < end:
                found[number].append((KINDS[tag - 1], offset + begin, end))
    for number, spans in enumerate(found):
        spans += _united(spans)
        # The spans that stay do not overlap, so their begins and ends are both in order.
        begins, ends, kept = [], [], []
        text = texts[number]
        tidy = {(kind, *_trimmed(text, begin, end)) for kind, begin, end in spans}
        for span in sorted(tidy, key=lambda s: (s[1] - s[2], s[1], s[0])):
            at = bisect_left(ends, span[1] + 1)
            if (at == len(begins) or span[2] <= begins[at]) and _fits(span[0], text, span[1], span[2]):
                begins.insert(at, span[1])
                ends.insert(at, span[2])
                kept.append(span)
        found[number] = kept
    return found


def all_spans(text: str, base: list[tuple[str, int, int]], model: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Base spans and those of the model that touch none of them, by kind, then start."""
    # What the base spans cover together, in order.
    held = [(b, e) for _, b, e in _united(sorted(("", b, e) for _, b, e in base))]
    ends = [e for _, e in held]
    added = []
    for kind, begin, end in model:
        at = bisect_left(ends, begin + 1)
        if at == len(held) or end <= held[at][0]:
            added.append((kind, begin, end))
    return sorted([*base, *added], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def find(docs: DataFrame, net: Net) -> DataFrame:
    """(doc_id, base, spans) of each row of ``docs`` (doc_id, text).

    ``base`` are the matches of the fixed patterns, ``spans`` these and what the network adds; both
    are arrays of (kind, start, end) in code points, end exclusive, by kind, then start.  Null and
    empty texts have none.  Repeated rows and rows without doc_id are treated alike.  Other columns
    are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(_parts(net))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    as_rows = lambda spans: [dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = part.column(1).to_pylist()
                base = [base_spans(t) for t in texts]
                spans = [all_spans(*x) for x in zip(texts, base, model_spans(Net(*sent.value), texts), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(map(as_rows, base), kind), pa.array(map(as_rows, spans), kind)],
                    names=["doc_id", "base", "spans"],
                )

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("base", SPANS), T.StructField("spans", SPANS)])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t")).mapInArrow(run, schema)


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, begin, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if begin >= at:
            out += [text[at:begin], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, net: Net) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by [EMAIL], [IP], [CARD] and [PHONE].

    All rows and columns stay; ``n_chars`` follows the text where the column exists.  Null texts
    stay null.
    """
    sent = docs.sparkSession.sparkContext.broadcast(_parts(net))

    @F.pandas_udf(T.StringType())
    def clean(texts: pd.Series) -> pd.Series:
        out: list[str] = []
        for i in range(0, len(texts), 500):
            part = texts.iloc[i : i + 500].tolist()
            for text, model in zip(part, model_spans(Net(*sent.value), part), strict=True):
                out.append(redacted(text, all_spans(text, base_spans(text), model)))
        return pd.Series(out, index=texts.index)

    made = docs.withColumn("__llm_clean", clean(F.coalesce("text", F.lit(""))))
    changed: dict[str, Column] = {"text": F.when(F.col("text").isNull(), F.lit(None)).otherwise(F.col("__llm_clean"))}
    if "n_chars" in docs.columns:
        same = F.coalesce("text", F.lit("")) == F.col("__llm_clean")
        changed["n_chars"] = F.when(same, F.col("n_chars")).otherwise(
            F.length("__llm_clean").cast(docs.schema["n_chars"].dataType)
        )
    return made.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])


def span_text(column: str) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
