"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read as UTF-8 bytes, in segments of ``SEGMENT`` bytes; every byte of the text lies
in one.  One network reads a segment forwards, one backwards; gates and candidates are
clipped linear functions, so that no exponentials are needed per byte.  The two states of a
position give the probabilities of its language, and a document's probabilities are the mean
over all its positions.

    z, r = clip(E x + U h, 0, 1)      n = clip(E x + r * (U h), -1, 1)      h = z h + (1 - z) n

Training is plain numpy: backpropagation through time over a bounded sample of labelled
texts - about ``SAMPLE_ROWS`` documents of every language, those whose hashed id is lowest,
and ``SAMPLE_SEGMENTS`` segments of each.  Prediction shuffles nothing and holds one block of
segments at a time, whatever the length of a text.

A null text, or one without a letter, is ``und`` with score 0; so is everything if no label
was learnt.  Repeated rows are labelled one by one.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNKNOWN = "und"
SAMPLE_ROWS = 500
#: Range of the hashed ids that a share of a language is taken from; a share of 500 rows is
#: above zero up to 4 * 10 ** 18 documents.
HASHES = 1 << 53
SAMPLE_SEGMENTS = 4
SEGMENT = 128
HIDDEN = 8
BLOCK = 2048
STEPS = 300
BATCH = 192
PAD = 256  # leaves the state as it is

_LETTER = re.compile(r"[^\W\d_]")
_clip = np.clip


@dataclass
class Direction:
    """Parameters of one reading direction: E (3H, 257) by byte, U (3H, H)."""

    E: np.ndarray
    U: np.ndarray


@dataclass
class Network:
    langs: list[str]
    forward: Direction
    backward: Direction
    W: np.ndarray  # (languages, 2H)
    b: np.ndarray


def new_direction(rng: np.random.Generator, hidden: int, dtype=np.float32) -> Direction:
    E = rng.normal(0, 0.3, (3 * hidden, PAD + 1))
    E[: 2 * hidden] += 0.5
    E[:hidden, PAD] = 1e3
    return Direction(E.astype(dtype), rng.normal(0, 0.4 / np.sqrt(hidden), (3 * hidden, hidden)).astype(dtype))


def read(d: Direction, x: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States (T, H, N) after every byte of x (T, N); the trace is what training needs."""
    T, N = x.shape
    H = d.U.shape[1]
    states = np.empty((T, H, N), d.E.dtype)
    h = np.zeros((H, N), d.E.dtype)
    g, a = np.empty((3 * H, N), d.E.dtype), np.empty((3 * H, N), d.E.dtype)
    for t in range(T):
        if trace is not None:
            g, a = np.empty_like(g), np.empty_like(a)
        np.take(d.E, x[t], axis=1, out=g, mode="clip")
        np.matmul(d.U, h, out=a)
        gates = g[: 2 * H]
        gates += a[: 2 * H]
        _clip(gates, 0, 1, out=gates)
        z, r, n = g[:H], g[H : 2 * H], g[2 * H :]
        m = a[2 * H :]
        if trace is not None:
            trace.append((h, z, r, n, m.copy()))
        m *= r
        n += m
        _clip(n, -1, 1, out=n)
        new = states[t]
        np.subtract(h, n, out=new)
        new *= z
        new += n
        h = new
    return states


def read_back(d: Direction, x: np.ndarray, trace: list, slopes: np.ndarray) -> Direction:
    """Gradients of E and U from the slopes (T, H, N) of the states."""
    T, N = x.shape
    H = d.U.shape[1]
    dU, dG = np.zeros_like(d.U), np.empty((T, 3 * H, N), d.E.dtype)
    dh = np.zeros((H, N), d.E.dtype)
    for t in range(T - 1, -1, -1):
        h, z, r, n, m = trace[t]
        dh = dh + slopes[t]
        own = dG[t]
        own[:H] = dh * (h - n) * ((z > 0) & (z < 1))
        dn = dh * (1 - z) * (np.abs(n) < 1)
        own[H : 2 * H] = dn * m * ((r > 0) & (r < 1))
        own[2 * H :] = dn
        da = own.copy()
        da[2 * H :] *= r
        dU += da @ h.T
        dh = dh * z + d.U.T @ da
    dE = np.stack([np.bincount(x.ravel(), dG[:, k].ravel(), minlength=PAD + 1) for k in range(3 * H)])
    dE[:, PAD] = 0
    return Direction(dE.astype(d.E.dtype), dU)


def probabilities(net: Network, x: np.ndarray) -> np.ndarray:
    """Probabilities (T, languages, N) of every position of x (T, N)."""
    H = net.forward.U.shape[1]
    logits = np.matmul(net.W[:, :H], read(net.forward, x))
    logits += np.matmul(net.W[:, H:], read(net.backward, x[::-1])[::-1])
    logits += net.b[:, None]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def loss_and_slopes(net: Network, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all bytes of x (T, N) of language y (N), and all gradients."""
    H = net.forward.U.shape[1]
    ahead, back = [], []
    back_x = x[::-1]
    states = np.concatenate([read(net.forward, x, ahead), read(net.backward, back_x, back)[::-1]], axis=1)
    logits = np.matmul(net.W, states) + net.b[:, None]
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=1, keepdims=True)
    held = x != PAD
    total = max(1, held.sum())
    N = x.shape[1]
    loss = -float((np.log(p[:, y, np.arange(N)] + 1e-30) * held).sum() / total)
    p[:, y, np.arange(N)] -= 1
    p *= held[:, None, :] / total
    p = p.astype(net.W.dtype)
    dW = np.einsum("tln,thn->lh", p, states)
    ds = np.matmul(net.W.T, p)
    f = read_back(net.forward, x, ahead, ds[:, :H])
    r = read_back(net.backward, back_x, back, ds[::-1, H:])
    return loss, [f.E, f.U, r.E, r.U, dW, p.sum(axis=(0, 2))]


def train(segments: np.ndarray, languages: np.ndarray, langs: list[str], steps: int = STEPS, seed: int = 7) -> Network:
    """Adam over random batches, each holding as many segments of every language."""
    rng = np.random.default_rng(seed)
    net = Network(
        langs,
        new_direction(rng, HIDDEN),
        new_direction(rng, HIDDEN),
        rng.normal(0, 0.3, (len(langs), 2 * HIDDEN)).astype(np.float32),
        np.zeros(len(langs), np.float32),
    )
    own = [np.flatnonzero(languages == k) for k in range(len(langs))]
    values = [net.forward.E, net.forward.U, net.backward.E, net.backward.U, net.W, net.b]
    mean, square = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(o, max(1, BATCH // len(langs))) for o in own])
        _, slopes = loss_and_slopes(net, segments[chosen].T.astype(np.intp), languages[chosen])
        rate = 0.02 * min(1.0, 2.0 * (1 - step / (steps + 1)))
        size = np.sqrt(sum(float((s**2).sum()) for s in slopes))
        for v, s, m, q in zip(values, slopes, mean, square):
            s = s / max(1.0, size)
            m += 0.1 * (s - m)
            q += 0.01 * (s * s - q)
            v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(q / (1 - 0.99**step)) + 1e-6)
    return net


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All segments (S, SEGMENT) of the texts, padded, and the text each belongs to."""
    lengths = np.array([len(t) for t in texts], np.int64)
    counts = -(-lengths // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), counts)
    flat = np.full(int(counts.sum()) * SEGMENT, PAD, np.int16)
    place = np.repeat((np.cumsum(counts) - counts) * SEGMENT - (np.cumsum(lengths) - lengths), lengths)
    flat[place + np.arange(len(place))] = np.frombuffer(b"".join(texts), np.uint8)
    return flat.reshape(-1, SEGMENT), owner


def document_probabilities(net: Network, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every text the mean probabilities (texts, languages), and the shares of its
    positions that bear each label."""
    sums = np.zeros((len(texts), len(net.langs)))
    labels = np.zeros_like(sums)
    lengths = np.maximum(1, [len(t) for t in texts])
    first = 0
    while first < len(texts):  # texts of about a block of segments at a time
        last, room = first, BLOCK * SEGMENT
        while last < len(texts) and (last == first or room >= len(texts[last])):
            room -= len(texts[last])
            last += 1
        segments, owner = cut(texts[first:last])
        for a in range(0, len(segments), BLOCK):
            x = np.ascontiguousarray(segments[a : a + BLOCK].T).astype(np.intp)
            p = probabilities(net, x)
            p *= (x != PAD)[:, None, :]
            top = p.max(axis=1, keepdims=True)
            np.add.at(sums, first + owner[a : a + BLOCK], p.sum(axis=0).T)
            np.add.at(labels, first + owner[a : a + BLOCK], ((p == top) & (top > 0)).sum(axis=0).T)
        first = last
    return sums / lengths[:, None], labels / lengths[:, None]


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few segments of every sampled text, spread over its length."""
    for batch in batches:
        langs, found = [], []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = _bytes(text)
            last = max(0, len(data) - SEGMENT)
            for start in sorted({last * i // SAMPLE_SEGMENTS for i in range(SAMPLE_SEGMENTS)}):
                if part := data[start : start + SEGMENT]:
                    langs.append(lang)
                    found.append(part)
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.binary())], ["lang", "part"])


def share(rows: int, n: int) -> int:
    """How many of ``HASHES`` take about ``rows`` of ``n`` rows, one at least."""
    return -(-HASHES * min(rows, n) // n)


def fit(
    docs: DataFrame,
    usable: Callable[[Column], Column] = lambda key: F.lit(True),
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rows: int = SAMPLE_ROWS,
) -> Network | None:
    """The network learnt from documents with a language whose key is ``usable``."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.col(text) != "") & usable(F.col(key)))
    counts = sorted((r[0], r[1]) for r in known.groupBy(lang).count().collect())  # one row per language
    if not counts:
        return None
    # a share of each language by hashed id: all of a rare one, about ``rows`` of a common one
    rate = F.lit(0)
    for name, n in counts:
        rate = F.when(F.col(lang) == name, share(rows, n)).otherwise(rate)
    chosen = known.where(F.pmod(F.xxhash64(key), F.lit(HASHES)) < rate)
    parts = chosen.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(
        _segments, "lang string, part binary"
    )
    table = parts.toArrow()
    langs = sorted(set(table["lang"].to_pylist()))
    if not langs:
        return None
    pairs = sorted(zip(table["lang"].to_pylist(), table["part"].to_pylist()))
    segments, _ = cut([p for _, p in pairs])
    return train(segments, np.array([langs.index(name) for name, _ in pairs]), langs)


def predict(docs: DataFrame, net: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score, position_share`` of every row; the share is that of the
    positions whose own label is the document's."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if t and _LETTER.search(t) else "" for t in batch.column(1).to_pylist()]
            found = [(UNKNOWN, 0.0, 0.0)] * len(texts)
            if net:
                p, shares = document_probabilities(net, [_bytes(t) for t in texts])
                best = p.argmax(axis=1)
                for i, t in enumerate(texts):
                    if t:
                        k = best[i]
                        found[i] = (net.langs[k], min(1.0, float(p[i, k])), min(1.0, float(shares[i, k])))
            kinds = (pa.string(), pa.float64(), pa.float64())
            columns = [pa.array([f[j] for f in found], kind) for j, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["k0", "lang_pred", "score", "position_share"])

    rows = docs.select(F.col(key).alias("k0"), F.col(text).alias("text"))
    kind = rows.schema["k0"].dataType.simpleString()
    found = rows.mapInArrow(label, f"k0 {kind}, lang_pred string, score double, position_share double")
    return found.select(F.col("k0").alias(key), "lang_pred", "score", "position_share")
