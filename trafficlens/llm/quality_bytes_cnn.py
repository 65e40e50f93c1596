"""Quality classifier: a byte-level convolutional network in numpy.

A text is its UTF-8 bytes, cut into overlapping chunks that cover all of it.
Learned byte vectors and filters run over each chunk; every filter is
max-pooled over the chunk; the chunks of a text are combined by the maximum,
mean and minimum of each filter, and a logistic unit turns these into one
probability.

Training takes a bounded sample of labelled rows: at most ``sample_per_class``
documents per label, chosen by hash of the id among those of at most
``sample_bytes`` bytes, each with all its chunks.  Scoring reads every chunk of
every text, however long.

The trained weights are rounded to ``LEVELS`` steps, so that every product and
sum of a filter is an integer below 2 ** 24, which float32 holds exactly in any
order: a text has one score, whatever batch or partition it is scored in.

Defined cases: a null or empty text is one chunk of zero bytes and gets that
chunk's score; when the labels hold fewer than two classes the score is the
constant 0.5, or the only class seen (0.0 or 1.0); conflicting labels of one id
count as the smaller one, and of several texts of one id the least as text is
learned from; ids repeated in the documents are scored per row;
extra columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns

CHUNK, HOP = 512, 384  # bytes; neighbours overlap by a quarter
WIDTH, STRIDE = 8, 4  # bytes seen by a filter; distance of its positions
DIM, FILTERS = 8, 24
POSITIONS = (CHUNK - WIDTH) // STRIDE + 1
PIECE = 4096  # chunks held at once
CONV = 64  # chunks per matrix product
LEVELS = 500  # steps of a rounded weight: WIDTH * DIM * LEVELS ** 2 < 2 ** 24


def chunk_count(n_bytes: int) -> int:
    return max(1, -(-(n_bytes - CHUNK) // HOP) + 1)


def chunks(data: bytes, first: int, last: int) -> np.ndarray:
    """Chunks ``first`` to ``last - 1`` of ``data``, zero-padded, one per row."""
    piece = data[first * HOP:(last - 1) * HOP + CHUNK]
    flat = np.zeros((last - first - 1) * HOP + CHUNK, np.uint8)
    flat[:len(piece)] = np.frombuffer(piece, np.uint8)
    return np.lib.stride_tricks.as_strided(flat, (last - first, CHUNK), (HOP, 1))


def windows(x: np.ndarray, embed: np.ndarray) -> np.ndarray:
    """(chunks, positions, WIDTH * DIM) view of the embedded bytes."""
    e = np.ascontiguousarray(embed[x]).reshape(len(x), CHUNK * DIM)
    s = e.strides
    return np.lib.stride_tricks.as_strided(
        e, (len(x), POSITIONS, WIDTH * DIM), (s[0], STRIDE * DIM * s[1], s[1]))


def activations(x: np.ndarray, net: dict) -> np.ndarray:
    """Max-pooled filters of each chunk, a block of chunks at a time."""
    out = np.empty((len(x), FILTERS))
    for i in range(0, len(x), CONV):
        w = windows(x[i:i + CONV], net["embed"])
        z = w.reshape(-1, WIDTH * DIM) @ net["filters"]
        out[i:i + CONV] = z.reshape(len(w), POSITIONS, FILTERS).max(1)
    return np.maximum(out + net["bias"], 0)


def rounded(net: dict) -> dict:
    """The network with whole-number byte vectors, filters and biases; their unit goes into the last layer."""
    steps = {k: max(float(np.abs(net[k]).max()), 1e-9) / LEVELS for k in ("embed", "filters")}
    unit = steps["embed"] * steps["filters"]
    return {k: np.rint(net[k] / steps[k]).astype(np.float32) for k in steps} | {
        "bias": np.rint(net["bias"].astype(float) / unit), "out": net["out"].astype(float) * unit, "shift": net["shift"].astype(float)}


def probability(datas: list[bytes], net: dict) -> np.ndarray:
    """Score of each text by a rounded network; row by row, no product over several texts."""
    return sigmoid((features(datas, net) * net["out"]).sum(1) + net["shift"])


def pooled(a: np.ndarray, starts: np.ndarray) -> tuple:
    return (np.maximum.reduceat(a, starts), np.add.reduceat(a, starts, dtype=np.float64),
            np.minimum.reduceat(a, starts))


def features(datas: list[bytes], net: dict) -> np.ndarray:
    """Maximum, mean and minimum of every filter over all chunks of each text."""
    n = [chunk_count(len(d)) for d in datas]
    out = np.empty((len(datas), 3 * FILTERS))
    i = 0
    while i < len(datas):
        j, total = i + 1, n[i]
        while j < len(datas) and total + n[j] <= PIECE:
            total += n[j]
            j += 1
        if n[i] > PIECE:  # one long text, piece by piece
            parts = [pooled(activations(chunks(datas[i], k, min(n[i], k + PIECE)), net), np.array([0]))
                     for k in range(0, n[i], PIECE)]
            top, add, low = (np.array([p[k][0] for p in parts]) for k in range(3))
            top, add, low = top.max(0)[None], add.sum(0)[None], low.min(0)[None]
        else:
            x = np.concatenate([chunks(d, 0, c) for d, c in zip(datas[i:j], n[i:j])])
            top, add, low = pooled(activations(x, net), np.cumsum([0] + n[i:j - 1]))
        out[i:j] = np.hstack([top, add / np.array(n[i:j])[:, None], low])
        i = j
    return out


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(samples: list[np.ndarray], y: np.ndarray, epochs: int = 12, batch: int = 32,
        rate: float = 3e-3, seed: int = 7) -> dict:
    """Train the network on lists of chunks by Adam, gradients flowing through the maxima."""
    rng = np.random.default_rng(seed)
    net = {"embed": rng.normal(0, 0.5, (256, DIM)).astype(np.float32),
           "filters": rng.normal(0, (WIDTH * DIM) ** -0.5, (WIDTH * DIM, FILTERS)).astype(np.float32),
           "bias": np.zeros(FILTERS, np.float32),
           "out": rng.normal(0, 0.1, 3 * FILTERS).astype(np.float32), "shift": np.zeros(1, np.float32)}
    first = {k: np.zeros_like(v) for k, v in net.items()}
    second = {k: np.zeros_like(v) for k, v in net.items()}
    # both labels weigh the same in the loss, however rare one is
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(samples))
        for i in range(0, len(order), batch):
            at = order[i:i + batch]
            grad = gradients([samples[k] for k in at], y[at], weight[at], net)
            step += 1
            now = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for k, g in grad.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                net[k] -= now * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return net


def gradients(samples: list[np.ndarray], y: np.ndarray, weight: np.ndarray, net: dict) -> dict:
    n = np.array([len(s) for s in samples])
    starts, doc = np.cumsum(np.r_[0, n[:-1]]), np.repeat(np.arange(len(n)), n)
    x = np.concatenate(samples)
    w = windows(x, net["embed"])
    z = (w.reshape(-1, WIDTH * DIM) @ net["filters"]).reshape(len(x), POSITIONS, FILTERS)
    best = z.argmax(1)
    m = np.take_along_axis(z, best[:, None], 1)[:, 0] + net["bias"]
    a = np.maximum(m, 0)
    top, add, low = pooled(a, starts)
    feats = np.hstack([top, add / n[:, None], low])
    err = weight * (sigmoid(feats @ net["out"] + net["shift"]) - y) / len(y)
    d_top, d_mean, d_low = np.split(err[:, None] * net["out"], 3, 1)
    is_top, is_low = a == top[doc], a == low[doc]
    d_a = (d_mean / n[:, None])[doc]
    d_a = d_a + is_top * (d_top / np.add.reduceat(is_top, starts, dtype=int))[doc]
    d_a = d_a + is_low * (d_low / np.add.reduceat(is_low, starts, dtype=int))[doc]
    d_m = (d_a * (m > 0)).astype(np.float32)
    seen = w[np.arange(len(x))[:, None], best]  # the window behind each maximum
    d_window = (d_m[..., None] * net["filters"].T).reshape(-1, DIM)
    place = best[..., None] * STRIDE + np.arange(WIDTH)
    byte = x[np.arange(len(x))[:, None, None], place].ravel()
    d_embed = np.zeros_like(net["embed"])
    np.add.at(d_embed, byte, d_window)
    return {"embed": d_embed, "filters": np.einsum("cfk,cf->kf", seen, d_m), "bias": d_m.sum(0),
            "out": (feats * err[:, None]).sum(0).astype(np.float32), "shift": err.sum(keepdims=True).astype(np.float32)}


def train(docs: DataFrame, labels: DataFrame, sample_per_class: int = 1500, sample_bytes: int = 200_000) -> dict | float:
    """A rounded network, or a constant score when the labels do not hold both classes.

    ``docs`` (doc_id, text) and ``labels`` (doc_id, quality) are the training rows.
    """
    one = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
           .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    sample = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= sample_bytes).select("doc_id", "text")
    pick = [one.where(F.col("quality") == k).join(sample.select("doc_id").distinct(), "doc_id", "left_semi")
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_per_class) for k in (0, 1)]
    # at most 2 * sample_per_class ids of 12 bytes: a bounded broadcast, and as many texts of sample_bytes for the driver
    rows = (sample.join(F.broadcast(pick[0].unionByName(pick[1])), "doc_id")
            .groupBy("doc_id", "quality").agg(F.coalesce(F.min("text"), F.lit("")).alias("text")).collect())
    rows.sort(key=lambda r: r["doc_id"])
    y = np.array([r["quality"] for r in rows], np.float32)
    if len(set(y.tolist())) < 2:
        return float(y[0]) if len(y) else 0.5
    datas = [r["text"].encode("utf-8", "surrogatepass") for r in rows]
    return rounded(fit([chunks(d, 0, chunk_count(len(d))) for d in datas], y))


def score(docs: DataFrame, net: dict | float, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``score`` (0 to 1) for every row."""

    def start():
        def f(texts):
            if isinstance(net, float):
                return [[net] * len(texts)]
            datas = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
            return [probability(datas, net).tolist()]
        return f

    src = docs.select(*[F.col(c) for c in keep], F.col("text").alias("__text"))
    return add_columns(src, ["__text"], "score double", start, drop=["__text"])
