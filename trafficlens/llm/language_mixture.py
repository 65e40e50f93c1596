"""Language identification by mixture inference.

A document is a bag of letter trigrams drawn from a mixture of the learned
languages.  Expectation-maximisation estimates the proportions; the language
set is the one with the best penalised likelihood.

Model: trigrams of lower-cased text (letters, with every other run of
characters as one boundary) hashed to ``BUCKETS`` features, counted per
language over *all* training rows.  The table has languages x 65,536 numbers,
however large the corpus is; more than ``MAX_LANGUAGES`` values of ``lang`` are
no languages and raise an error.

Defined cases: a null text, an empty text or one without letters is ``und``
with score 0.0; with no training rows at all every text is ``und``; ties go to
the language that sorts first; rows are never merged, so repeated rows give
repeated results; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, trimmed

BUCKETS = 1 << 16
MAX_LANGUAGES = 128  # half a megabyte each in every task
BLOCK = 1 << 20  # characters handled at once; the whole text is covered
UNDETERMINED = "und"
ADDED = "lang_pred string, score double, langs array<string>, shares array<double>"


def letter_table() -> np.ndarray:
    """True for every code point that is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def trigram_hashes(text: str, letters: np.ndarray) -> np.ndarray:
    """One 16-bit feature for each letter of ``text``, in context of its neighbours."""
    low = text.lower()
    found = []
    for start in range(0, len(low), BLOCK):
        # one character of context on either side, so that blocks change nothing
        left = low[start - 1:start] if start else " "
        piece = left + low[start:start + BLOCK] + (low[start + BLOCK:start + BLOCK + 1] or " ")
        code = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "<u4").copy()
        code[~letters[code]] = 0
        middle = code[1:-1]
        h = (code[:-2] * np.uint32(2654435761) + middle * np.uint32(2246822519)
             + code[2:] * np.uint32(3266489917))
        h ^= h >> np.uint32(15)
        h *= np.uint32(2654435769)
        found.append((h >> np.uint32(16))[middle != 0].astype(np.uint16))
    return np.concatenate(found) if found else np.empty(0, np.uint16)


def train(docs: DataFrame, is_training) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and their trigram probabilities (languages x BUCKETS)."""

    def count(batches):
        letters = letter_table()
        total: dict[str, np.ndarray] = {}
        held: dict[str, list[np.ndarray]] = {}

        def add(lang):
            total.setdefault(lang, np.zeros(BUCKETS, np.int64))
            total[lang] += np.bincount(np.concatenate(held.pop(lang)), minlength=BUCKETS)

        for b in batches:
            for lang, text in zip(b.column("lang"), b.column("text")):
                parts = held.setdefault(lang.as_py(), [])
                parts.append(trigram_hashes(text.as_py(), letters))
                if len(parts) >= 64 or len(parts[-1]) >= BLOCK:
                    add(lang.as_py())
        for lang in list(held):
            add(lang)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "bucket": at.astype(np.int32), "n": n[at]})

    rows = docs.where(is_training & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = (rows.select("lang", "text").mapInArrow(trimmed(count), "lang string, bucket int, n bigint")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
              .groupBy("lang").agg(F.collect_list("bucket").alias("at"), F.collect_list("n").alias("n"))
              .limit(MAX_LANGUAGES + 1).collect())
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in the training rows")
    counts.sort(key=lambda r: r["lang"])
    model = np.full((len(counts), BUCKETS), 0.5)
    for k, r in enumerate(counts):
        model[k, r["at"]] += r["n"]
    return [r["lang"] for r in counts], model / model.sum(1, keepdims=True)


def proportions(p: np.ndarray, n: np.ndarray, rounds: int, tol: float) -> tuple[np.ndarray, float]:
    """EM for the mixture weights of the rows of ``p``; the final log-likelihood."""
    pi, total = np.full(len(p), 1.0 / len(p)), n.sum()
    for _ in range(rounds):
        new = pi * (p @ (n / (pi @ p))) / total
        moved = np.abs(new - pi).max()
        pi = new
        if moved < tol:
            break
    return pi, float(n @ np.log(pi @ p))


def infer(hashes: np.ndarray, model: np.ndarray, penalty: float, rounds: int = 40,
          tol: float = 1e-4) -> list[tuple[int, float]]:
    """(language, share) of the selected set, largest share first.

    Candidate sets are the first 1, 2, ... languages by their share under the
    full mixture (the single-language candidate is the likeliest one).  Every
    further language must raise the log-likelihood by ``penalty * ln(n)``.
    """
    s = np.sort(hashes, kind="stable")
    edge = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    n = np.diff(np.r_[edge, len(s)]).astype(float)
    p = model[:, s[edge]]
    alone = np.log(p) @ n
    best = [(int(alone.argmax()), 1.0)]
    if len(model) == 1:
        return best
    value, cost = alone.max(), penalty * np.log(len(s) + 1)
    full, _ = proportions(p, n, rounds, tol)
    order = np.argsort(-full, kind="stable")
    for size in range(2, len(model) + 1):
        chosen = np.sort(order[:size])
        pi, ll = proportions(p[chosen], n, rounds, tol)
        if ll - cost <= value:
            break
        value = ll - cost
        cost += penalty * np.log(len(s) + 1)
        best = sorted(((int(k), float(x)) for k, x in zip(chosen, pi)), key=lambda kx: (-kx[1], kx[0]))
    return best


def identify(docs: DataFrame, langs: list[str], model: np.ndarray, penalty: float = 4.0,
             keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``lang_pred, score, langs, shares`` for every row.

    ``score`` is the share of the leading language.
    """
    def start():
        letters = letter_table()

        def f(texts):
            pred, top, names, shares = [], [], [], []
            for text in texts:
                h = trigram_hashes(text, letters) if text else ()
                found = infer(h, model, penalty) if len(h) and langs else []
                pred.append(langs[found[0][0]] if found else UNDETERMINED)
                top.append(min(1.0, found[0][1]) if found else 0.0)
                names.append([langs[k] for k, _ in found])
                shares.append([x for _, x in found])
            return pred, top, names, shares

        return f

    src = docs.select(*[F.col(c) for c in keep], F.col("text").alias("__text"))
    return add_columns(src, ["__text"], ADDED, start, drop=["__text"])
