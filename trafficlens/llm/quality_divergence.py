"""Quality rules by distribution divergence.

Each text is described by a histogram over character classes and one over the
common words of a language.  Both are compared with the references of every
language by Jensen-Shannon distance (square root of the base-2 divergence, 0
to 1); a text far from all references is rejected.  Histograms of texts below
the minimum length are too noisy to judge, so a guard skips the comparison.

References are counted over all rows, in two bounded tables per language: the
character classes, and words hashed to ``BUCKETS`` buckets, of which the
``n_common`` heaviest are the common words and all others one class.  More than
``MAX_LANGUAGES`` values of ``lang`` are no languages and raise an error.

Defined cases: a null or empty text has no words and fails the base rule;
rows with a null language count towards the reference named ``und``; an empty
table has no references, where the comparison is skipped; extra columns are not
read; repeated rows give repeated results.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, trimmed

BUCKETS = 1 << 16
MAX_LANGUAGES = 128  # half a megabyte each in the driver, as much in every task
CLASSES = ("lower", "upper", "digit", "space", "newline", "sentence", "symbol", "mark", "other")
SYMBOLS = "#*$%&|<>"
SENTENCE = ".,;:'\"-?()"
BLOCK = 1 << 20
ADDED = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
         "base_failed boolean, char_distance double, word_distance double, kept boolean")


def class_table() -> np.ndarray:
    """Index into ``CLASSES`` for every code point."""
    out = np.empty(0x110000, np.uint8)
    for c in range(0x110000):
        ch = chr(c)
        if ch == "\n":
            k = 4
        elif ch in " \t\r\x0b\x0c":
            k = 3
        elif ch in SENTENCE:
            k = 5
        elif ch in SYMBOLS:
            k = 6
        elif ch.isalpha():
            k = 1 if ch.isupper() else 0
        elif ch.isdigit():
            k = 2
        else:
            k = 7 if c < 128 else 8
        out[c] = k
    return out


def char_histogram(text: str, table: np.ndarray) -> np.ndarray:
    total = np.zeros(len(CLASSES), np.int64)
    for i in range(0, len(text), BLOCK):
        code = np.frombuffer(text[i:i + BLOCK].encode("utf-32-le", "surrogatepass"), "<u4")
        total += np.bincount(table[code], minlength=len(CLASSES))
    return total


def word_histogram(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the lower-cased words without edge punctuation, and their counts."""
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    edge = SENTENCE.encode()
    at = np.fromiter((zlib.crc32(w.lower().strip(edge)) & (BUCKETS - 1) for w in seen), np.int64, len(seen))
    return at, np.fromiter(seen.values(), np.int64, len(seen))


def repeated_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, n)
    pair = np.unique(ids[:-1] * len(names) + ids[1:], return_inverse=True)[1]
    _, which, count = np.unique(pair[:-1] * len(names) + ids[2:], return_inverse=True, return_counts=True)
    hit = count[which] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= hit
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    seen, n = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\r\x0b\x0c"):
            n += line in seen
            seen.add(line)
    return n


def base_counts(text: str | None) -> tuple[int, int, int, int, int, list[bytes]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the words."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at exactly the six ASCII spaces
    chars = len(text) - sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    symbols = sum(text.count(c) for c in SYMBOLS)
    return len(words), chars, symbols, duplicate_lines(text), repeated_words(words), words


def fails_base(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of histogram ``p`` to each row of ``q`` (both sum to 1)."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0.0).sum(-1)
        b = np.where(q > 0, q * np.log2(q / m), 0.0).sum(-1)
    return np.sqrt(np.clip((a + b) / 2, 0.0, 1.0))


def references(docs: DataFrame, n_common: int = 60) -> dict:
    """Histograms of every language over all rows that pass the base rule."""

    def count(batches):
        table = class_table()
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                n, _, _, _, repeats, words = base_counts(text)
                if fails_base(n, repeats):
                    continue
                t = total.setdefault(lang or "und", np.zeros(BUCKETS + len(CLASSES), np.int64))
                t[BUCKETS:] += char_histogram(text, table)
                at, c = word_histogram(words)
                np.add.at(t, at, c)
        for lang, t in total.items():
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "at": at.astype(np.int32), "n": t[at]})

    rows = (docs.select(F.col("lang").cast("string").alias("lang"), "text")
            .mapInArrow(trimmed(count), "lang string, at int, n bigint")
            .groupBy("lang", "at").agg(F.sum("n").alias("n"))
            .groupBy("lang").agg(F.collect_list("at").alias("at"), F.collect_list("n").alias("n")).limit(MAX_LANGUAGES + 1).collect())
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in the documents")
    chars, words, buckets = [], [], []
    for r in sorted(rows, key=lambda r: r["lang"]):
        full = np.zeros(BUCKETS + len(CLASSES))
        full[r["at"]] = r["n"]
        by = full[:BUCKETS]
        top = np.argsort(-by, kind="stable")[:n_common]
        chars.append(full[BUCKETS:] / full[BUCKETS:].sum())
        words.append(np.append(by[top], by.sum() - by[top].sum()) / by.sum())
        buckets.append(top)
    return {"chars": np.array(chars), "words": np.array(words), "buckets": np.array(buckets, dtype=np.int64)}


def judge(docs: DataFrame, ref: dict, keep: tuple[str, ...] = ("doc_id",), max_char: float = 0.30,
          max_word: float = 0.48, min_chars: int = 200, min_words: int = 50) -> DataFrame:
    """Base counts, the distances to the nearest reference and the verdict per row.

    ``char_distance`` is judged from ``min_chars`` characters on, and
    ``word_distance`` from ``min_words`` words on; below that they are null.
    """
    chars, words, buckets = ref["chars"], ref["words"], ref["buckets"]

    def start():
        table = class_table()
        # slot[k, b]: place of bucket b among the common words of language k
        slot = np.full((len(buckets), BUCKETS), words.shape[1] - 1 if len(words) else 0, np.int64)
        for k, b in enumerate(buckets):
            slot[k, b] = np.arange(len(b))

        def one(text):
            n, length, symbols, dup, repeats, found = base_counts(text)
            failed = fails_base(n, repeats)
            far_char = far_word = None
            if len(chars) and text and len(text) >= min_chars:
                h = char_histogram(text, table)
                far_char = float(js_distance(h / h.sum(), chars).min())
            if len(words) and n >= min_words:
                at, c = word_histogram(found)
                h = np.array([np.bincount(s[at], c, words.shape[1]) for s in slot]) / n
                far_word = float(js_distance(h, words).min())
            kept = not failed and not (far_char is not None and far_char > max_char) \
                and not (far_word is not None and far_word > max_word)
            return n, length, symbols, dup, repeats, failed, far_char, far_word, kept

        return lambda texts: list(zip(*map(one, texts))) if texts else [[]] * 9

    src = docs.select(*[F.col(c) for c in keep], F.col("text").alias("__text"))
    return add_columns(src, ["__text"], ADDED, start, drop=["__text"])
