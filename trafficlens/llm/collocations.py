"""Phrase collocations by marginalising counts of the longest windows.

A text is cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and a piece into words.  Every
word occurrence leads one window: itself and the following words of its piece,
``LONGEST`` in all, padded with nulls where the piece ends.  Only these windows
are counted.  A phrase of ``k`` words occurs once for every window that begins
with it, so ``ROLLUP (w1, w2, w3, w4)`` over the window counts gives the exact
count of every phrase of every length: no n-grams of other lengths are made.

No phrase with a rarer word, or beginning with a rarer phrase, than ``least``
can be a candidate or a part of one.  So

* a window may be cut at its first rare word.  The frequent words of every
  language are numbered, most frequent first, and a window is two integers of two
  words each.  Tasks combine the windows of ``CHUNK`` words before they send them.
* windows that begin with the same two words meet in one task (words that lead
  many windows are dealt over ``SPREAD`` tasks by their second word), sorted, as
  a stream; there a window is cut after a prefix that is rarer than ``least``,
  which leaves few distinct windows for the ROLLUP.

Cutting a window moves its count to a shorter prefix and so changes no count of
a frequent phrase.  The numbered words are broadcast to the tasks only while
they stay below ``DICTIONARY_BYTES``.  With more of them, the texts of a chunk are
written as numbers of the chunk's own words; these words meet the numbered ones in
a join, and each chunk gets the numbers of its own words only (``joined_windows``).

A candidate's score is that of its worst cut into two parts, in exact decimals.

Defined cases: a null text is empty; a null language is ``und``; languages are
independent of each other; windows of equal rows add up; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from itertools import accumulate, count, islice, repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, discard, release, trim, trimmed, write_table

LONGEST = 4
WORDS = ["w1", "w2", "w3", "w4"]
CHUNK = 2_000_000  # words whose windows a task combines before sending them
PART = 2_000_000  # windows of a counting task, about
SPREAD = 64
HEAVY = 1000  # a word with this share of all occurrences, or a quarter of a task's, leads many windows
ID_BITS = 31  # two word numbers in one signed 64-bit integer
DICTIONARY_BYTES = 24 << 20
WORD_BYTES = 90  # of a numbered word in a worker's dictionary, besides its text
SIDE_BYTES = 64  # of a numbered word in a broadcast side
COMMON = 1 << 16  # words that are broadcast when not all are: no other has a larger share of the windows
PIECE = 250_000  # words of a chunk's texts in one row, about
OWN, TEXTS = 400_000, 16_000_000  # of a chunk with its own words: so many of them, and words of its texts, about
STEP, HELD = 500_000, 4_000_000  # rows that a counting task looks at together; of one pair of words that it holds back
ENDS = rb".,;:!?" + bytes(range(0x0A, 0x0E))
#: Piece ends become a byte that UTF-8 never has, tabs spaces.
END = b"\xff"
CUT = bytes.maketrans(ENDS + b"\t", b"\xff" * len(ENDS) + b" ")


def tokens(text: str | None) -> list[bytes]:
    """Words of a text with ``END`` at every piece end; only A-Z are lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(CUT).replace(END, b" \xff ").split()


def vocabulary(docs: DataFrame) -> DataFrame:
    """``lang, word, f``: the occurrences of every word in every language."""

    def run(batches):
        held, n = {}, 0

        def flush():
            names, words, counts = [], [], []
            for lang, c in held.items():
                c.pop(END, None)
                names += [lang] * len(c)
                words += c.keys()
                counts += c.values()
            held.clear()
            for i in range(0, len(names), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[i:i + 50_000], pa.string()), pa.array([w.decode("utf-8", "surrogatepass") for w in words[i:i + 50_000]], pa.string()),
                     pa.array(counts[i:i + 50_000], pa.int64())], names=["lang", "word", "f"])

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                found = tokens(text)
                held.setdefault(lang, Counter()).update(found)
                n += len(found)
                if n >= CHUNK:
                    yield from flush()
                    n = 0
        yield from flush()

    return docs.mapInArrow(trimmed(run), "lang string, word string, f bigint").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def starts_of(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    if not len(keys[0]):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([x[1:] != x[:-1] for x in keys])]))


def combined(found: list[np.ndarray]):
    """Batches of ``p`` (first two words), ``q`` (last two) and ``n``: the windows of numbered words; 0 ends a window."""
    w = [np.concatenate([*found, np.zeros(LONGEST, np.int32)])]
    found.clear()
    for _ in range(LONGEST - 1):  # the lead columns; 0 is the padding
        w.append(np.where(w[-1] > 0, np.append(w[0][len(w):], np.zeros(len(w), np.int32)), np.int32(0)))
    w = [x[w[0] > 0] for x in w[::-1]][::-1]
    p, q = ((a.astype(np.int64) << ID_BITS) | b for a, b in (w[:2], w[2:]))
    del w
    order = np.lexsort((q, p))
    p, q = p[order], q[order]
    del order
    first = starts_of(p, q)
    n = np.diff(np.append(first, len(p)))
    p, q = p[first], q[first]
    for i in range(0, len(p), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(x[i:i + 100_000]) for x in (p, q, n)], names=["p", "q", "n"])


def numbered_windows(docs: DataFrame, ids: dict[str, dict[bytes, int]]) -> DataFrame:
    """``p, q, n``: the windows of each chunk, cut at rare words."""
    shared = docs.sparkSession.sparkContext.broadcast(ids)

    def run(batches):
        numbers, found, n = shared.value, [], 0
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                words = tokens(text)
                words.append(END)
                found.append(np.fromiter(map(numbers.get(lang, {}).get, words, repeat(0)), np.int32, len(words)))
                n += len(words)
                if n >= CHUNK:
                    yield from combined(found)
                    found, n = [], 0
                    trim()
        if found:
            yield from combined(found)

    return docs.mapInArrow(trimmed(run), "p bigint, q bigint, n bigint")


def packed(codes: np.ndarray) -> bytes:
    """Small integers, their bytes of equal weight side by side, zipped."""
    return zlib.compress(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()


def chunks(docs: DataFrame) -> DataFrame:
    """Rows of each chunk: its words (``chunk, code, lang, word``) and, in pieces, its texts as their codes
    (``chunk, code, codes``; ``code`` is the place of the piece, code 0 ends a piece of text)."""
    schema = pa.schema([("chunk", pa.int64()), ("code", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("codes", pa.binary())])

    def run(batches):
        task, made = TaskContext.get().partitionId() << 32, 0
        found, size, pieces, n, held, free = [], 0, [], 0, {}, count(1)

        def pack():
            nonlocal found, size
            pieces.append(packed(np.concatenate(found)))
            found, size = [], 0

        def flush():
            nonlocal pieces, n, held, free, made
            if found:
                pack()
            chunk = task + made
            for lang, words in held.items():
                del words[END]
                rows = iter(words.items())
                while part := list(islice(rows, 50_000)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([chunk] * len(part)), pa.array([c for _, c in part]), pa.array([lang] * len(part), pa.string()),
                         pa.array([w.decode("utf-8", "surrogatepass") for w, _ in part], pa.string()), pa.nulls(len(part), pa.binary())], schema=schema)
            held = {}
            for i, x in enumerate(pieces):
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([i]), pa.nulls(1, pa.string()), pa.nulls(1, pa.string()),
                                                  pa.array([x], pa.binary())], schema=schema)
            pieces, n, free, made = [], 0, count(1), made + 1
            trim()

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                words = tokens(text)
                words.append(END)
                if lang not in held:
                    held[lang] = defaultdict(free.__next__, {END: 0})
                found.append(np.fromiter(map(held[lang].__getitem__, words), np.uint32, len(words)))
                size += len(words)
                n += len(words)
                if size >= PIECE:
                    pack()
                if n >= TEXTS or sum(map(len, held.values())) >= OWN:
                    yield from flush()
        if n:
            yield from flush()

    return docs.mapInArrow(trimmed(run), "chunk bigint, code bigint, lang string, word string, codes binary")


def own_numbers(table: DataFrame, named: DataFrame) -> DataFrame:
    """``chunk, code``: the code of a frequent word in a chunk, and in the lowest ``ID_BITS`` its number."""
    return (table.where(F.col("word").isNotNull()).join(named.select("lang", "word", "id"), ["lang", "word"])
            .select("chunk", F.shiftleft("code", ID_BITS).bitwiseOR(F.col("id")).alias("code")))


def joined_windows(table: DataFrame, own: DataFrame, parts: int) -> DataFrame:
    """``p, q, n`` as of ``numbered_windows``, from ``chunks`` and their ``own_numbers``."""

    def run(batches):
        at, known, texts = None, [], []

        def done():
            if not texts:
                return
            own = np.concatenate([np.zeros(1, np.int64), *known])
            numbers = np.zeros(int(own.max() >> ID_BITS) + 1, np.int32)
            numbers[own >> ID_BITS] = own & ((1 << ID_BITS) - 1)
            found, n = [], 0
            for x in texts:
                text = unpacked(x)
                found.append(np.where(text < len(numbers), numbers[np.minimum(text, len(numbers) - 1)], np.int32(0)))
                n += len(text)
                if n >= CHUNK:
                    yield from combined(found)
                    found, n = [], 0
            if found:
                yield from combined(found)
            trim()

        for b in batches:
            chunk = b.column("chunk").to_numpy()
            bounds = [*starts_of(chunk), len(chunk)]
            for i, j in zip(bounds, bounds[1:]):
                if chunk[i] != at:
                    yield from done()
                    at, known, texts = chunk[i], [], []
                part = b.slice(i, j - i)
                known.append(part.column("code").filter(part.column("codes").is_null()).to_numpy(zero_copy_only=False))
                texts += part.column("codes").drop_null().to_pylist()
        yield from done()

    both = own.withColumn("codes", F.lit(None).cast("binary")).unionAll(table.where(F.col("codes").isNotNull()).select("chunk", "code", "codes"))
    return (both.repartition(parts, "chunk").sortWithinPartitions("chunk", F.col("codes").isNotNull(), "code")
            .mapInArrow(trimmed(run), "p bigint, q bigint, n bigint"))


def cut_windows(sent: DataFrame, least: int, parts: int, heavy: int) -> DataFrame:
    """``w1, w2, w3, w4, n``: window counts, each window cut after a prefix with fewer than ``least``.

    ``heavy``: the words numbered up to this lead many windows.
    """
    half, low = ID_BITS, (1 << ID_BITS) - 1

    def cut(p, q, n, sums2, sums3):
        """The four words after cutting; sums per row of its prefixes of 2 and 3 words."""
        w = [p >> half, p & low, q >> half, q & low]
        keep = [None, sums2 >= least, sums3 >= least, n >= least]
        for j in range(1, LONGEST):
            w[j] = np.where((w[j - 1] > 0) & keep[j], w[j], 0)
        p, q = (w[0] << half) | w[1], (w[2] << half) | w[3]
        order = np.lexsort((q, p))
        p, q, n = merge(p[order], q[order], n[order])
        words = [p >> half, p & low, q >> half, q & low]
        for i in range(0, len(n), 100_000):
            s = slice(i, i + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(x[s], pa.int64(), mask=x[s] == 0) for x in words] + [pa.array(n[s])], names=[*WORDS, "n"])

    def totals(starts, n):
        """Sum of each run, repeated for its rows."""
        return np.repeat(np.add.reduceat(n, starts), np.diff(np.append(starts, len(n))))

    def merge(p, q, n):
        first = starts_of(p, q)
        return p[first], q[first], np.add.reduceat(n, first)

    def run(batches):
        empty = np.empty(0, np.int64)
        p, q, n, frequent = empty, empty, empty, -1  # frequent: a pair known to be so, rows of which are gone already
        waiting, size = [], 0

        def step(final):
            nonlocal p, q, n, frequent, waiting, size
            p, q, n = (np.concatenate([x, *[w[i] for w in waiting]]) for i, x in enumerate((p, q, n)))
            waiting, size = [], 0
            if not len(p):
                return
            p, q, n = merge(p, q, n)
            upto = len(p) if final else int(np.searchsorted(p, p[-1]))  # the last pair may go on
            early = not final and len(p) - upto > HELD
            if early:  # more rows than ``least``: a frequent pair; only its last three words may go on
                upto += int(np.searchsorted(q[upto:] >> half, q[-1] >> half))
            if upto:
                a, b, c = p[:upto], q[:upto], n[:upto]
                sums2 = totals(starts_of(a), c)
                sums2 = np.where((a == frequent) | (early and a == p[-1]), np.maximum(sums2, least), sums2)
                yield from cut(a, b, c, sums2, totals(starts_of(a, b >> half), c))
            if early:
                frequent = p[-1]
            p, q, n = p[upto:], q[upto:], n[upto:]

        for b in batches:
            waiting.append([b.column(x).to_numpy() for x in ("p", "q", "n")])
            size += b.num_rows
            if size >= STEP:
                yield from step(False)
        yield from step(True)

    first, second = F.shiftright("p", half), F.col("p").bitwiseAND(low)
    spread = F.when(first <= heavy, second % SPREAD).otherwise(F.lit(0))
    return (sent.repartition(parts, first, spread).sortWithinPartitions("p", "q")
            .mapInArrow(trimmed(run), ", ".join(f"{w} bigint" for w in WORDS) + ", n bigint"))


def marginals(windows: DataFrame) -> DataFrame:
    """``size, w1..w4, f``: the count of every phrase, by ROLLUP over the words of the windows."""
    names = ", ".join(WORDS)
    rolled = windows.sparkSession.sql(f"SELECT {names}, grouping_id() AS __g, sum(n) AS f FROM {{windows}} GROUP BY ROLLUP({names})", windows=windows)
    size = sum((F.when(F.col("__g") == (1 << (LONGEST - k)) - 1, k).otherwise(0) for k in range(1, LONGEST + 1)), F.lit(0))
    last = F.coalesce(*[F.when(F.col("size") == k, F.col(w)) for k, w in enumerate(WORDS, 1)])
    # a row whose last word is padding stands for windows that end earlier
    return rolled.withColumn("size", size).where(last.isNotNull()).select("size", *WORDS, "f")


def numbered(frequent: DataFrame) -> DataFrame:
    """``id, lang, word, f``: words numbered from 1, most frequent first, by a range sort."""
    sorted_ = frequent.orderBy(F.col("f").desc(), "lang", "word").select(F.monotonically_increasing_id().alias("place"), "lang", "word", "f")
    placed = write_table(sorted_, "phrase-places")
    task, within = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = sorted(tuple(r) for r in placed.groupBy(task.alias("task")).agg(F.count(F.lit(1))).collect())  # a row for each task of the sort
    before = frequent.sparkSession.createDataFrame(list(zip([t for t, _ in sizes], accumulate([n for _, n in sizes], initial=0))), "task bigint, before bigint")
    ids = placed.withColumn("task", task).join(F.broadcast(before), "task").select((F.col("before") + within + 1).alias("id"), "lang", "word", "f")
    named = write_table(ids, "phrase-dictionary")
    discard(placed)
    return named


def spelled(found: DataFrame, named: DataFrame, n: int) -> DataFrame:
    """``found`` with the words ``t0`` to ``t3`` of its numbers, and the language of the first."""
    near = n if n * SIDE_BYTES <= BROADCAST_BYTES else COMMON
    for j, w in enumerate(WORDS):
        names = ["word", "lang"] if j == 0 else ["word"]
        made = [f"t{j}", "lang"] if j == 0 else [f"t{j}"]

        def side(rows, key, prefix=""):
            return rows.select(F.col("id").alias(key), *[F.col(x).alias(f"{prefix}{y}") for x, y in zip(names, made)])

        found = found.join(F.broadcast(side(named.where(F.col("id") <= near), w)), w, "left")
        if n > near:  # rows that have their word are dealt out by numbers that no word has
            key = F.when(F.col(w) > near, F.col(w)).otherwise(-1 - F.pmod(F.xxhash64(*WORDS), F.lit(1 << 20)))
            found = (found.withColumn("far", key).join(side(named.where(F.col("id") > near), "far", "far_"), "far", "left")
                     .withColumns({y: F.coalesce(y, f"far_{y}") for y in made}).drop("far", *[f"far_{y}" for y in made]))
    return found


def counts(docs: DataFrame, least: int, dictionary_bytes: int = DICTIONARY_BYTES) -> tuple[DataFrame, DataFrame]:
    """(``lang, phrase, size, f`` of all phrases of up to four words that occur ``least`` times; ``lang, n``)."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    words = vocabulary(docs)
    words = write_table(words.withColumn("kept", F.col("f") >= least).groupBy("lang", F.when(F.col("kept"), F.col("word")).alias("word"))
                        .agg(F.sum("f").alias("f")), "phrase-words")  # the rare ones of a language in one row, without a word
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where(F.col("word").isNotNull())
    n, held, total = frequent.agg(F.count(F.lit(1)), F.sum(F.octet_length("word") + WORD_BYTES), F.sum("f")).first()
    parts = max(1, ceil((total or 0) / PART))
    small = (held or 0) <= dictionary_bytes
    if small:  # a bounded table: numbered in one task
        order = Window.orderBy(F.col("f").desc(), "lang", "word")
        named = write_table(frequent.withColumn("id", F.row_number().over(order).cast("bigint")).select("id", "lang", "word", "f"), "phrase-dictionary")
        ids: dict[str, dict[bytes, int]] = {}
        for b in named.select("id", "lang", "word").toArrow().to_batches():
            for i, lang, word in zip(*[c.to_pylist() for c in b.columns]):
                ids.setdefault(lang, {})[word.encode("utf-8", "surrogatepass")] = i
        sent = numbered_windows(docs, ids)
    else:
        release(spark)
        named = numbered(frequent)
        table = write_table(chunks(docs), "phrase-chunks")
        own = write_table(own_numbers(table, named), "phrase-own")
        sent = joined_windows(table, own, parts)
    heavy = named.where(F.col("f") * max(4 * parts, HEAVY) >= F.lit(total or 0)).count()
    release(spark)
    found = write_table(marginals(cut_windows(sent, least, parts, heavy)).where(F.col("f") >= least), "phrase-numbers")
    if not small:
        discard(table, own)
        release(spark)
    out = write_table(spelled(found, named, n).select("lang", F.concat_ws(" ", *[f"t{j}" for j in range(LONGEST)]).alias("phrase"),
                                                      F.col("size").cast("int").alias("size"), "f"), "phrase-counts")
    return out, totals


def part(phrase, first: int, last: int):
    """Words ``first`` to ``last`` (from 1) of a phrase column."""
    return F.array_join(F.slice(F.split(phrase, " "), first, last - first + 1), " ")


def scored(phrases: DataFrame, scale: int = 2_000_000) -> DataFrame:
    """``lang, phrase, size, a, l, r, cut, score`` of all phrases of two words and more: their worst cut."""
    cuts = [(size, k) for size in range(2, LONGEST + 1) for k in range(1, size)]
    made = [F.when(F.col("size") == size, F.struct(F.lit(k).alias("cut"), part("phrase", 1, k).alias("head"), part("phrase", k + 1, size).alias("tail")))
            for size, k in cuts]
    c = (phrases.where("size >= 2").withColumn("c", F.explode(F.filter(F.array(*made), lambda x: x.isNotNull())))
         .select("lang", "phrase", "size", F.col("f").alias("a"), "c.*"))
    side = lambda name, f: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    c = c.join(side("head", "l"), ["lang", "head"]).join(side("tail", "r"), ["lang", "tail"])
    exact = F.expr(f"cast((cast({scale} as decimal(10,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0))) as bigint)")
    worst = F.min(F.struct(exact.alias("score"), F.col("cut"), F.col("l"), F.col("r")))
    return (c.groupBy("lang", "phrase", "size", "a").agg(worst.alias("w"))
            .select("lang", "phrase", "size", "a", "w.l", "w.r", "w.cut", "w.score"))


def contained(phrases: DataFrame, least_share: int = 80) -> DataFrame:
    """``lang, phrase``: phrases inside a longer one that has at least ``least_share`` percent of their count."""
    spans = [(size, i, j) for size in range(3, LONGEST + 1) for i in range(1, size) for j in range(i + 1, size + 1) if j - i + 1 < size]
    inner = [F.when(F.col("size") == size, part("phrase", i, j)) for size, i, j in spans]
    longer = (phrases.where("size >= 3").withColumn("inner", F.explode(F.array_distinct(F.filter(F.array(*inner), lambda x: x.isNotNull()))))
              .groupBy("lang", F.col("inner").alias("phrase")).agg(F.max("f").alias("longest")))
    return (phrases.join(longer, ["lang", "phrase"])
            .where(F.col("longest").cast("decimal(19,0)") * 100 >= F.col("f").cast("decimal(19,0)") * least_share).select("lang", "phrase"))


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, dictionary_bytes: int = DICTIONARY_BYTES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases."""
    phrases, totals = counts(docs, least, dictionary_bytes)
    left = scored(phrases).join(contained(phrases.where("size >= 2")), ["lang", "phrase"], "left_anti")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # the best of each of SPREAD shares first, so that no task sorts a whole language
    shares = Window.partitionBy("lang", F.pmod(F.hash("phrase"), F.lit(SPREAD))).orderBy(*order)
    left = left.withColumn("place", F.row_number().over(shares)).where(F.col("place") <= top)
    left = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return left.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
         regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents),
q AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS a FROM p),
g AS (SELECT lang, a, unnest(range(1, len(a) + 1)) AS i FROM q),
m AS (SELECT lang, array_to_string(a[i:i + k - 1], ' ') AS phrase, k FROM g, (VALUES (1), (2), (3), (4)) AS s(k) WHERE i + k - 1 <= len(a)),
f AS (SELECT lang, phrase, k, count(*) AS f FROM m GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
v AS (SELECT lang, phrase, f FROM f WHERE f >= 30),
h AS (SELECT c.*, s.cut, array_to_string(w[1:s.cut], ' ') AS head, array_to_string(w[s.cut + 1:], ' ') AS tail
      FROM c JOIN (VALUES (1), (2), (3)) AS s(cut) ON s.cut < c.k),
t AS (SELECT h.*, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f::HUGEINT + y.f) AS score
      FROM h JOIN v x ON x.lang = h.lang AND x.phrase = h.head JOIN v y ON y.lang = h.lang AND y.phrase = h.tail),
b AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (SELECT lang, array_to_string(w[s.x:s.y], ' ') AS phrase, max(a) AS longer
      FROM c, (SELECT x, y FROM range(1, 4) AS u(x), range(2, 5) AS v(y) WHERE y > x) AS s
      WHERE s.y <= c.k AND s.y - s.x + 1 < c.k GROUP BY ALL),
o AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
      FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * a)
SELECT o.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM o JOIN n ON n.lang = o.lang WHERE rank <= 2000
"""
