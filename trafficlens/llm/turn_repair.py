"""Conversation structure repair: one integer minimum decides cost and audit.

A conversation's rows are taken by turn (nulls first), then by role, SHA-256 of
the text and place in the files.  Each row is kept (K, 0), gets the role user
or assistant that is due (R, 3), or is deleted (D, 4); turns of empty text can
be inserted anywhere (I, 3).  Blank rows and rows whose role and text came
earlier must be deleted; a truncated row that stays adds 3.  The initials of the
roles that result must read ``(s?(ua)+)?``.  A role without an initial of these
letters can only get another role or be deleted.

The weight of a list of edits is one integer.  Its low part has one base-8 digit
for each place of the audit (D, I, K, R are 1 to 4, the order of their
letters), the first letter in the highest place, zeros behind the last one; the
cost stands above.  So the smaller integer is the cheaper list or, at equal
cost, the one whose audit is less as text, and a shortest-path program over
(rows taken, state of the grammar) needs integer additions and ``min`` only.
From one state equal costs never have audits of which one begins the other (the
longer one would have one more I), so the minimum per node is safe.

Rows are sorted by ranges, so a conversation may lie in several partitions.  A
task cuts it into blocks of ``BLOCK`` rows at most and gives for each block the
least weights from every entry to every exit state; the blocks of one
conversation are multiplied (min-plus) in a tree of fan-in ``FAN``, as are its
counts.  The texts are sent once, to the task that hashes the repaired
conversation: it reads them sorted, as a stream, and holds only the audit (a
digest of a whole conversation is sequential by definition).

Defined cases: null turns count for no gap; rows with a null conversation id are
one conversation; equal rows are copies, of which the first is no duplicate; a
conversation without rows has zeros, an empty audit and the digest of the empty
string; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, trimmed, with_file_rows, write_table

BLANKS = " \t\n\x0b\x0c\r"
BLOCK, FAN = 1000, 32
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4  # digits of an audit
LETTERS = str.maketrans("1234", "DIKR")
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
START, SYSTEM, USER, ASSISTANT = range(4)  # states: the last role, START before any
COUNTS = ("n", "blank", "duplicate", "truncated", "illegal", "turns")
BLOCK_SCHEMA = ("part bigint, seq bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)
                + ", first string, last string, least_turn bigint, most_turn bigint, weights array<binary>")
RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, place`` with every fault that crc32 of ``conv_id:turn`` deals (nulls: one space)."""
    rows = with_file_rows(conversations.select("conv_id", "turn", "role", "text"), "place")
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat(named[0], F.lit(":"), named[1]).cast("binary")) % 20
    rows = rows.withColumn("fault", fault).where("fault <> 0")
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.withColumn("copy", F.explode(copies))
            .select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.when(F.col("fault") == 4, F.lit("user")).otherwise(role).alias("role"),
                    F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                    F.struct("place.file", "place.index", "copy").alias("place")))


def faults(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, digest, place, initial, fault`` per row: its first fault."""
    seen = F.rtrim("text", F.lit(BLANKS))
    rows = turns.select("conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), "place", F.substring("role", 1, 1).alias("initial"),
                        (seen == "").alias("blank"), (~F.substring(seen, -1, 1).isin(".", "!", "?")).alias("open"))
    # the first place of each role and text; joined by place, which is unique, so no frequent text is a hot key
    firsts = (rows.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn", "place")).alias("at"))
              .select(F.col("at.place").alias("place"), F.lit(True).alias("is_first")))
    fault = (F.when(F.col("blank"), BLANK).when(F.col("is_first").isNull(), DUPLICATE).when(F.col("open"), TRUNCATED).otherwise(SOUND))
    return rows.join(firsts, "place", "left").select("conv_id", "turn", "role", "digest", "place", "initial", fault.alias("fault"))


def due(state: int) -> int:
    """The state after the role that the grammar wants next."""
    return ASSISTANT if state == USER else USER


def least_weights(rows: list[tuple[str, int]], entries) -> list[bytes | None]:
    """Least weight from each entry state to each exit state over ``rows`` of (initial, fault); 4 x 4, row by row.

    Insertions stand before a row; those behind the last one are ``finish``'s.
    """
    places = 3 * len(rows)
    one = 1 << 3 * places  # a cost of 1

    def put(weight, p, cost, letter):
        return weight + cost * one + (letter << 3 * (places - 1 - p)), p + 1

    out = [None] * 16
    for entry in entries:
        at = {entry: (0, 0)}  # state: weight and length of its audit
        for initial, fault in rows:
            inserted = {}
            for q, (w, p) in at.items():
                for _ in range(3 if q in (START, SYSTEM) else 2):  # a third state in a row would be one met before
                    if q not in inserted or w < inserted[q][0]:
                        inserted[q] = w, p
                    (w, p), q = put(w, p, 3, INSERT), due(q)
            at = {}
            extra = 3 if fault == TRUNCATED else 0
            for q, (w, p) in inserted.items():
                edges = [(q, 4, DELETE)]
                if fault not in (BLANK, DUPLICATE):
                    to = due(q)
                    edges.append((to, 3 + extra, REROLE))
                    if initial == "ua"[to - USER]:
                        edges.append((to, extra, KEEP))
                    elif initial == "s" and q == START:
                        edges.append((SYSTEM, extra, KEEP))
                for to, cost, letter in edges:
                    found = put(w, p, cost, letter)
                    if to not in at or found[0] < at[to][0]:
                        at[to] = found
        for q, (w, _) in at.items():
            out[4 * entry + q] = w.to_bytes((w.bit_length() + 7) // 8 or 1)
    return out


def split_weight(raw: bytes, places: int) -> tuple[int, int, int]:
    """Cost, audit digits, and length of the audit (its last letter is the lowest digit that is not 0)."""
    w = int.from_bytes(raw)
    cost, audit = w >> 3 * places, w & ((1 << 3 * places) - 1)
    return cost, audit, places - ((audit & -audit).bit_length() - 1) // 3 if audit else 0


def join_weights(a: list, n: int, b: list, m: int) -> list:
    """Min-plus product of the weights of ``n`` rows and of the ``m`` rows behind them."""
    right = [x and split_weight(x, 3 * m) for x in b]
    out = [None] * 16
    for i, raw in enumerate(a):
        if raw is None:
            continue
        cost, audit, length = split_weight(raw, 3 * n)
        for q in range(4):
            if right[4 * (i % 4) + q]:
                c, tail, _ = right[4 * (i % 4) + q]
                w = (cost + c << 3 * (3 * n + 3 * m)) + (audit << 9 * m) + (tail << 3 * (3 * n - length))
                k = i // 4 * 4 + q
                if out[k] is None or w < out[k]:
                    out[k] = w
    return [w if w is None else w.to_bytes((w.bit_length() + 7) // 8 or 1) for w in out]


def finish(weights: list, n: int) -> tuple[int, str]:
    """Cost and audit of a whole conversation: the turns still due are inserted behind its last row."""
    places, found = 3 * n + 2, []
    for state in range(4):
        if weights[state] is not None:
            cost, audit, length = split_weight(weights[state], 3 * n)
            w, more = (cost << 3 * places) + (audit << 6), {SYSTEM: 2, USER: 1}.get(state, 0)
            for k in range(more):
                w += (3 << 3 * places) + (INSERT << 3 * (places - 1 - length - k))
            found.append(w)
    best = min(found)
    digits = oct(best & ((1 << 3 * places) - 1))[2:]  # its first digit is a letter: no leading zeros are lost
    return best >> 3 * places, digits.rstrip("0").translate(LETTERS)


def new_block(part: int, seq: int, rows: list[tuple], entries) -> dict:
    """Record of consecutive ``rows`` (turn, initial, fault)."""
    held = [r[2] for r in rows]
    turns = [r[0] for r in rows if r[0] is not None]
    pairs = [x[1] + y[1] for x, y in zip(rows, rows[1:])]
    return {"part": part, "seq": seq, "n": len(rows), "blank": held.count(BLANK), "duplicate": held.count(DUPLICATE),
            "truncated": held.count(TRUNCATED), "illegal": sum(x not in ("su", "ua", "au") for x in pairs), "turns": len(set(turns)),
            "first": rows[0][1], "last": rows[-1][1], "least_turn": turns[0] if turns else None, "most_turn": turns[-1] if turns else None,
            "weights": least_weights([r[1:] for r in rows], entries)}


def join_blocks(a: dict, b: dict) -> dict:
    out = {c: a[c] + b[c] for c in COUNTS}
    out["illegal"] += a["last"] + b["first"] not in ("su", "ua", "au")
    out["turns"] -= a["most_turn"] is not None and a["most_turn"] == b["least_turn"]
    return out | {"part": a["part"], "seq": a["seq"], "first": a["first"], "last": b["last"],
                  "least_turn": a["least_turn"] if a["least_turn"] is not None else b["least_turn"],
                  "most_turn": b["most_turn"] if b["most_turn"] is not None else a["most_turn"],
                  "weights": join_weights(a["weights"], a["n"], b["weights"], b["n"])}


def product(blocks: list[dict]) -> dict:
    """All blocks in order, neighbours first, so that short weights meet short ones."""
    while len(blocks) > 1:
        blocks = [join_blocks(*blocks[i:i + 2]) if i + 1 < len(blocks) else blocks[i] for i in range(0, len(blocks), 2)]
    return blocks[0]


def as_batch(records: list[dict], like: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({f.name: [r[f.name] for r in records] for f in like}, schema=like)


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def blocks(rows: DataFrame) -> DataFrame:
    """Block records of ``faults``, ``part`` and ``seq`` in the order of the rows."""
    ddl = f"conv_id {dict(rows.dtypes)['conv_id']}, {BLOCK_SCHEMA}"
    like = arrow_schema(ddl)

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        conv, held, entries = None, [], range(4)  # a partition may begin inside a conversation
        done = []

        def close():
            nonlocal seq
            if held:
                done.append(new_block(part, seq, held, entries) | {"conv_id": conv})
                seq += 1

        for b in batches:
            for c, turn, initial, fault in zip(*[b.column(k).to_pylist() for k in ("conv_id", "turn", "initial", "fault")]):
                if not held or c != conv or len(held) == BLOCK:
                    close()
                    entries = range(4) if seq == 0 or c == conv else (START,)
                    conv, held = c, []
                held.append((turn, initial, fault))
            if done:
                yield as_batch(done, like)
                done.clear()
        close()
        if done:
            yield as_batch(done, like)

    order = ["conv_id", "turn", "role", "digest", "place"]
    return (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "initial", "fault")
            .mapInArrow(trimmed(run), ddl))


def whole(level: DataFrame) -> DataFrame:
    """One record per conversation: the product of its blocks, ``FAN`` at a time."""
    schema = level.schema
    like = arrow_schema(f"conv_id {dict(level.dtypes)['conv_id']}, {BLOCK_SCHEMA}")

    def multiply(table: pa.Table) -> pa.Table:
        records = sorted(table.select(like.names).to_pylist(), key=lambda r: (r["part"], r["seq"]))
        return pa.Table.from_batches([as_batch([product(records) | {"conv_id": records[0]["conv_id"]}], like)])

    done, names = None, schema.names
    while True:
        several = write_table(level.groupBy("conv_id").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(F.col("conv_id").alias("__id")),
                              "repair-several")
        same = F.col("conv_id").eqNullSafe(F.col("__id"))
        single = level.join(several, same, "left_anti")
        done = single if done is None else done.unionByName(single)
        if several.isEmpty():
            return done
        order = Window.partitionBy("conv_id").orderBy("part", "seq")
        rest = level.join(several, same, "left_semi").withColumn("__group", F.floor((F.row_number().over(order) - 1) / FAN))
        level = write_table(rest.groupBy("conv_id", "__group").applyInArrow(multiply, schema).select(*names), "repair-blocks")


def audits(records: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of whole conversations."""
    ddl = f"conv_id {dict(records.dtypes)['conv_id']}, {RESULT}"
    like = arrow_schema(ddl)

    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                cost, audit = finish(r["weights"], r["n"])
                gaps = 0 if r["least_turn"] is None else r["most_turn"] - r["least_turn"] + 1 - r["turns"]
                out.append({c: r[c] for c in ("conv_id", "blank", "duplicate", "truncated", "illegal")} | {"gaps": gaps, "cost": cost, "audit": audit})
            yield as_batch(out, like)

    return records.mapInArrow(trimmed(run), ddl)


class Editor:
    """Applies an audit to the rows of a conversation as they come, and hashes the repaired one."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.digest, self.lines = audit, 0, START, hashlib.sha256(), 0

    def write(self, role: str, text: str) -> None:
        line = ("\n" if self.lines else "") + f"{role}:{text}"
        self.digest.update(line.encode("utf-8", "surrogatepass"))
        self.lines += 1

    def next_role(self) -> str:
        self.state = due(self.state)
        return "user" if self.state == USER else "assistant"

    def insert(self) -> None:
        while self.audit.startswith("I", self.at):
            self.at += 1
            self.write(self.next_role(), "")

    def take(self, role: str, text: str) -> None:
        self.insert()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "R":
            self.write(self.next_role(), text)
        elif letter == "K":
            self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
            self.write(role, text)

    def close(self) -> str:
        self.insert()
        return self.digest.hexdigest()


def repair(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``turns`` (``conv_id, turn, role, text, place``), and of ``ids``.

    ``place`` tells rows apart and is the same at every reading; role and text
    are not null.  Returns ``conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256``.
    """
    turns = turns.select("conv_id", "turn", "role", "text", "place")
    rows = write_table(faults(turns), "repair-faults")
    parts = write_table(blocks(rows), "repair-blocks")
    known = write_table(audits(whole(parts)), "repair-audits")
    discard(parts)
    if ids is not None:
        ids = ids.select(F.col("conv_id").alias("__id")).distinct()
        empty = ids.join(known, F.col("conv_id").eqNullSafe(F.col("__id")), "left_anti")
        zeros = [(F.lit("") if c == "audit" else F.lit(0).cast("bigint")).alias(c) for c in known.columns[1:]]
        known = known.unionByName(empty.select(F.col("__id").alias("conv_id"), *zeros))
    heads = known.select("conv_id", F.lit(0).alias("kind"), F.struct(*known.columns[1:]).alias("head"))
    texts = turns.select("conv_id", F.lit(1).alias("kind"), "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), "place", "text")
    order = ["conv_id", "kind", "turn", "role", "digest", "place"]
    both = heads.unionByName(texts, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions(*order)
    ddl = f"conv_id {dict(turns.dtypes)['conv_id']}, {RESULT}, repaired_sha256 string"
    like = arrow_schema(ddl)

    def run(batches):
        head, editor, done = None, None, []

        def close():
            if editor:
                done.append(head | {"repaired_sha256": editor.close()})

        for b in batches:
            for conv, kind, found, role, text in zip(*[b.column(c).to_pylist() for c in ("conv_id", "kind", "head", "role", "text")]):
                if kind:
                    editor.take(role, text)
                else:  # the record of the next conversation, before its rows
                    close()
                    head, editor = {"conv_id": conv} | found, Editor(found["audit"])
            if done:
                yield as_batch(done, like)
                done.clear()
        close()
        if done:
            yield as_batch(done, like)

    return both.select("conv_id", "kind", "head", "role", "text").mapInArrow(trimmed(run), ddl)
