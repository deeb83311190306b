"""Cheapest repair of a conversation's role order.

A conversation should read `(s?(ua)+)?` in its roles' initials: nothing, or a system turn at most and then user and assistant
in turn. Each of its rows is kept, given the other role or deleted, and rows may be inserted. Costs are `KEEP`, `REROLE`,
`DELETE` and `INSERT`; blank and duplicate rows have to go, and a truncated row that stays costs `CUT` more. Of the cheapest
repairs that wins whose letters (D, I, K, R, in order) are least.

Both wishes are one number. A big integer holds the cost in its high digits and, below, the letters as digits of three bits,
the first letter highest and zeros behind the last: the plain order of integers is that of costs, then of letters, a shorter
word before a longer one. The states of the pattern at every row are an acyclic graph; from its end backwards a state's number
is the least over its edges, and an edge adds its cost and puts its letter before the digits.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import number_rows
from .common import batches, materialize

KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
#: Letters in ASCII order; a letter's digit is its place from 1, as 0 is the end.
LETTERS = "DIKR"
BLANKS = " \t\n\x0b\x0c\r"
#: A row as one letter: four kinds of initial times four kinds of fault.
INITIALS, FAULTS = ("s", "u", "a", "other"), ("none", "blank", "duplicate", "truncated")
CODES = "ABCDEFGHIJKLMNOP"
#: Rows whose letters are gathered in one step.
BLOCK = 4096
#: States: nothing yet, behind s, behind u, behind a. What comes next if a row is given a role or put in.
START, S, U, A = range(4)
NEXT = {START: U, S: U, U: A, A: U}
KEPT = {(START, 0): S, (START, 1): U, (S, 1): U, (A, 1): U, (U, 2): A}


def cheapest(codes: str) -> tuple[int, str]:
    """(cost, letters) of the best repair of a conversation whose rows are `codes`.

    Deleting all rows is a repair and from any state two insertions end one, which bounds the letters; an integer has room
    for them. Work grows with the square of the rows, in words of 64 bits: 0.2 ms for 8 rows, 3 s for 20,000, a minute for 100,000.
    """
    rows = len(codes)
    digits = rows + (DELETE * rows + 2 * INSERT) // INSERT + 2
    bits = 3 * digits
    mask, top = (1 << bits) - 1, bits - 3
    never = 1 << (bits + 64)

    def edge(letter: str, cost: int, rest: int) -> int:
        low = rest & mask
        return (rest ^ low) + (cost << bits) + ((LETTERS.index(letter) + 1) << top) + (low >> 3)

    def with_insertions(best: list[int]) -> list[int]:
        # Two insertions lead from U or A back to it, so one is the most that can help there.
        u, a = min(best[U], edge("I", INSERT, best[A])), min(best[A], edge("I", INSERT, best[U]))
        return [min(best[START], edge("I", INSERT, u)), min(best[S], edge("I", INSERT, u)), u, a]

    values = with_insertions([0, never, never, 0])
    for code in reversed(codes):
        initial, fault = divmod(CODES.index(code), len(FAULTS))
        best = [edge("D", DELETE, v) for v in values]
        if FAULTS[fault] not in ("blank", "duplicate"):
            more = CUT if FAULTS[fault] == "truncated" else 0
            for state in range(4):
                best[state] = min(best[state], edge("R", REROLE + more, values[NEXT[state]]))
                if (state, initial) in KEPT:
                    best[state] = min(best[state], edge("K", KEEP + more, values[KEPT[state, initial]]))
        values = with_insertions(best)
    found = values[START]
    word = format(found & mask, "o").zfill(digits).rstrip("0")
    return found >> bits, "".join(LETTERS[int(d) - 1] for d in word)


def _key(conv: Column) -> Column:
    """A text for every id that is never null."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def _keyed(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    rows = turns.select(_key(F.col(conv_col)).alias("key"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return rows.select("*", F.xxhash64("role", "text").alias("d1"), F.xxhash64(F.lit(1), "role", "text").alias("d2"))


def _coded(rows: DataFrame) -> DataFrame:
    """(key, codes): every row of a conversation as a letter, in order. Texts stay where they are read."""
    stripped, initial = F.rtrim("text", F.lit(BLANKS)), F.substring("role", 1, 1)
    kinds = rows.select(
        "key", "turn", "role", "d1", "d2",
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("initial"),
        F.when(stripped == "", 1).when(F.right(stripped, F.lit(1)).isin(".", "!", "?"), 0).otherwise(3).alias("fault"))
    numbered = materialize(number_rows(kinds, ["key"], ["turn", "role", "d1", "d2"], "pos"))
    first = numbered.groupBy("key", "d1", "d2").agg(F.min("pos").alias("first"))
    seen = numbered.join(first, ["key", "d1", "d2"])
    fault = F.when((F.col("fault") != 1) & (F.col("pos") > F.col("first")), 2).otherwise(F.col("fault"))
    letter = F.substring(F.lit(CODES), 4 * F.col("initial") + fault + 1, F.lit(1))
    block = F.floor((F.col("pos") - 1) / BLOCK)
    blocks = seen.groupBy("key", block.alias("b")).agg(_joined(F.struct("pos", letter.alias("codes"))).alias("codes"))
    codes = blocks.groupBy("key").agg(_joined(F.struct("b", "codes")).alias("codes"))
    spread = numbered.groupBy("key", "turn").agg(F.count(F.lit(1)).alias("_n")).groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    return codes.join(spread, "key")


def _joined(part: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["codes"]), "")


RESULT = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _repair(batch: pa.RecordBatch) -> pa.RecordBatch:
    out: list[tuple] = []
    for codes in batch.column("codes").to_pylist():
        places = [divmod(CODES.index(c), len(FAULTS)) for c in codes]
        faults = [sum(f == k for _, f in places) for k in (1, 2, 3)]
        illegal = sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for (a, _), (b, _) in zip(places, places[1:]))
        out.append((*faults, illegal, *cheapest(codes)))
    columns = [*map(list, zip(*out))]
    return pa.record_batch([batch.column("key"), batch.column("gaps"), *[pa.array(c, pa.int64()) for c in columns[:-1]], pa.array(columns[-1])],
                           names=[f.split()[0] for f in RESULT.split(", ")])


class Edits:
    """Applies an audit to a conversation's rows, one after the other."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def _given(self) -> str:
        self.state = NEXT[self.state]
        return "user" if self.state == U else "assistant"

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield "I", self._given(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of what goes before the row, and of the row unless it is deleted."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            yield edit, self._given(), text
        elif edit == "K":
            self.state = KEPT[self.state, INITIALS.index(role[:1])]
            yield edit, role, text


def _edited(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[str, str, str]], bool]]:
    """(key, next rows of the repaired conversation, whether they end it) from rows sorted by key, the audit before the others."""
    key, edits = None, None
    for batch in stream:
        for k, rank, role, text in zip(*(batch.column(c).to_pylist() for c in ("key", "rank", "role", "text"))):
            if rank == 0:
                if edits:
                    yield key, list(edits.inserted()), True
                key, edits = k, Edits(text)
            else:
                yield key, list(edits.row(role, text)), False
    if edits:
        yield key, list(edits.inserted()), True


def _digests(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made, digest, before = [], hashlib.sha256(), ""
    for key, rows, ended in _edited(stream):
        for _, role, text in rows:
            digest.update(f"{before}{role}:{text}".encode("utf-8", "surrogatepass"))
            before = "\n"
        if ended:
            made.append((key, digest.hexdigest()))
            digest, before = hashlib.sha256(), ""
            if len(made) == BLOCK:
                yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*made))], names=["key", "repaired_sha256"])
                made = []
    if made:
        yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*made))], names=["key", "repaired_sha256"])


def _rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made, last, number, names = [], None, 0, ["key", "pos", "edit", "role", "text"]
    for key, rows, _ in _edited(stream):
        number, last = (number if key == last else 0), key
        for row in rows:
            made.append((key, number, *row))
            number += 1
        if len(made) >= 256:
            yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*made))], names=names)
            made = []
    if made:
        yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*made))], names=names)


def _in_order(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows and audits of a conversation side by side: the audit, then the rows as they were numbered."""
    audits = found.select("key", F.lit(0).alias("rank"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                          F.col("audit").alias("text"), F.lit(0).cast("long").alias("d1"), F.lit(0).cast("long").alias("d2"))
    both = audits.unionByName(rows.withColumn("rank", F.lit(1)))
    return both.repartition("key").sortWithinPartitions("key", "rank", "turn", "role", "d1", "d2").select("key", "rank", "role", "text")


def _typed(found: DataFrame, turns: DataFrame, conv_col: str) -> DataFrame:
    """The id, in the type it came in, for its key."""
    kind = turns.schema[conv_col].dataType
    conv = F.when(F.col("key") != "", F.expr("substring(key, 2)").cast(kind))
    return found.select(conv.alias("conv"), *[c for c in found.columns if c != "key"])


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for every conversation of `turns`.

    A conversation's rows stand by turn, null first; rows of one turn by role and a hash of role and text, so repeated rows
    are neighbours. A null role or text is one space; an empty role has no initial and fits nowhere unless it is given another;
    a null id is a conversation of its own. Of a row the first fault
    counts: blank, duplicate (role and text stood before), truncated (its last sign that is no blank is not one of `.!?`).
    `illegal` counts neighbours whose roles' initials are not su, ua or au; `gaps` the turn numbers missing between the
    least and the largest. The hash is SHA-256 over the repaired `role:text`, joined by new lines. No rows give none; other
    columns are ignored, whatever their names.

    Order and faults are found on hashes over ranges of rows; one task holds a letter per row of a conversation and,
    in the last pass, reads its texts as a stream.
    """
    rows = _keyed(turns, conv_col, turn_col, role_col, text_col)
    found = materialize(_coded(rows).mapInArrow(batches(_repair), RESULT))
    digests = _in_order(rows, found).mapInArrow(_digests, "key string, repaired_sha256 string")
    return _typed(found.join(digests, "key"), turns, conv_col)


def repaired(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, pos, edit, role, text): the rows of the repaired conversations, `pos` from 0, and how each came to be (K, R or
    I). A conversation that loses all rows is absent. Nulls, ties, empty tables and other columns as in `repair`."""
    rows = _keyed(turns, conv_col, turn_col, role_col, text_col)
    found = materialize(_coded(rows).mapInArrow(batches(_repair), RESULT))
    return _typed(_in_order(rows, found).mapInArrow(_rows, "key string, pos long, edit string, role string, text string"), turns, conv_col)


def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) of `turns`, broken as real records are: by the CRC-32 of `id:turn` modulo 20 a row is
    dropped (0), loses its text (1) or its `.!?` (2), comes twice (3) or gets the role user (4). Nulls in role and text, and
    in what is hashed, are one space."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), text_of(role_col).alias("role"), text_of(text_col).alias("text"),
                        F.pmod(F.crc32(F.concat_ws(":", text_of(conv_col), text_of(turn_col)).cast("binary")), F.lit(20)).alias("kind"))
    broken = rows.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"))
    return broken.drop("copy")
