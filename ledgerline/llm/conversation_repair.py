"""Conversation structure repair by iterative-deepening A*.

``faults`` orders each conversation's rows and names every row's first fault; ``repair`` finds the cheapest edits that make
the role initials ``(s?(ua)+)?``, the ASCII-least of equally cheap ones, and gives audit, counts and the repaired text's hash.

The search is depth-first in the order of the edits' initials (D, I, K, R) under a cost bound that starts at an admissible
estimate and grows to the least cost that went over it; the first accepting path under the first bound that has one is the
answer.  Where the search stands is (row, state of the pattern); a table keeps the cost that failed there as a proven lower
bound, so no position is searched twice for the same budget.

How it is spread: the faults come from two windows, without Python.  A conversation's rows become one character
each (role initial, and whether it must go or is cut off), in segments of at most SEGMENT rows that are searched
independently, in parallel: a conversation of one segment from its start to an accepting end, a segment of a longer one from
every state to every state, whereupon the least chain of segments is picked (smaller audits first among equals; as an audit's
inserts stand before a row, or at the very end, no audit of a segment is the beginning of another) and audited.  The texts are
streamed once more, a row at a time, to hash the repaired conversation.  A SHA-256 is sequential, so one
conversation's texts go through one task; nothing of it is held there but its audit, which the result holds as one value anyway.

Defined cases: a null role or text, in the rule for damage also a null conv_id or turn, is one space; rows of a null conv_id
are one conversation, and null turns come first.  Rows of equal turn are ordered by role and text; equal rows are alike, all but the
first of them duplicates.  A conversation that loses all rows keeps its row, with zeros, an empty audit and the hash of the
empty text.  Texts may be of any length.  An empty table gives no rows.  Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType

from ledgerline.llm.common import shuffle_width, written

SEGMENT = 64
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
#: States of the pattern by what was last given: nothing, a system row, a user row, an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (START, ASSISTANT)
FOLLOWS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT = (USER, USER, ASSISTANT, USER)  # the only state that a made user or assistant row leads to
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
OVER = 1 << 40
FOUND = -1
KEEP = 50_000

WHITE = " \t\n\x0b\x0c\r"


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows damaged by crc32 of ``conv_id:turn`` modulo 20; dropped ones stay, marked."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    df = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), space).alias("role"),
                     F.coalesce(F.col("text").cast("string"), space).alias("text"), (F.crc32(name.cast("binary")) % 20).alias("deal"))
    copies = F.when(F.col("deal") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.select("conv_id", "turn", F.when(F.col("deal") == 4, "user").otherwise(F.col("role")).alias("role"),
                     F.when(F.col("deal") == 1, "").when(F.col("deal") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                     (F.col("deal") == 0).alias("gone"), F.explode(copies).alias("_copy")).drop("_copy")


def faults(rows: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text, gone), numbered in their conversation (``place``, from 1; dropped ones last), with
    ``fault`` (blank, duplicate, truncated or null), ``code`` (initial for the search) and ``illegal``.

    The rows are dealt by conversation once; both windows, along the conversation and along equal rows of it, use that."""
    line = Window.partitionBy("conv_id").orderBy("gone", F.col("turn").asc_nulls_first(), "role", "text")
    held = rows.select("*", F.row_number().over(line).alias("place"), F.lag(F.substring("role", 1, 1)).over(line).alias("_before"))
    held = held.withColumn("_nth", F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("place")))
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = (F.when(F.col("gone"), None).when(end == "", "blank")
             .when(F.col("_nth") > 1, "duplicate")
             .when(~F.substring(end, -1, 1).isin(".", "!", "?"), "truncated"))
    initial = F.substring("role", 1, 1)
    plain = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    code = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(plain)).otherwise(plain)
    return held.withColumn("fault", fault).select(
        "conv_id", "turn", "role", "text", "gone", "place", "fault", code.alias("code"),
        F.coalesce(~F.col("gone") & ~F.concat("_before", initial).isin(*LEGAL), F.lit(False)).alias("illegal"))


def _moves(code: str, state: int) -> list[tuple[str, int, int, int]]:
    """(initial, cost, rows taken, next state) in ASCII order; ``code`` is empty at the end."""
    out = [("D", DELETE, 1, state)] if code else []
    out.append(("I", INSERT, 0, NEXT[state]))
    if code and code != "x":
        extra = CUT_OFF if code.isupper() else 0
        kept = FOLLOWS.get((state, code.lower()))
        if kept is not None:
            out.append(("K", extra, 1, kept))
        out.append(("R", REROLE + extra, 1, NEXT[state]))
    return out


MOVES = {(code, state): _moves(code, state) for code in ("", *"xsuaoSUAO") for state in range(4)}


def estimates(codes: str) -> list[int]:
    """For each row, a cost that the rows from it on take at least: 2 for one that must or, cut off, may as well go, 1 for an
    unknown role, 1 for two sound neighbours (rows that must go between them aside) that cannot both stay."""
    n = len(codes)
    out, between, after, behind = [0] * (n + 1), 0, "", 0
    for i in range(n - 1, -1, -1):
        c = codes[i]
        if c == "x" or c.isupper() or c == "o":
            out[i] = out[i + 1] + (1 if c == "o" else DELETE)
        else:
            out[i] = out[i + 1]
            if after and c + after not in LEGAL:
                out[i] = max(out[i], 1 + between + behind)
        if c == "x":
            between += DELETE
        else:
            after, between, behind = (c if c in "sua" else ""), 0, out[i + 1]
    return out


def search(codes: str, entry: int, exits: tuple[int, ...], last: bool) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits from a state to one of ``exits``, the ASCII-least of equals; None if there are none.
    Rows may be inserted after the last row only where the conversation ends there (``last``)."""
    to_system = entry == START and "s" in codes.lower()
    if not last and not any(e >= USER or e == entry or (e == SYSTEM and to_system) for e in exits):
        return None
    n, least, failed, path = len(codes), estimates(codes), {}, []

    def at_least(i: int, state: int) -> int:
        known = failed.get((i, state))
        if known is not None:
            return known
        if i < n and codes[i] in "sua" and (state, codes[i]) not in FOLLOWS:
            return max(least[i], REROLE + least[i + 1])
        return least[i]

    def down(i: int, state: int, budget: int) -> int:
        if i == n and state in exits:
            return FOUND
        if i == n and not last:
            return OVER
        if (low := at_least(i, state)) > budget:
            return low
        over = OVER
        for initial, cost, taken, then in MOVES[codes[i] if i < n else "", state]:
            low = at_least(i + taken, then) if cost > budget else down(i + taken, then, budget - cost)
            if low == FOUND:
                path.append(initial)
                return FOUND
            over = min(over, cost + low)
        failed[i, state] = over
        return over

    bound = at_least(0, entry)
    while (over := down(0, entry, bound)) != FOUND:
        if over >= OVER:
            return None
        bound = over
    return bound, "".join(reversed(path))


def table_of(codes: str, last: bool) -> list[tuple[int, int, int, int]]:
    """(entry, exit, cost, rank of its audit among the entry's) of a segment; the last one's exit is any accepting state."""
    out = []
    for entry in range(4):
        found = []
        for exits in ([ACCEPTING] if last else [(e,) for e in range(4)]):
            hit = search(codes, entry, exits, last)
            if hit:
                found.append((hit[1], exits[0], hit[0]))
        out += [(entry, e, cost, rank) for rank, (_, e, cost) in enumerate(sorted(found))]
    return out


def chained(tables: list[list[tuple[int, int, int, int]]]) -> list[tuple[int, int]]:
    """(entry, exit) of each segment on the cheapest chain from the start, smaller audits first among equals."""
    rest, choice = [0] * 4, []
    for k in range(len(tables) - 1, -1, -1):
        best: list = [(OVER, 0, 0)] * 4
        for entry, leave, cost, rank in tables[k]:
            best[entry] = min(best[entry], (cost + (rest[leave] if k < len(tables) - 1 else 0), rank, leave))
        rest = [b[0] for b in best]
        choice.append([b[2] for b in best])
    out, state = [], START
    for leave in reversed(choice):
        out.append((state, leave[state]))
        state = leave[state]
    return out


def _by_batch(work):
    """A ``mapInArrow`` function of rows as dictionaries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [work(r) for r in batch.to_pylist()]
            names = list(rows[0]) if rows else []
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("conv_id") if c == "conv_id" else pa.array([r[c] for r in rows], _ARROW[c]) for c in names], names)

    return run


_ARROW = {"seg": pa.int64(), "audit": pa.string(), "steps": pa.list_(pa.list_(pa.int64()))}
_MEMO: dict[tuple, tuple[int, str] | None] = {}


def _searched(r: dict) -> dict:
    """The audit of a segment between its states; equal segments are searched once a worker."""
    key = (r["codes"], r["entry"], r["leave"], r["last"])
    if key not in _MEMO:
        if len(_MEMO) > KEEP:
            _MEMO.clear()
        _MEMO[key] = search(r["codes"], r["entry"], ACCEPTING if r["last"] else (r["leave"],), r["last"])
    return {"conv_id": r["conv_id"], "seg": r["seg"], "audit": _MEMO[key][1]}


def _tabled(r: dict) -> dict:
    return {"conv_id": r["conv_id"], "seg": r["seg"], "steps": table_of(r["codes"], r["last"])}


def _picked(r: dict) -> dict:
    return {"conv_id": r["conv_id"], "steps": chained([[tuple(s) for s in t["steps"]] for t in r["tables"]])}


def audits(spark: SparkSession, found: DataFrame) -> DataFrame:
    """(conv_id, seg, audit) of the rows that ``faults`` gave."""
    kind = found.schema["conv_id"].dataType.simpleString()
    seg = F.floor((F.col("place") - 1) / SEGMENT)
    codes = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "code"))), lambda x: x["code"]), "")
    size = found.filter("NOT gone").groupBy("conv_id").agg(F.max("place").alias("_n"))
    segments = found.filter("NOT gone").groupBy("conv_id", seg.alias("seg")).agg(codes.alias("codes"))
    segments = (segments.join(size.withColumnRenamed("conv_id", "_c"), F.col("conv_id").eqNullSafe(F.col("_c")))
                .select("conv_id", "seg", "codes", ((F.col("seg") + 1) * SEGMENT >= F.col("_n")).alias("last"), (F.col("_n") > SEGMENT).alias("_long")))
    # dealt anew by number: searches cost time, not bytes, by which small partitions would be joined
    segments = written(spark, segments, "segments").repartition(shuffle_width(spark), "conv_id", "seg")
    short = segments.filter("NOT _long").select("conv_id", "seg", "codes", "last", F.lit(START).alias("entry"), F.lit(START).alias("leave"))
    many = segments.filter("_long").drop("_long")
    if not many.isEmpty():
        tables = many.mapInArrow(_by_batch(_tabled), f"conv_id {kind}, seg long, steps array<array<long>>")
        tables = tables.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("seg", "steps"))).alias("tables"))
        picked = tables.mapInArrow(_by_batch(_picked), f"conv_id {kind}, steps array<array<long>>")
        picked = picked.select(F.col("conv_id").alias("_c"), F.posexplode("steps").alias("_seg", "step"))
        picked = many.join(picked, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("seg") == F.col("_seg")))
        short = short.unionByName(picked.select("conv_id", "seg", "codes", "last", F.col("step")[0].cast("int").alias("entry"),
                                                F.col("step")[1].cast("int").alias("leave")))
    return short.mapInArrow(_by_batch(_searched), f"conv_id {kind}, seg long, audit string")


class _Conversation:
    """Counts, audit and hash of one conversation, fed its rows and audits in order."""

    def __init__(self):
        self.count = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.cost = self.turns = self.at = 0
        self.low = self.high = None
        self.audit: list[str] = []
        self.todo, self.state = "", START
        self.hash, self.lines = hashlib.sha256(), 0

    def _line(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.lines else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.lines += 1

    def more(self, audit: str) -> None:
        self.audit.append(audit)
        self.todo, self.at = self.todo[self.at :] + audit, 0

    def _inserts(self) -> None:
        while self.at < len(self.todo) and self.todo[self.at] == "I":
            self.at, self.state, self.cost = self.at + 1, NEXT[self.state], self.cost + INSERT
            self._line(ROLE[self.state], "")

    def row(self, turn, role: str, text: str, fault, illegal: bool) -> None:
        if fault:
            self.count[fault] += 1
        self.illegal += illegal
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = (turn if self.low is None else self.low), turn
        self._inserts()
        edit, self.at = self.todo[self.at], self.at + 1
        if edit == "D":
            self.cost += DELETE
            return
        if edit == "R":
            self.state = NEXT[self.state]
            role = ROLE[self.state]
        else:
            self.state = FOLLOWS[self.state, role[:1]]
        self.cost += (edit == "R") * REROLE + (fault == "truncated") * CUT_OFF
        self._line(role, text)

    def result(self) -> tuple:
        self._inserts()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, *self.count.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _streamed(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            own = [pa.array([r[0] for r in rows], kind)]
            own += [pa.array([r[1][i] for r in rows], pa.int64() if i < 6 else pa.string()) for i in range(len(RESULT))]
            return pa.RecordBatch.from_arrays(own, ["conv_id", *RESULT])

        done, now, held = [], (), None
        for b in batches:
            for conv, turn, role, text, gone, fault, illegal, audit in zip(*(c.to_pylist() for c in b.columns)):
                if now != (conv,):
                    if held:
                        done.append((now[0], held.result()))
                    now, held = (conv,), _Conversation()
                if audit is not None:
                    held.more(audit)
                elif not gone:
                    held.row(turn, role, text, fault, illegal)
            if len(done) > 1000:
                yield batch(done)
                done = []
        if held:
            done.append((now[0], held.result()))
        if done:
            yield batch(done)

    return run


def _arrow(kind: DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def repair(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text, gone): counts of faults, cost, audit and repaired_sha256."""
    found = written(spark, faults(rows), "faults")
    own = found.select("conv_id", "turn", "role", "text", "gone", "fault", "illegal", F.lit(None).cast("string").alias("audit"),
                       F.col("place").cast("long").alias("place"), F.lit(1).alias("kind"))
    heads = audits(spark, found).select(
        "conv_id", F.lit(None).cast(found.schema["turn"].dataType).alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"), F.lit(False).alias("gone"), F.lit(None).cast("string").alias("fault"),
        F.lit(False).alias("illegal"), "audit", (F.col("seg") * SEGMENT + 1).alias("place"), F.lit(0).alias("kind"))
    line = own.unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", "gone", "place", "kind").drop("place", "kind")
    kind = found.schema["conv_id"].dataType
    schema = StructType([StructField("conv_id", kind), *[StructField(c, LongType() if i < 6 else StringType()) for i, c in enumerate(RESULT)]])
    return line.mapInArrow(_streamed(_arrow(kind)), schema)
