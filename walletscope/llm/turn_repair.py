"""The cheapest repair of a conversation's turn order, by dynamic programming over square-root checkpoints.

The role initials of a repaired conversation read ``(s?(ua)+)?``. Its rows, in order, are kept
(0), given the role user or assistant (1) or deleted (2; blank and duplicate rows must be), and
empty user or assistant turns are put in anywhere (5). A truncated row that is not deleted adds 5.
Of the cheapest edits those come out whose initials (D, I, K, R) are ASCII-least.

Four states say what has been read so far: nothing, a system turn, a user turn, a whole pair.
The state-cost vector before a row is the cost of the cheapest way on from each state.

- A conversation's rows are cut at 64 times the square numbers, so its blocks and the
  rows of each grow with the square root of its length.
- Each block gives the costs from each state before it to each state behind it, a 4 by 4 table.
  Taken backward, these tables give the state-cost vectors at the checkpoints, the only ones kept.
- Each block recomputes its own vectors from the checkpoint behind it and walks forward from each
  state, always along the least tight edit. Which state it is really entered in follows from
  the blocks before it; that picks one of its four scripts.

So tasks hold a block or a conversation's checkpoints, both of the order of the square root of
its rows. Texts stay in rows; only ``digests``, a hash of a whole conversation, takes one
conversation's rows in turn through one task, a batch at a time.

Defined results
- NULL conversation id: a conversation. NULL role or text: empty. A role without an initial s, u
  or a cannot be kept. NULL turn: before the others, not counted in ``gaps``.
- Very long text: a row. Ties of ``turn``: by role, then by the text's hash. Repeated rows: the
  second is a duplicate. Empty table: empty results. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from walletscope.llm.worker import text_slices
from walletscope.plans.running import running_sum
from walletscope.plans.settle import settle

#: Rows of a conversation's first block; block k begins at this many times k squared.
FIRST = 64
#: Fixed costs of the edits.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
_FAR = 1 << 50
_BEGIN, _SYSTEM, _USER, _PAIR = range(4)
_AFTER = {"s": {_BEGIN: _SYSTEM}, "u": {_BEGIN: _USER, _SYSTEM: _USER, _PAIR: _USER}, "a": {_USER: _PAIR}}
_FILLED = (_USER, _USER, _PAIR, _USER)  # behind a user or assistant turn that is put in or made by a new role
_NEXT = ("u", "u", "a", "u")            # and which of the two it is
_LEGAL = {"su", "ua", "au"}

Vector = list[int]


# --- one conversation's costs ----------------------------------------------------------------
# A row's code: its initial (s, u, a or o for any other) in lower case; in upper case if it is
# truncated; and in digits (0, 1, 2, 3) if it must go.

def _initial(code: str) -> str:
    return "suao"[int(code)] if code.isdigit() else code.lower()


def _with_inserts(costs: Vector) -> Vector:
    """Costs when turns may be put in before."""
    begin, system, user, pair = costs
    user, pair = min(user, INSERT + pair), min(pair, INSERT + user)
    return [min(begin, INSERT + user), min(system, INSERT + user), user, pair]


#: The cost behind the last row.
END = _with_inserts([0, _FAR, _FAR, 0])


def _kept(code: str, state: int, after: Vector) -> int:
    if code.isdigit() or state not in _AFTER.get(code.lower(), ()):
        return _FAR
    return after[_AFTER[code.lower()][state]] + (TRUNCATED if code.isupper() else 0)


def _reroled(code: str, state: int, after: Vector) -> int:
    return _FAR if code.isdigit() else after[_FILLED[state]] + REROLE + (TRUNCATED if code.isupper() else 0)


def before(code: str, after: Vector) -> Vector:
    """The state costs before a row from those behind it."""
    return _with_inserts([min(DELETE + after[s], _kept(code, s, after), _reroled(code, s, after)) for s in range(4)])


def table(codes: str) -> list[int]:
    """Costs of a block from each state (rows) to each state (columns)."""
    columns = []
    for last in range(4):
        costs = [0 if s == last else _FAR for s in range(4)]
        for code in reversed(codes):
            costs = before(code, costs)
        columns.append(costs)
    return [min(columns[t][s], _FAR) for s in range(4) for t in range(4)]


def checkpoints(tables: list[list[int]]) -> list[Vector]:
    """The vector before each block and behind the last, from the blocks' tables."""
    costs = [END]
    for t in reversed(tables):
        costs.append([min(t[4 * s + x] + costs[-1][x] for x in range(4)) for s in range(4)])
    return costs[::-1]


def scripts(codes: str, behind: Vector, last: bool) -> list[tuple[str, int]]:
    """For each state before the block, the least tight edits and the state behind it.

    A script has ``u`` or ``a`` for a turn put in; a row's own edit is D, K, U or A (a new role).
    """
    vectors = [behind]
    for code in reversed(codes):
        vectors.append(before(code, vectors[-1]))
    vectors.reverse()
    found = []
    for state in range(4):
        edits = []
        for i, code in enumerate(codes):
            here, after = vectors[i], vectors[i + 1]
            while here[state] != DELETE + after[state] and here[state] == INSERT + here[_FILLED[state]]:
                edits.append(_NEXT[state])
                state = _FILLED[state]
            if here[state] == DELETE + after[state]:
                edits.append("D")
            elif here[state] == _kept(code, state, after):
                edits.append("K")
                state = _AFTER[code.lower()][state]
            else:
                edits.append(_NEXT[state].upper())
                state = _FILLED[state]
        while last and state not in (_BEGIN, _PAIR):
            edits.append(_NEXT[state])
            state = _FILLED[state]
        found.append(("".join(edits), state))
    return found


def illegal_pairs(initials: str) -> int:
    return sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))


# --- rows, blocks and checkpoints as tables ----------------------------------------------------

def _per_row(make: Callable[..., dict], schema: str) -> Callable[[DataFrame], DataFrame]:
    """Plain rows in, plain rows out, batch by batch."""
    shape = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [make(**row) for row in batch.to_pylist()]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, shape)

    return lambda df: df.mapInArrow(run, schema)


def _tables(key: str, block: int, codes: str) -> dict:
    initials = "".join(map(_initial, codes))
    return {"key": key, "block": block, "costs": table(codes), "first": initials[0], "last": initials[-1],
            "bad_pairs": illegal_pairs(initials)}


def _checkpoints(key: str, blocks: list[dict]) -> dict:
    joints = sum(illegal_pairs(a["last"] + b["first"]) for a, b in zip(blocks, blocks[1:]))
    vectors = checkpoints([b["costs"] for b in blocks])
    behind = [{"block": b["block"], "behind": v, "final": i == len(blocks) - 1}
              for i, (b, v) in enumerate(zip(blocks, vectors[1:]))]
    return {"key": key, "cost": vectors[0][_BEGIN], "illegal": joints + sum(b["bad_pairs"] for b in blocks), "points": behind}


def _scripts(key: str, block: int, codes: str, behind: list[int], final: bool) -> dict:
    found = scripts(codes, behind, final)
    return {"key": key, "block": block, "scripts": [s for s, _ in found], "exits": [x for _, x in found]}


def key_of(conv: Column) -> Column:
    """A text for each conversation id, NULL included."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def numbered(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """Rows with their place in the conversation, written. Very long conversations are numbered in slices of turns."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    bare = F.rtrim(F.col("text"), F.lit(" \t\n\u000b\f\r"))
    rows = turns.select(key_of(F.col(conv_col)).alias("key"), F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), text.alias("text"))
    rows = rows.select("*", F.sha2("text", 256).alias("text_hash"), (bare == "").alias("blank"),
                       (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    placed = running_sum(rows, ["key"], ["turn", "role", "text_hash"], F.floor(F.col("turn") / (1 << 20)), F.lit(1), "pos")
    return settle(placed.withColumn("pos", F.col("pos").cast("bigint")), "turns")


def _faults(rows: DataFrame) -> DataFrame:
    """key, pos, turn, each row's first fault and its code."""
    narrow = rows.select("key", "pos", "turn", "role", "text_hash", "blank", "cut")
    seen = narrow.groupBy("key", "role", "text_hash").agg(F.min("pos").alias("_first"))
    fault = (F.when(F.col("blank"), "blank").when(F.col("pos") > F.col("_first"), "duplicate")
             .when(F.col("cut"), "truncated"))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    code = (F.when(F.col("fault") == "truncated", F.upper("letter"))
            .when(F.col("fault").isNotNull(), F.translate("letter", "suao", "0123")).otherwise(F.col("letter")))
    return (narrow.join(seen, ["key", "role", "text_hash"])
            .select("key", "pos", "turn", fault.alias("fault"), letter.alias("letter")).withColumn("code", code))


def _blocks(faults: DataFrame) -> DataFrame:
    """key, block, codes: a block's rows are of the order of the square root of its conversation's."""
    number = F.floor(F.sqrt(F.floor(F.col("pos") / FIRST))).cast("bigint")
    listed = F.array_sort(F.collect_list(F.struct("pos", "code")))
    return (faults.groupBy("key", number.alias("block")).agg(listed.alias("_rows"))
            .select("key", "block", F.array_join(F.col("_rows.code"), "").alias("codes")))


class Repair:
    """The tables of a repair, written once: rows, faults, cost per conversation, script per block."""

    def __init__(self, turns: DataFrame, **columns: str):
        self.rows = numbered(turns, **columns)
        self.faults = settle(_faults(self.rows), "turn-faults")
        blocks = settle(_blocks(self.faults), "turn-blocks")
        listed = _per_row(_tables, "key string, block bigint, costs array<bigint>, first string, last string, bad_pairs bigint")(blocks)
        in_order = F.array_sort(F.collect_list(F.struct("block", "costs", "first", "last", "bad_pairs")))
        point = "struct<block: bigint, behind: array<bigint>, final: boolean>"
        self.costs = settle(_per_row(_checkpoints, f"key string, cost bigint, illegal bigint, points array<{point}>")(
            listed.groupBy("key").agg(in_order.alias("blocks"))), "turn-checkpoints")
        points = self.costs.select("key", F.explode("points").alias("_p")).select("key", "_p.*")
        walked = settle(_per_row(_scripts, "key string, block bigint, scripts array<string>, exits array<bigint>")(
            blocks.join(points, ["key", "block"])), "turn-scripts")
        way = F.aggregate(
            F.array_sort(F.collect_list(F.struct("block", "exits"))), F.array(F.lit(0).cast("bigint")),
            lambda seen, b: F.concat(seen, F.array(F.get(b["exits"], F.element_at(seen, -1).cast("int")))))
        entered = (walked.groupBy("key").agg(way.alias("_way"), F.array_sort(F.collect_list("block")).alias("_blocks"))
                   .select("key", F.explode(F.arrays_zip("_blocks", "_way")).alias("_e"))
                   .where("_e._blocks IS NOT NULL").select("key", F.col("_e._blocks").alias("block"), F.col("_e._way").alias("state")))
        self.script = settle(walked.join(entered, ["key", "block"]).select(
            "key", "block", F.get("scripts", F.col("state").cast("int")).alias("script")), "turn-script")


def report(repair: Repair) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    def count(fault: str) -> Column:
        return F.count(F.when(F.col("fault") == fault, 1)).alias(fault)

    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    facts = repair.faults.groupBy("key").agg(F.coalesce(span, F.lit(0)).cast("bigint").alias("gaps"), *map(count, ("blank", "duplicate", "truncated")))
    audits = (repair.script.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("block", "script"))).alias("_s"))
              .select("key", F.translate(F.array_join(F.col("_s.script"), ""), "uaUA", "IIRR").alias("audit")))
    names = repair.rows.groupBy("key").agg(F.first("conv_id").alias("conv_id"))
    return (names.join(facts, "key").join(repair.costs.select("key", "cost", "illegal"), "key").join(audits, "key")
            .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"))


def repaired(repair: Repair) -> DataFrame:
    """The repaired turns: conv_id, pos and at (their order), role, text.

    Rows meet their edits by conversation and place, so a long conversation is spread too.
    """
    start = F.col("block") * F.col("block") * FIRST
    steps = repair.script.select("key", start.alias("_start"), F.posexplode(
        F.regexp_extract_all("script", F.lit("([ua]*[DKUA]|[ua]+$)"))).alias("_i", "step"))
    steps = steps.select("key", (F.col("_start") + F.col("_i")).alias("pos"), "step")
    rows = repair.rows.select("key", "conv_id", "pos", "role", "text").withColumn("_row", F.lit(True))
    whose = repair.rows.groupBy("key").agg(F.first("conv_id").alias("_conv"))
    tails = steps.where(~F.col("step").rlike("[DKUA]")).join(whose, "key").select(
        "key", F.col("_conv").alias("conv_id"), "pos", F.lit("").alias("role"), F.lit("").alias("text"), "step")
    edited = rows.join(steps, ["key", "pos"]).select("key", "conv_id", "pos", "role", "text", "step").unionByName(tails)
    full = F.create_map(*(F.lit(x) for x in ("u", "user", "a", "assistant", "U", "user", "A", "assistant")))
    letters = F.filter(F.split("step", ""), lambda x: ~x.isin("", "D"))
    piece = F.transform(letters, lambda x: F.struct(
        F.when(x == "K", F.col("role")).otherwise(F.element_at(full, x)).alias("role"),
        F.when(x.isin("u", "a"), F.lit("")).otherwise(F.col("text")).alias("text")))
    return edited.select("key", "conv_id", "pos", F.posexplode(piece).alias("at", "_turn")).select(
        "key", "conv_id", "pos", "at", "_turn.role", "_turn.text")


def digests(turns: DataFrame) -> DataFrame:
    """Of ``repaired`` turns: key and the SHA-256 of their ``role:text`` lines, joined by newlines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            keys = batch.column(0).to_pylist()
            done = []
            for part, lines in text_slices(batch.column(1), 1 << 20):
                for k, line in zip(keys[part], lines):
                    if k != key:
                        if key is not None:
                            done.append((key, state.hexdigest()))
                        key, state = k, hashlib.sha256(line.encode())
                    else:
                        state.update(b"\n")
                        state.update(line.encode())
            if done:
                yield pa.RecordBatch.from_pylist([{"key": k, "sha256": s} for k, s in done])
        if key is not None:
            yield pa.RecordBatch.from_pylist([{"key": key, "sha256": state.hexdigest()}])

    line = F.concat("role", F.lit(":"), "text").alias("line")
    ordered = turns.select("key", "pos", "at", line).repartition("key").sortWithinPartitions("key", "pos", "at")
    return ordered.select("key", "line").mapInArrow(run, "key string, sha256 string")
