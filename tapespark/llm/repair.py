"""Repair of conversations by Knuth's lightest-derivation agenda.

A conversation's roles shall read ``(s?(ua)+)?`` in initials.  What is left to repair is a
weighted deduction over items (rows left, state of the pattern): an edit of the row before
and the item of the rows behind it give a further item.

- Keep costs 0, Rerole to user or assistant 2, Delete 3, Insert of an empty user or assistant
  row 2.  Rows that are blank or said before can only be deleted; a truncated row that is not
  deleted adds 1.
- An item's value is (cost, rows done, audit), where the audit is the initials of its edits.
  Every deduction raises the cost or, at the same cost, the rows done (so it is superior), and
  puts one letter before the audit (so it is monotone).  The agenda pops the least value,
  which is final, until the goal item, all rows and the pattern's start, is popped.

Conversations of up to LONG rows are judged whole in the task that sorts them.  Longer ones are
ordered over ranges and cut into segments of SEGMENT rows; agendas give every segment's
lightest derivation between any two states, and a fold over the segments picks those that
make the lightest whole.  A segment's derivations end with the edit of a row, so none is the
start of another at the same cost and letters of segments compare like whole audits.  The
audit is one value of a conversation's row and the SHA-256 of the repaired text has to read it in
order, so these two pass through one task per conversation, as letters and as a stream.

Rows are taken by turn (nulls first), rows of the same turn by role, the first 64 characters
and the SHA-256 of their text.  Null roles and texts count as one space; null conv_ids are one
conversation; repeated rows are duplicates; a role without one of the initials s, u, a can
not be kept.  Empty tables give no rows; columns other than conv_id, turn, role and text are
not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapespark.session import scratch_path

#: Rows of a conversation that is judged whole, and rows of a segment of a longer one.
LONG = 256
SEGMENT = 512
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1
WHITE = " \t\n\x0b\x0c\r"
#: States of the pattern: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STEPS = {
    (START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U,
    (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U,
}
ACCEPTED = (START, AFTER_A)
#: The role that an insertion or a new role gets in each state.
NAMED = {START: "user", AFTER_S: "user", AFTER_U: "assistant", AFTER_A: "user"}
LEGAL = {"su", "ua", "au"}
MOST = (1 << 63) - 1

#: What the agenda knows of a row: the role's initial, whether it must go, whether it is cut off.
Row = tuple[str, bool, bool]
_edits: dict[Row, list[list[tuple[int, int, str]]]] = {}


def edits(row: Row) -> list[list[tuple[int, int, str]]]:
    """By the state after a row: (state before, cost, initial) of its possible edits."""
    if row not in _edits:
        initial, must_go, cut_off = row
        extra = CUT_OFF if cut_off else 0
        into: list[list[tuple[int, int, str]]] = [[(q, DELETE, "D")] for q in range(4)]
        if not must_go:
            for (p, r), q in STEPS.items():
                if r == initial:
                    into[q].append((p, KEEP + extra, "K"))
                if r == NAMED[p][0]:
                    into[q].append((p, REROLE + extra, "R"))
        _edits[row] = into
    return _edits[row]


INSERTS = [[p for (p, r), q in STEPS.items() if q == state and r == NAMED[p][0]] for state in range(4)]


def lightest(
    rows: list[Row], exits: Iterable[int], goals: Iterable[int] = (START,), behind: bool = True
) -> dict[int, tuple[int, str]]:
    """(cost, audit) of the lightest derivation of all ``rows`` by the state they begin in.

    ``exits``: states the rows may end in; ``goals``: states asked for; ``behind``: rows may be
    inserted behind the last one, else every derivation ends with a row's edit.
    """
    agenda = [(0, 0, "", state) for state in exits]
    heapq.heapify(agenda)
    final: set[tuple[int, int]] = set()
    found: dict[int, tuple[int, str]] = {}
    n, asked = len(rows), set(goals)
    while agenda and asked:
        cost, done, audit, state = heapq.heappop(agenda)
        if (done, state) in final:
            continue
        final.add((done, state))
        if done == n:
            found[state] = (cost, audit)
            asked.discard(state)
        else:
            for before, price, letter in edits(rows[n - 1 - done])[state]:
                if (done + 1, before) not in final:
                    heapq.heappush(agenda, (cost + price, done + 1, letter + audit, before))
        if done or behind:
            for before in INSERTS[state]:
                if (done, before) not in final:
                    heapq.heappush(agenda, (cost + INSERT, done, "I" + audit, before))
    return found


def repaired(initials: list[str], audit: str, state: int = START) -> Iterator[tuple[int, str, str | None]]:
    """(row, edit, role) of every edit that leaves a row; role is None where the row's own stays.

    An inserted row carries the number of the row before which it stands.
    """
    at = 0
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        initial = initials[at] if letter == "K" else NAMED[state][0]
        yield at, letter, None if letter == "K" else NAMED[state]
        state = STEPS[state, initial]
        at += letter != "I"


def gap_count(turns: list[int | None]) -> int:
    known = {t for t in turns if t is not None}
    return min(max(known) - min(known) + 1 - len(known), MOST) if known else 0


def illegal_count(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): the rows with faults planted by their CRC-32.

    Rows to be dropped stay, marked ``gone``, so that no conversation is forgotten.
    """
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    kind = F.crc32(key) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conversations.select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def untouched(conversations: DataFrame) -> DataFrame:
    """Rows as they are, in the form of ``damage``."""
    return conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), F.lit(False).alias("gone"),
    )


def _told(rows: DataFrame) -> DataFrame:
    """Rows with what the agenda asks of each but whether it was said before."""
    last = F.substring(F.rtrim("text", F.lit(WHITE)), -1, 1)
    return rows.select(
        "conv_id", "turn", "role", "text", "gone",
        F.substring("role", 1, 1).alias("initial"),
        (last == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("cut_off"),
        F.sha2("text", 256).alias("digest"),
    )


def _order() -> list[Column]:
    return [
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"),
        F.substring("text", 1, 64), F.col("digest"),
    ]


LINE = "struct<role:string,text:string,edit:string>"
COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
JUDGED = f"conv_id long, {COUNTS}, lines array<{LINE}>"
_LINE_TYPE = pa.struct([("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
_JUDGED_TYPES = {
    "conv_id": pa.int64(), "gaps": pa.int64(), "blank": pa.int64(), "duplicate": pa.int64(),
    "truncated": pa.int64(), "illegal": pa.int64(), "cost": pa.int64(), "audit": pa.string(),
    "lines": pa.list_(_LINE_TYPE),
}


def judge(turns: list[int | None], told: list[tuple[str, str, str, bool, bool]]) -> tuple:
    """Counts, cost, audit and repaired lines of a conversation's (role, text, initial, blank, cut_off)."""
    seen: set[tuple[str, str]] = set()
    rows: list[Row] = []
    blank = duplicate = truncated = 0
    for role, text, initial, is_blank, cut_off in told:
        again = not is_blank and (role, text) in seen
        seen.add((role, text))
        cut_off = cut_off and not (is_blank or again)
        blank, duplicate, truncated = blank + is_blank, duplicate + again, truncated + cut_off
        rows.append((initial, is_blank or again, cut_off))
    initials = [r[0] for r in rows]
    cost, audit = lightest(rows, ACCEPTED)[START]
    lines = [
        {"role": role or told[at][0], "text": "" if edit == "I" else told[at][1], "edit": edit}
        for at, edit, role in repaired(initials, audit)
    ]
    return gap_count(turns), blank, duplicate, truncated, illegal_count(initials), cost, audit, lines


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of rows that come in order; only the current one's rows are held."""
    none = object()
    current, turns, told, out = none, [], [], []

    def close() -> None:
        if current is not none:
            out.append((current, *judge(turns, told)))

    def batch_of() -> pa.RecordBatch:
        arrays = [pa.array(c, k) for c, k in zip(zip(*out), _JUDGED_TYPES.values())]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, names=list(_JUDGED_TYPES))

    for batch in batches:
        columns = (batch.column(n).to_pylist() for n in ("conv_id", "turn", "gone", "role", "text", "initial", "blank", "cut_off"))
        for conv_id, turn, gone, *rest in zip(*columns):
            if current is none or conv_id != current:
                close()
                current, turns, told = conv_id, [], []
            if not gone:
                turns.append(turn)
                told.append(tuple(rest))
        if out:
            yield batch_of()
    close()
    if out:
        yield batch_of()


STATES = "array<struct<before:int,after:int,cost:long,audit:string>>"
SEGMENTS = (
    "conv_id long, place long, part int, block long, blank long, duplicate long, truncated long, illegal long, "
    f"first_initial string, last_initial string, turns array<long>, distinct_turns long, derivations {STATES}"
)


def _row_of(initial: str, blank: bool, again: bool, cut_off: bool) -> Row:
    return initial, blank or again, cut_off and not (blank or again)


def _ordered_rows(table: pa.Table) -> list[dict]:
    return sorted(table.to_pylist(), key=lambda r: r["place"])


def _segment(key: tuple, table: pa.Table) -> pa.Table:
    """Counts of a segment's rows and its lightest derivations from state to state."""
    rows = _ordered_rows(table)
    known = [_row_of(r["initial"], r["blank"], r["again"], r["cut_off"]) for r in rows]
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    initials = [r["initial"] for r in rows]
    derivations = [
        {"before": p, "after": q, "cost": cost, "audit": audit}
        for q in range(4) for p, (cost, audit) in lightest(known, (q,), range(4), behind=False).items()
    ]
    conv_id, part, block = (k.as_py() for k in key)
    out = {
        "conv_id": conv_id, "place": rows[0]["place"], "part": part, "block": block,
        "blank": sum(r["blank"] for r in rows),
        "duplicate": sum(r["again"] and not r["blank"] for r in rows),
        "truncated": sum(k[2] for k in known), "illegal": illegal_count(initials),
        "first_initial": initials[0], "last_initial": initials[-1],
        "turns": [turns[0], turns[-1]] if turns else [], "distinct_turns": len(set(turns)),
        "derivations": derivations,
    }
    return pa.Table.from_pylist([out], schema=_SEGMENT_SCHEMA)


_SEGMENT_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("place", pa.int64()), ("part", pa.int32()), ("block", pa.int64()),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
    ("first_initial", pa.string()), ("last_initial", pa.string()), ("turns", pa.list_(pa.int64())),
    ("distinct_turns", pa.int64()),
    ("derivations", pa.list_(pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
])

CHOSEN = "array<struct<part:int,block:long,state:int,audit:string>>"
FOLDED = f"conv_id long, {COUNTS}, chosen {CHOSEN}"
_FOLDED_SCHEMA = pa.schema([
    *((n, k) for n, k in _JUDGED_TYPES.items() if n != "lines"),
    ("chosen", pa.list_(pa.struct([("part", pa.int32()), ("block", pa.int64()), ("state", pa.int32()), ("audit", pa.string())]))),
])


def _folded(key: tuple, table: pa.Table) -> pa.Table:
    """Counts, cost and audit of a long conversation, and the derivation taken in each segment."""
    segments = _ordered_rows(table)
    tails = lightest([], ACCEPTED, range(4))
    costs = {state: cost for state, (cost, _) in tails.items()}
    taken: list[dict[int, tuple[int, str]]] = []
    for segment in reversed(segments):
        best: dict[int, tuple[int, str, int]] = {}
        for d in segment["derivations"]:
            value = (d["cost"] + costs[d["after"]], d["audit"], d["after"])
            if d["before"] not in best or value < best[d["before"]]:
                best[d["before"]] = value
        costs = {state: value[0] for state, value in best.items()}
        taken.append({state: (after, audit) for state, (_, audit, after) in best.items()})
    state, chosen = START, []
    for segment, ways in zip(segments, reversed(taken)):
        after, audit = ways[state]
        chosen.append({"part": segment["part"], "block": segment["block"], "state": state, "audit": audit})
        state = after
    chosen[-1]["audit"] += tails[state][1]
    distinct, low, high, ended = 0, None, None, None
    illegal = sum(s["illegal"] for s in segments)
    for k, segment in enumerate(segments):
        if k:
            illegal += segments[k - 1]["last_initial"] + segment["first_initial"] not in LEGAL
        if segment["turns"]:
            first, last = segment["turns"]
            distinct += segment["distinct_turns"] - (first == ended)
            low, high, ended = first if low is None else low, last, last
    out = {
        "conv_id": key[0].as_py(), "gaps": 0 if low is None else min(high - low + 1 - distinct, MOST),
        **{n: sum(s[n] for s in segments) for n in ("blank", "duplicate", "truncated")},
        "illegal": illegal, "cost": costs[START],
        "audit": "".join(c["audit"] for c in chosen), "chosen": chosen,
    }
    return pa.Table.from_pylist([out], schema=_FOLDED_SCHEMA)


EDITED = "conv_id long, place long, sub int, edit string, new_role string"


def _edited(rows: pa.Table, chosen: pa.Table) -> pa.Table:
    """The rows that a segment's derivation leaves, by the place of the row they come from."""
    rows, chosen = _ordered_rows(rows), chosen.to_pylist()
    out = []
    for way in chosen:
        sub = 0
        for at, edit, role in repaired([r["initial"] for r in rows], way["audit"], way["state"]):
            # What is inserted behind the last row keeps that row's place.
            place = rows[min(at, len(rows) - 1)]["place"]
            sub += 1
            out.append({"conv_id": rows[0]["conv_id"], "place": place, "sub": sub, "edit": edit, "new_role": role})
    return pa.Table.from_pylist(out, schema=pa.schema([
        ("conv_id", pa.int64()), ("place", pa.int64()), ("sub", pa.int32()), ("edit", pa.string()), ("new_role", pa.string()),
    ]))


def _judged_long(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(FOLDED, lines as conv_id, place, sub, role, text, edit) of conversations of any length."""
    spark = rows.sparkSession
    root = scratch_path(spark, "conversations")
    numbered = rows.where("not gone").drop("gone").withColumn("id", F.monotonically_increasing_id())
    schema = numbered.schema
    numbered.write.parquet(f"{root}/rows")
    numbered = spark.read.schema(schema).parquet(f"{root}/rows")
    first = numbered.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn", "id"))["id"].alias("id"))
    placed = (
        numbered.join(first.select("id", F.lit(False).alias("again")), "id", "left")
        .withColumn("again", F.coalesce("again", F.lit(True)))
        .repartitionByRange(*_order(), "id").sortWithinPartitions(*_order(), "id")
        .withColumn("part", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("block", F.floor(F.expr("place & ((1L << 33) - 1)") / SEGMENT).cast("long"))
        .drop("id", "digest")
    )
    schema = placed.schema
    placed.write.parquet(f"{root}/placed")
    placed = spark.read.schema(schema).parquet(f"{root}/placed")
    known = placed.select("conv_id", "part", "block", "place", "turn", "initial", "blank", "again", "cut_off")
    segments = known.groupBy("conv_id", "part", "block").applyInArrow(_segment, SEGMENTS)
    segments.groupBy("conv_id").applyInArrow(_folded, FOLDED).write.parquet(f"{root}/folded")
    folded = spark.read.schema(FOLDED).parquet(f"{root}/folded")
    chosen = folded.select("conv_id", F.explode("chosen").alias("way")).select("conv_id", "way.*")
    keys = ("conv_id", "part", "block")
    edited = known.groupBy(*keys).cogroup(chosen.groupBy(*keys)).applyInArrow(_edited, EDITED)
    lines = edited.join(placed.select("place", "role", "text"), "place").select(
        "conv_id", "place", "sub", F.coalesce("new_role", "role").alias("role"),
        F.when(F.col("edit") == "I", F.lit("")).otherwise(F.col("text")).alias("text"), "edit",
    )
    return folded, lines


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of lines joined by line feeds, of conversations whose lines come in order."""
    none = object()
    current, state, out = none, None, []
    for batch in batches:
        for conv_id, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist()):
            if current is none or conv_id != current:
                if current is not none:
                    out.append((current, state.hexdigest()))
                current, state = conv_id, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(line.encode("utf-8"))
    if current is not none:
        out.append((current, state.hexdigest()))
    ids, hashes = zip(*out) if out else ((), ())
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.string())], names=["conv_id", "repaired_sha256"])


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(judged conversations of up to LONG rows, ids of the longer ones, their rows if there are any)."""
    spark = rows.sparkSession
    path = scratch_path(spark, "long-conversations")
    rows.groupBy("conv_id").count().where(F.col("count") > LONG).select("conv_id").write.parquet(path)
    # Read back, so Spark knows how few or many they are.
    long = spark.read.schema("conv_id long").parquet(path)
    told = _told(rows)
    if not long.take(1):
        short, rest = told, None
    else:
        ids = long.withColumnRenamed("conv_id", "long_id")
        same = F.col("conv_id").eqNullSafe(F.col("long_id"))
        short, rest = told.join(ids, same, "left_anti"), told.join(ids, same, "left_semi")
    judged = short.repartition("conv_id").sortWithinPartitions(*_order()).drop("digest").mapInArrow(_judged, JUDGED)
    return judged, long, rest


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit): the lines of repaired conversations, ordered by place.

    ``rows``: as ``damage`` and ``untouched`` give them.  ``edit`` is K, R or I.  Places order the lines
    of a conversation and have no other meaning.
    """
    judged, _, long = _split(rows)
    lines = judged.select("conv_id", F.posexplode("lines").alias("place", "line")).select(
        "conv_id", F.lpad(F.col("place").cast("string"), 24, "0").alias("place"), "line.role", "line.text", "line.edit"
    )
    if long is None:
        return lines
    _, further = _judged_long(long)
    place = F.concat(F.lpad(F.col("place").cast("string"), 20, "0"), F.lpad(F.col("sub").cast("string"), 4, "0"))
    return lines.union(further.select("conv_id", place.alias("place"), "role", "text", "edit"))


def report(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows``: counts of faults, cost and audit of the repair, and its hash."""
    counts = [c.split()[0] for c in COUNTS.split(", ")]
    judged, ids, long = _split(rows)
    whole = F.concat_ws("\n", F.transform("lines", lambda line: F.concat(line["role"], F.lit(":"), line["text"])))
    told = judged.select("conv_id", *counts, F.sha2(whole, 256).alias("repaired_sha256"))
    if long is None:
        return told
    folded, lines = _judged_long(long)
    hashes = (
        lines.select("conv_id", "place", "sub", F.concat("role", F.lit(":"), "text").alias("line"))
        .repartition("conv_id").sortWithinPartitions("conv_id", "place", "sub")
        .mapInArrow(_hashed, "conv_id long, repaired_sha256 string")
    )

    def beside(table: DataFrame, other: DataFrame) -> DataFrame:
        named = other.withColumnRenamed("conv_id", "other_id")
        return table.join(named, F.col("conv_id").eqNullSafe(F.col("other_id")), "left").drop("other_id")

    # A conversation all of whose rows are gone is in neither table.
    further = beside(beside(ids, folded.drop("chosen")), hashes).select(
        "conv_id", *(F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in counts if n != "audit"),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
    return told.unionByName(further)
