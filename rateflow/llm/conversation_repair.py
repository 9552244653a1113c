"""Repair of conversations by Knuth's lightest-derivation search (Knuth, 1977).

A conversation is well formed if the first letters of its roles match ``(s?(ua)+)?``. Its rows are
read in order, and every row is kept (0), given the role ``user`` or ``assistant`` (1), or deleted
(2); an empty row of either role can be inserted anywhere (5). Rows with a fault: those that
are blank or repeat an earlier row must be deleted; those that end without ``.``, ``!`` or ``?`` cost 5
unless they are deleted.

Items are (rows read, state), a state being what the roles so far allow next. Their deductions extend an
item by one edit, and an item's weight is (cost, audit), the audit being the edits' letters in order: D, I,
K, R. A deduction adds to the cost and appends to the audit, so it never gives less than it is
given and keeps the order of weights (of two audits of equal cost for one item, neither begins with the other: all
letters but I match rows, and an I costs 5). So items popped in the order of weight from an agenda
are final, and the first complete item popped is the cheapest repair with the least audit.

Long conversations are cut into runs of ``FAN`` rows. A run's lightest derivations from every
state to every state are one compound step, and runs of steps are again put together, until one
agenda is left. So no agenda holds more than 4 * (``FAN`` + 1) items.

On Spark, rows are sorted by range of (conversation, turn), so a conversation of any length is spread
over many tasks. Conversations inside one range are repaired in that task, as a stream. The
others (the first and last of a range, and those with more than ``HELD`` rows) go on as rows:
repeated rows are found by a minimum per role and text, each range gives its
compound step, and steps (not texts) meet per conversation.

Defined cases: a null role or text is one space; rows of one turn are taken by role, then by the MD5 of
the text, null turns first; a role without a letter fits nowhere and is given another role or deleted;
null conversation ids are one conversation; an empty table gives empty results; extra columns are not carried.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.llm.common import written

FAN = 128
#: Rows of one conversation that a task holds at once, and conversations a batch.
HELD, BATCH = 20_000, 1000

SPACE = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
COMPLETE = (START, ASSISTANT)
#: Where a role's first letter leads, and the letter that goes on from each state by ``user`` or ``assistant``.
LEADS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
GOES_ON = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ROLE = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, UNENDED = 0, 1, 2, 5, 5
#: Faults, the first of which counts.
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)

Weight = tuple[int, str]
Step = dict[int, dict[int, Weight]]  # from state, to state


def fault(text: str, again: bool) -> int:
    ended = text.rstrip(SPACE)
    return BLANK if not ended else DUPLICATE if again else TRUNCATED if ended[-1] not in ".!?" else NONE


def row_step(role: str, fault: int) -> Step:
    """The deductions that read one row."""
    out: Step = {q: {q: (DELETE, "D")} for q in GOES_ON}
    if fault not in (BLANK, DUPLICATE):
        extra = UNENDED if fault == TRUNCATED else 0
        for q, letter in GOES_ON.items():
            out[q][LEADS[q, letter]] = (REROLE + extra, "R")
            if (to := LEADS.get((q, role[:1]))) is not None:
                out[q][to] = (KEEP + extra, "K")
    return out


def derive(steps: list[Step], start: int, inserts: bool, goals: tuple[int, ...] = ()) -> dict[int, Weight]:
    """Lightest weights of the states after all ``steps`` from ``start``; of the first of
    ``goals`` that is final, if there are any."""
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    final: set[tuple[int, int]] = set()
    out: dict[int, Weight] = {}
    while agenda and len(out) < len(GOES_ON):
        cost, audit, at, state = heapq.heappop(agenda)
        if (at, state) in final:
            continue
        final.add((at, state))
        if at == len(steps):
            if state in goals:
                return {state: (cost, audit)}
            out[state] = (cost, audit)
        else:
            for to, (more, letters) in steps[at][state].items():
                if (at + 1, to) not in final:
                    heapq.heappush(agenda, (cost + more, audit + letters, at + 1, to))
        if inserts and (at, to := LEADS[state, GOES_ON[state]]) not in final:
            heapq.heappush(agenda, (cost + INSERT, audit + "I", at, to))
    return out


def compound(steps: list[Step], inserts: bool, upto: int) -> tuple[list[Step], bool]:
    """``steps`` put together, run by run, until at most ``upto`` are left."""
    while len(steps) > upto:
        steps = [{q: derive(steps[i:i + FAN], q, inserts) for q in GOES_ON} for i in range(0, len(steps), FAN)]
        inserts = False  # they are within the compound steps
    return steps, inserts


def lightest(steps: list[Step], inserts: bool = True) -> Weight:
    """Cost and audit of the cheapest repair (with the least audit)."""
    steps, inserts = compound(steps, inserts, FAN)
    return next(iter(derive(steps, START, inserts, COMPLETE).values()))


def repaired(rows: list[tuple[str, str]], audit: str, state: int = START) -> Iterator[tuple[str, str, str]]:
    """Edit, role and text of each turn that ``audit`` leaves of ``rows`` (role, text)."""
    left = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(left)
        if edit != "D":
            letter = role[:1] if edit == "K" else GOES_ON[state]
            state = LEADS[state, letter]
            yield edit, role if edit == "K" else ROLE[letter], text


TURNS = "array<struct<edit: string, role: string, text: string>>"
_TURNS = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
# a conversation (turns and all after it), or a row of one that goes on (n, its place in the range)
_FIRST = pa.schema([
    ("conv_id", pa.int64()), ("seg", pa.int32()), ("n", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("digest", pa.string()),
    ("turns", _TURNS), *[(c, pa.int64()) for c in (*COUNTS, "cost")], ("audit", pa.string())])
_FIRST_DDL = (f"conv_id long, seg int, n long, turn long, role string, text string, digest string, turns {TURNS}, "
              + ", ".join(f"{c} long" for c in (*COUNTS, "cost")) + ", audit string")


def _legal(a: str, b: str) -> bool:
    return a[:1] + b[:1] in ("su", "ua", "au")


def _whole(rows: list[dict]) -> dict:
    """Result of a conversation all of whose rows (in order) are at hand."""
    seen: set[tuple[str, str]] = set()
    steps, counts = [], [0, 0, 0, 0]
    for r in rows:
        f = fault(r["text"], (r["role"], r["digest"]) in seen)
        seen.add((r["role"], r["digest"]))
        counts[f] += 1
        steps.append(row_step(r["role"], f))
    cost, audit = lightest(steps)
    turns = {r["turn"] for r in rows} - {None}
    return {
        "conv_id": rows[0]["conv_id"], "seg": rows[0]["seg"], "cost": cost, "audit": audit,
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, "blank": counts[BLANK], "duplicate": counts[DUPLICATE],
        "truncated": counts[TRUNCATED], "illegal": sum(not _legal(a["role"], b["role"]) for a, b in zip(rows, rows[1:], strict=False)),
        "turns": [{"edit": e, "role": r, "text": t} for e, r, t in repaired([(r["role"], r["text"]) for r in rows], audit)]}


def _range(batches):
    """One sorted range: conversations inside it are repaired; the rows of others go on."""
    out: list[dict] = []
    held: list[dict] = []
    conv, n, goes_on = None, 0, True  # the first conversation may have begun in an earlier range
    for batch in batches:
        for row in batch.to_pylist():
            row["n"], n = n, n + 1
            if row["n"] and row["conv_id"] != conv:
                if held:
                    out.append(_whole(held))
                held, goes_on = [], False
            conv = row["conv_id"]
            if goes_on:
                out.append(row)
            else:
                held.append(row)
                if len(held) > HELD:
                    out, held, goes_on = out + held, [], True
            if len(out) >= BATCH:
                yield pa.RecordBatch.from_pylist(out, _FIRST)
                out = []
    if out or held:
        yield pa.RecordBatch.from_pylist(out + held, _FIRST)


def _piece(rows: pa.Table) -> pa.Table:
    """Counts, both ends and the compound step of one range's rows of a conversation."""
    found = rows.sort_by("n").to_pylist()
    steps, inserts = [row_step(r["role"], r["fault"]) for r in found], True
    (step,), _ = compound(steps, inserts, 1) if len(steps) > 1 else ([{q: derive(steps, q, True) for q in GOES_ON}], False)
    turns = [r["turn"] for r in found if r["turn"] is not None]
    return pa.Table.from_pylist([{
        "conv_id": found[0]["conv_id"], "seg": found[0]["seg"], "rows": len(found), "n_turns": len(set(turns)),
        "low": min(turns, default=None), "high": max(turns, default=None), "first_role": found[0]["role"], "last_role": found[-1]["role"],
        **{name: sum(r["fault"] == f for r in found) for name, f in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))},
        "illegal": sum(not _legal(a["role"], b["role"]) for a, b in zip(found, found[1:], strict=False)),
        "steps": [{"from": q, "to": t, "cost": c, "audit": a} for q, ends in step.items() for t, (c, a) in ends.items()]}], _PIECE)


_STEPS = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_PIECE = pa.schema([
    ("conv_id", pa.int64()), ("seg", pa.int32()), *[(c, pa.int64()) for c in ("rows", "n_turns", "low", "high")], ("first_role", pa.string()), ("last_role", pa.string()),
    *[(c, pa.int64()) for c in COUNTS[1:]], ("steps", _STEPS)])
_PIECE_DDL = ("conv_id long, seg int, rows long, n_turns long, low long, high long, first_role string, last_role string, blank long, duplicate long, truncated long, "
              "illegal long, steps array<struct<from: int, to: int, cost: long, audit: string>>")
_JOINED = pa.schema([("conv_id", pa.int64()), ("seg", pa.int32()), ("state", pa.int32()), ("edits", pa.string()), *[(c, pa.int64()) for c in (*COUNTS, "cost")], ("audit", pa.string())])
_JOINED_DDL = "conv_id long, seg int, state int, edits string, " + ", ".join(f"{c} long" for c in (*COUNTS, "cost")) + ", audit string"


def _joined(rows: pa.Table) -> pa.Table:
    """The repair of a conversation from its ranges' steps: a row per range with its state at the start and
    its edits; the first range's has the conversation's counts, cost and audit."""
    pieces = rows.sort_by("seg").to_pylist()
    steps: list[Step] = []
    for p in pieces:
        steps.append({q: {} for q in GOES_ON})
        for s in p["steps"]:
            steps[-1][s["from"]][s["to"]] = (s["cost"], s["audit"])
    cost, audit = lightest(steps, inserts=False)
    pairs = list(zip(pieces, pieces[1:], strict=False))
    known = [p for p in pieces if p["low"] is not None]
    shared = sum(a["high"] == b["low"] for a, b in zip(known, known[1:], strict=False))  # a turn in two ranges
    gaps = known[-1]["high"] - known[0]["low"] + 1 - (sum(p["n_turns"] for p in known) - shared) if known else 0
    illegal = sum(p["illegal"] for p in pieces) + sum(not _legal(a["last_role"], b["first_role"]) for a, b in pairs)
    # the turns left begin with a system turn if they are odd in number, and alternate after it
    left = len(audit) - audit.count("D")
    states = [START, SYSTEM, USER, ASSISTANT] if left % 2 else [START, USER, ASSISTANT]
    out, at, gone_on = [], 0, 0
    for i, p in enumerate(pieces):
        begin, read = at, 0
        # what is inserted behind a range's last row is left to the next one
        while at < len(audit) and (read < p["rows"] or i == len(pieces) - 1):
            read += audit[at] != "I"
            at += 1
        state = states[gone_on] if gone_on < len(states) else states[-2:][(gone_on - len(states)) % 2]
        out.append({"conv_id": p["conv_id"], "seg": p["seg"], "state": state, "edits": audit[begin:at]})
        gone_on += at - begin - audit.count("D", begin, at)
    out[0] |= {"gaps": gaps, "illegal": illegal, "cost": cost, "audit": audit, **{c: sum(p[c] for p in pieces) for c in COUNTS[1:4]}}
    return pa.Table.from_pylist(out, _JOINED)


def _mended(rows: pa.Table, edits: pa.Table) -> pa.Table:
    """The turns that a range's edits leave of its rows."""
    found, (how,) = rows.sort_by("n").to_pylist(), edits.to_pylist()
    turns = [{"edit": e, "role": r, "text": t} for e, r, t in repaired([(r["role"], r["text"]) for r in found], how["edits"], how["state"])]
    return pa.Table.from_pylist([{"conv_id": how["conv_id"], "seg": how["seg"], "turns": turns}], pa.schema([_FIRST.field(c) for c in ("conv_id", "seg", "turns")]))


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The report, a row per conversation: ``conv_id``, ``gaps`` (numbers missing between its least
    and greatest turn), ``blank``, ``duplicate``, ``truncated`` (rows by their first fault), ``illegal`` (neighbours
    whose roles do not follow one another), ``cost`` and ``audit``.

    And the repaired conversations: ``conv_id``, ``part`` (in their order), ``whole`` (whether it is
    the only part) and ``turns`` (edit, role, text) in order."""
    spark = conversations.sparkSession
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = conversations.select(*[F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")], *text).withColumns(
        # the number spreads equal rows, of which any order is the same
        {"digest": F.md5("text"), "_row": F.monotonically_increasing_id()})
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "digest", "_row"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumn("seg", F.spark_partition_id())
    first = written(sorted_.select("conv_id", "seg", "turn", "role", "text", "digest").mapInArrow(_range, _FIRST_DDL), "repaired")
    done, open_ = first.filter("audit is not null"), first.filter("audit is null")

    # the first row of each role and text is no repetition
    earliest = open_.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("seg", "n")).alias("at")).select(
        F.col("at.seg").alias("seg"), F.col("at.n").alias("n"), F.lit(True).alias("earliest"))
    # all that a fault needs of a text: its last character that is no space
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACE)), -1, 1)
    kind = F.when(F.col("last") == "", BLANK).when(F.col("earliest").isNull(), DUPLICATE).when(
        ~F.col("last").isin(".", "!", "?"), TRUNCATED).otherwise(NONE)
    faults = open_.select("seg", "n", "conv_id", "turn", "role", last.alias("last")).join(earliest, ["seg", "n"], "left").select("conv_id", "seg", "n", "turn", "role", kind.alias("fault"))
    pieces = faults.groupBy("conv_id", "seg").applyInArrow(_piece, _PIECE_DDL)
    joined = written(pieces.groupBy("conv_id").applyInArrow(_joined, _JOINED_DDL), "joined")

    report = done.select("conv_id", *COUNTS, "cost", "audit").union(
        joined.filter("audit is not null").select("conv_id", *COUNTS, "cost", "audit"))
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key")
    mended = (
        open_.select(key, "conv_id", "seg", "n", "role", "text").groupBy("key", "seg")
        .cogroup(joined.select(key, "conv_id", "seg", "state", "edits").groupBy("key", "seg"))
        .applyInArrow(_mended, f"conv_id long, seg int, turns {TURNS}"))
    return report, done.select("conv_id", F.col("seg").alias("part"), F.lit(True).alias("whole"), "turns").union(
        mended.select("conv_id", "seg", F.lit(False), "turns"))


def line_hashes(turns: DataFrame) -> DataFrame:
    """``conv_id`` and the SHA-256 (hex) of each repaired conversation's lines ``role:text``. A hash of one
    text runs from its start to its end, so a conversation of several parts is one task's
    work, as a stream of its parts: a part is all that is held."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    of = turns.select("conv_id", "part", "whole", F.when(F.size("turns") > 0, lines).alias("lines"))

    def run(batches):
        conv, digest, some, begun = None, hashlib.sha256(), False, False
        for batch in batches:
            out: list[tuple[int | None, str]] = []
            for row in batch.to_pylist():
                if begun and row["conv_id"] != conv:
                    out.append((conv, digest.hexdigest()))
                    digest, some = hashlib.sha256(), False
                conv, begun = row["conv_id"], True
                if row["lines"] is not None:
                    digest.update((b"\n" if some else b"") + row["lines"].encode())
                    some = True
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([h for _, h in out], pa.string())], names=["conv_id", "sha256"])
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([digest.hexdigest()])], names=["conv_id", "sha256"])

    # a given count: conversations of many parts are not merged into one task
    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = of.filter(~F.col("whole")).select("conv_id", "part", "lines").repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "part")
    return of.filter("whole").select("conv_id", F.sha2(F.coalesce("lines", F.lit("")), 256).alias("sha256")).union(
        parts.mapInArrow(run, "conv_id long, sha256 string"))
