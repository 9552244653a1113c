"""Conversation repair against a plain search from the end."""

import hashlib
import random
import zlib
from functools import cache

import duckdb
import pytest

import rateflow.llm.conversation_repair as R
from rateflow.llm.queries import op12_conversation_repair

SF = "/root/testdata/sf0.01"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """(cost, audit) of (initial, fault) rows: the best way on from each place, by definition."""

    @cache
    def best(i, last, inserts=0):
        ways = []
        if inserts < 3:
            c, a = best(i, NEXT[last], inserts + 1)
            ways.append((c + 5, "I" + a))
        if i == len(rows):
            if last in ("", "a"):
                ways.append((0, ""))
        else:
            letter, fault = rows[i]
            c, a = best(i + 1, last)
            ways.append((c + 2, "D" + a))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                for to, cost, edit in [(letter, 0, "K"), ("u", 1, "R"), ("a", 1, "R")]:
                    if to == NEXT[last] or (to, last) == ("s", ""):
                        c, a = best(i + 1, to)
                        ways.append((c + cost + extra, edit + a))
        return min(ways, default=(10**9, ""))

    for i in range(len(rows), -1, -1):  # short recursions
        for last in NEXT:
            best(i, last)
    return best(0, "")


def expected(rows):
    """The query's row for a conversation's damaged rows (turn, role, text), in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        solid = [c for c in text if c not in " \t\n\x0b\x0c\r"]
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    cost, audit = cheapest([(role[:1], f) for (_, role, _), f in zip(rows, faults, strict=True)])
    out, left, last = [], iter(rows), ""
    odd = (len(audit) - audit.count("D")) % 2
    for e in audit:
        _, role, text = (None, "", "") if e == "I" else next(left)
        if e == "D":
            continue
        last = "s" if odd and not last else NEXT[last]
        out.append((role if e == "K" else {"u": "user", "a": "assistant"}[last]) + ":" + text)
    turns = [t for t, _, _ in rows if t is not None]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False)),
            cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def damage(conv, turn, role, text):
    role, text = (" " if x is None else x for x in (role, text))
    lot = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
    if lot == 2:
        text = "".join(c for c in text if c not in ".!?")
    row = (turn, "user" if lot == 4 else role, "" if lot == 1 else text)
    return [row] * (0 if lot == 0 else 2 if lot == 3 else 1)


def want(rows):
    convs = {r[0]: [] for r in rows}
    for r in rows:
        convs[r[0]] += damage(*r)
    return {c: expected(sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))) for c, x in convs.items()}


def got(df):
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in columns) for r in rows}


def test_repair_of_the_table(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    assert got(op12_conversation_repair(spark, SF)) == want(rows)


@pytest.mark.parametrize("tasks", ["1", "7"])
def test_repair_of_odd_conversations(spark, tmp, tasks):
    rng = random.Random(4)
    texts = ["Yes.", "No!", "and so on", " ", "", None, "Well?\n", "Long. " * 3000]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "assistant", "user", None, "", "tool", "u"]), rng.choice(texts))
            for c in (1, 2, 3, None, 5) for t in [*range(rng.randrange(14)), None, 3]]
    # one conversation holds most rows, all of one turn's in one place, and repeats its texts
    rows += [(9, t // 3, ("user", "assistant")[t % 2], f"Text {rng.randrange(200)}" + rng.choice(".x")) for t in range(700)]
    rows += [(10, None, "user", "Same.")] * 40 + [(11, 0, "user", "Gone."), (11, 0, "user", "Gone.")]
    path = f"{tmp}/odd"
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "role AS seg", "1 AS n").write.parquet(f"{path}/conversations.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        assert got(op12_conversation_repair(spark, path)) == want(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_repair_of_nothing(spark, tmp):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp}/none/conversations.parquet")
    assert op12_conversation_repair(spark, f"{tmp}/none").collect() == []


def test_compound_steps_change_nothing(monkeypatch):
    rng = random.Random(5)
    for _ in range(300):
        rows = [(rng.choice("suaut "), rng.choice(["", "", "blank", "duplicate", "truncated"])) for _ in range(rng.randrange(1, 24))]
        steps = [R.row_step(a, ["", "blank", "duplicate", "truncated"].index(f)) for a, f in rows]
        monkeypatch.setattr(R, "FAN", rng.choice([2, 3, 128]))
        assert R.lightest(steps) == cheapest(rows)
