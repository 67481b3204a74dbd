"""Conversation repair against a search over (cost, edits) in plain Python."""

import hashlib
import heapq
import itertools
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents
from tripmill.llm import conversations

SPACE = " \t\n\x0b\x0c\r"
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(kinds):
    """Least (cost, edits) of turns (initial, has to go, truncated)."""
    heap, seen = [(0, "", 0, 0)], set()
    while True:
        cost, edits, i, place = heapq.heappop(heap)
        if i == len(kinds) and place in (0, 3):
            return cost, edits
        if (i, place) in seen:
            continue
        seen.add((i, place))
        after = [NEXT[place, r] for r in "ua" if (place, r) in NEXT]
        for p in after:
            heapq.heappush(heap, (cost + 5, edits + "I", i, p))
        if i == len(kinds):
            continue
        initial, gone, cut = kinds[i]
        heapq.heappush(heap, (cost + 2, edits + "D", i + 1, place))
        if not gone:
            if (place, initial) in NEXT:
                heapq.heappush(heap, (cost + 5 * cut, edits + "K", i + 1, NEXT[place, initial]))
            for p in after:
                heapq.heappush(heap, (cost + 5 * cut + 1, edits + "R", i + 1, p))


def repaired(rows, audit):
    out, rows, place = [], iter(rows), 0
    for edit in audit:
        needed = "assistant" if place == 2 else "user"
        role, text = (needed, "") if edit == "I" else next(rows)[1:]
        if edit == "D":
            continue
        role = needed if edit == "R" else role
        place = NEXT[place, role[0]]
        out.append((role, text))
    return out


def judged(rows):
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, seen, kinds = [0, 0, 0], set(), []
    for _, role, text in rows:
        core = text.strip(SPACE)
        fault = 0 if not core else 1 if (role, text) in seen else 2 if core[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            faults[fault] += 1
        kinds.append((role[:1], fault in (0, 1), fault == 2))
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = cheapest(kinds)
    text = "\n".join(f"{r}:{x}" for r, x in repaired(rows, audit))
    return (gaps, *faults, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def of(rows) -> dict:
    groups = defaultdict(list)
    for conv, *row in rows:
        groups[conv].append(tuple(row))
    return {conv: judged(some) for conv, some in groups.items()}


def check(df, **options):
    got = {r[0]: tuple(r)[1:] for r in conversations.report(df, **options).collect()}
    assert got == of([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    return got


def after_damage(rows):
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        what = zlib.crc32(key.encode()) % 20
        if what == 1:
            text = ""
        if what == 2:
            text = re.sub("[.!?]", "", text)
        if what == 4:
            role = "user"
        yield from [] if what == 0 else [(conv, turn, role, text)] * (2 if what == 3 else 1)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table_after_damage(spark, sf):
    df = documents(spark, sf, "conversations")
    rows = [tuple(r) for r in df.collect()]
    turns, lost = conversations.damaged(df)
    got = {r[0]: tuple(r)[1:] for r in conversations.report(turns, gone=lost).collect()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {**dict.fromkeys((r[0] for r in rows), nothing), **of(after_damage(rows))}


def test_all_short_patterns(spark):
    """Every sequence of up to four turns of ten kinds, by brute force."""
    kinds = [(r, t) for r in ("system", "user", "assistant", "tool") for t in ("fine.", "cut")] + [("user", " "), ("assistant", "")]
    every = [p for n in range(1, 4) for p in itertools.product(kinds, repeat=n)] + list(itertools.product(kinds[2:7], repeat=4))
    rows = [(c, i, r, t and t.replace("i", f"i{i}").replace("u", f"u{i}")) for c, p in enumerate(every) for i, (r, t) in enumerate(p)]
    check(spark.createDataFrame(rows, SCHEMA))


def test_nulls_ties_repeats_and_empty_texts(spark):
    rows = [
        (None, 0, "user", "Who?"), (None, 1, "assistant", "Me."), (None, 1, "assistant", "Me."), (None, None, "user", "Me."),
        (1, None, "user", "A."), (1, None, "assistant", "B."), (1, None, None, None), (1, 3, "user", "A."), (1, 3, "user", "A."),
        (2, None, None, None), (2, None, "user", None), (3, 5, "", ""), (4, 2, "user", "Same."), (4, 2, "user", "Same."),
        (4, 2, "user", "Same."), (4, 9, "user", "Same."), (5, -3, "assistant", "Só\x00 é.\x0b "), (5, 8, "User", "x!"), (6, 1, "system", "s."),
        (7, 2**62, "user", "far."), (7, -(2**62), "user", "near."),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = check(df.repartition(4))
    assert got[4][2] == 3 and got[7][0] == 2**63 - 1
    clash = df.withColumns({c: F.lit("x") for c in ("conv", "key", "h1", "h2", "first", "later", "gone", "again", "at", "place", "edit")})
    assert check(clash) == got


def test_spilling_changes_nothing(spark):
    rows = [(c, i, ("user", "assistant", "system")[(i * 7 + c) % 3], f"t{i % 50}" + ".!,"[(i * i) % 3]) for c in range(3) for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = {tuple(r) for r in conversations.report(df).collect()}
    assert {tuple(r) for r in conversations.report(df, spill_turns=7, spill_bytes=100).collect()} == plain
    assert {r[0]: r[1:] for r in plain} == of(rows)


def test_state_goes_on_over_arrow_batches(spark):
    rows = [(1, i, ("user", "assistant")[i % 2 if i % 11 else 0], f"turn {i}" + ("." if i % 5 else "")) for i in range(500)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        check(spark.createDataFrame(rows, SCHEMA))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_edits_are_the_repaired_turns(spark):
    df = documents(spark, "sf0.001", "conversations")
    turns, lost = conversations.damaged(df)
    reports = {r.conv_id: r for r in conversations.report(turns, gone=lost).collect()}
    found = defaultdict(list)
    for r in conversations.edits(turns, gone=lost).collect():
        found[r.conv_id].append(r)
    for conv, report in reports.items():
        rows = sorted(found.get(conv, []), key=lambda r: r.place)
        assert "".join(r.edit for r in rows) == report.audit
        kept = [r for r in rows if r.edit != "D"]
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in kept))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in kept).encode()).hexdigest() == report.repaired_sha256


def test_very_long_text_and_no_rows(spark):
    check(spark.createDataFrame([(1, 0, "user", "word " * 400_000 + "\n" * 1000), (1, 1, "assistant", "x" * 1_000_000 + ".")], SCHEMA))
    assert conversations.report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert conversations.edits(spark.createDataFrame([], SCHEMA)).collect() == []
