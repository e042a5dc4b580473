from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from lakeloom.llm import queries as Q
from lakeloom.llm import structure_repair as R
from lakeloom.session import table
from tests.llm.data import table as rows_of

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
FORM = re.compile("(s?(ua)+)?")


def slow_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def slow_report(conv, rows):
    """Edits by trying all of them from every place of the form on."""
    rows = sorted(rows, key=lambda r: [(x is not None, x or kind) for x, kind in zip(r[1:], (0, "", ""), strict=True)])
    faults, seen = [], set()
    for _, _, role, text in rows:
        bare = (text or "").strip(R.SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    initials = [(r[2] or " ")[0] for r in rows]

    def fits(so_far):
        return any(FORM.fullmatch(so_far + more) for more in ("", "a", "ua"))

    @cache
    def best(i, tail, inserted=0):
        options = [(0, "", ())] if i == len(rows) and FORM.fullmatch("u" + tail if tail == "a" else tail) else []
        for c in "ua":
            grown = {"": c, "s": "s" + c, "u": "u" + c, "a": "ua" + c}[tail]
            if fits(grown) and inserted < 3:
                cost, audit, lines = best(i, c, inserted + 1)
                options.append((cost + 2, "I" + audit, (f"{'user' if c == 'u' else 'assistant'}:", *lines)))
        if i < len(rows):
            fault, more = faults[i], int(faults[i] == "truncated")
            cost, audit, lines = best(i + 1, tail)
            options.append((cost + 3, "D" + audit, lines))
            if fault not in ("blank", "duplicate"):
                for price, letter, c, role in ((0, "K", initials[i], rows[i][2]), (2, "R", "u", "user"), (2, "R", "a", "assistant")):
                    grown = {"": c, "s": "s" + c, "u": "u" + c, "a": "ua" + c}[tail]
                    if c in "sua" and fits(grown):
                        cost, audit, lines = best(i + 1, c)
                        options.append((cost + price + more, letter + audit, (f"{role}:{rows[i][3]}", *lines)))
        return min(options, default=(10 ** 9, "", ()), key=lambda o: o[:2])

    cost, audit, lines = best(0, "")
    turns = [r[1] for r in rows if r[1] is not None]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def slow_reports(original, rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    return sorted((slow_report(c, by.get(c, [])) for c in {r[0] for r in original}), key=str)


def conversations(seed, count=120):
    rng, rows = random.Random(seed), []
    for conv in range(count):
        for k in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "assistant", "user", "system", "tool", "", None, "unicorn"])
            text = rng.choice(["Yes.", "No!", "Why?  \n", "cut off", "", " \t", None, f"text {k}.", f"é {k}", "Yes."])
            rows.append((conv, rng.choice([k, k, k, k + 2, None]), role, text))
    return rows


@pytest.mark.parametrize("hold", [R.HOLD_ROWS, 4])
def test_repair_by_brute_force(spark, hold):
    """With a small hold, longer conversations leave with backpointers and are traced from the end."""
    rows = conversations(hold)
    df = spark.createDataFrame(rows, SCHEMA)
    edits = R.repair(df.repartition(3), hold)
    assert rows_of(R.report(edits), *COLUMNS) == slow_reports(rows, rows)
    assert R.repaired(edits).filter("role IS NULL").count() == 0


def test_texts_beyond_the_hold(spark):
    rows = [(1, k, "ua"[k % 2].replace("u", "user").replace("a", "assistant"), "long " * 500 + f"{k}.") for k in range(40)]
    rows[7] = (1, 7, "user", "long")
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(R.report(R.repair(df, hold_chars=5_000)), *COLUMNS) == slow_reports(rows, rows)


def test_very_long_conversation(spark):
    rows = [(5, k, "user" if k % 3 else "assistant", f"{k % 90}.") for k in range(3_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    held, spilled = (rows_of(R.report(R.repair(df, h)), *COLUMNS) for h in (10_000, 100))
    assert held == spilled and len(held) == 1 and held[0][3] > 2_800


def test_layers_stay_few():
    rng, layers = random.Random(1), set()
    for _ in range(300):
        layer = R.START
        for _ in range(40):
            layer, _, _ = R.step(layer, rng.choice("suax"), rng.choice([None, "blank", "truncated"]))
            layers.add(layer)
    assert len(layers) < 2_000


def test_nulls_and_empty_tables(spark):
    rows = [(None, None, None, None), (None, 3, "user", "a."), (None, 3, "user", "a."), (1, None, "user", "b."), (1, None, "user", "b."), (2, 2 ** 62, "system", "c.")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS pos", "1 AS edit", "2 AS conv", "3 AS fault")
    assert rows_of(R.report(R.repair(df)), *COLUMNS) == slow_reports(rows, rows)
    damaged = slow_damage(rows)
    assert rows_of(R.repair_report(df, R.damage(df)), *COLUMNS) == slow_reports(rows, damaged)
    assert R.repair_report(df.limit(0), R.damage(df.limit(0))).count() == 0
    only = spark.createDataFrame([(3, k, "user", "a.") for k in range(200)], SCHEMA)
    gone = only.filter("pmod(crc32(binary(concat(conv_id, ':', turn))), 20) = 0")
    assert rows_of(R.repair_report(gone, R.damage(gone)), *COLUMNS) == [(3, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_query_by_brute_force(spark, data):
    rows = [tuple(r) for r in table(spark, data, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(Q.QUERIES["op12_structure_repair"](spark, data), *COLUMNS) == slow_reports(rows, slow_damage(rows))
