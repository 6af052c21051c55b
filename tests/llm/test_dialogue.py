"""Repair of conversations against a search over all edits."""
import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from barloom.llm import dialogue

DDL = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    """{conversation: rows (turn, role, text) in order} by the letter of the contract."""
    out = {}
    for conv, turn, role, text in rows:
        talk = out.setdefault(conv, [])
        x = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        row = (turn, "user" if x == 4 else role, "" if x == 1 else re.sub("[.!?]", "", text) if x == 2 else text)
        talk += [] if x == 0 else [row] * (2 if x == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest())
    return {conv: sorted(talk, key=order) for conv, talk in out.items()}


def faults(talk):
    seen, out = set(), []
    for _, role, text in talk:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def search(talk):
    """(cost, audit, lines): least cost, then least audit, by recursion over (row, roles so far)."""
    fault = faults(talk)

    fits = lambda r, last: r == "s" and last == "" or r == "u" and last != "u" or r == "a" and last == "u"

    @lru_cache(None)
    def best(i, last, inserts):  # last: initial of the last repaired role, "" at the start; inserts in a row so far
        options = []

        def option(cost, letter, line, then):
            options.append((cost + then[0], letter + then[1], (line, *then[2]) if line is not None else then[2]))
        if i == len(talk) and last in ("", "a"):
            options.append((0, "", ()))
        for made in ("user", "assistant"):
            if fits(made[0], last) and inserts < 3:
                option(3, "I", f"{made}:", best(i, made[0], inserts + 1))
        if i < len(talk):
            _, role, text = talk[i]
            cut = 3 * (fault[i] == "truncated")
            option(4, "D", None, best(i + 1, last, 0))
            if fault[i] not in ("blank", "duplicate"):
                if fits(role[:1], last):
                    option(cut, "K", f"{role}:{text}", best(i + 1, role[:1], 0))
                for made in ("user", "assistant"):
                    if fits(made[0], last):
                        option(3 + cut, "R", f"{made}:{text}", best(i + 1, made[0], 0))
        return min(options, default=(10**9, "", ()))
    return best(0, "", 0)


def plain(rows):
    out = []
    for conv, talk in damage(rows).items():
        fault = faults(talk)
        turns = [t for t, _, _ in talk if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in talk]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = search(talk)
        out.append((conv, gaps, *(fault.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def compare(spark, rows, parts=4):
    got = dialogue.repaired(dialogue.damaged(spark.createDataFrame(rows, DDL).repartition(parts)))
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def talks(rng, count, longest):
    rows = []
    for conv in range(count):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "umpire"])
            text = rng.choice(["Yes.", "No!", "cut off", "", " \n", "Why? ", f"Text {rng.random()}.", f"open {rng.random()}", "é? "])
            rows.append((conv, None if rng.random() < 0.05 else turn + rng.randint(0, 1) * 2, None if rng.random() < 0.03 else role, None if rng.random() < 0.03 else text))
    return rows


def test_many_short_conversations(spark):
    compare(spark, talks(random.Random(1), 150, 9))


def test_conversations_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(dialogue, "RANGE_BYTES", 400)  # a border every few rows
    compare(spark, talks(random.Random(2), 12, 60))


def test_texts_too_long_to_hold(spark):
    rows = [(1, t, r, ("long text " * 90_000) + str(t % 3) + e) for t, (r, e) in enumerate([("user", "."), ("assistant", ""), ("user", "!")] * 4)]
    compare(spark, rows + [(0, 0, "user", "a."), (2, 0, "assistant", "b.")])


def test_null_ids_empty_tables_and_lost_conversations(spark):
    compare(spark, [(None, 1, "user", "a."), (None, None, "assistant", "b."), (7, None, None, None), (8, 1, "user", "a."), (8, 1, "user", "a."), (8, 1, "assistant", "z.")])
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    compare(spark, [(lost, 0, "user", "a."), (lost + 1, 5, "user", "a.")])
    compare(spark, [])


def test_other_columns_and_text_ids(spark):
    rows = [("x", 0, "user", "a.", 5), ("x", 1, "assistant", "b.", 6), (None, 1, "system", "b", 7)]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string, n int")
    got = dialogue.repaired(dialogue.damaged(df)).collect()
    assert sorted(map(tuple, got), key=str) == plain([r[:4] for r in rows])


def test_one_row_that_repeats_very_often(spark):
    rows = [(1, 1, "user", "again.")] * 3000 + [(1, 2, "assistant", "b.")]
    [got] = dialogue.repaired(dialogue.damaged(spark.createDataFrame(rows, DDL))).collect()
    assert got["audit"].replace("D", "") in ("K", "KK", "KI", "IK") and got["duplicate"] >= 2998


@pytest.mark.parametrize("seed", range(4))
def test_powers_and_choices_against_the_search(seed):
    rng = random.Random(seed)
    for _ in range(60):
        talk = [(t, rng.choice(["system", "user", "assistant", "x"]), rng.choice(["a.", "b", f"{t}.", f"{t}"])) for t in range(rng.randint(0, 12))]
        symbols = [dialogue.MUST_GO if f in ("blank", "duplicate") else 2 * "sua?".index({"x": "?"}.get(r[0], r[0])) + (f == "truncated") for (_, r, _), f in zip(talk, faults(talk))]
        runs = [(s, len(list(g))) for s, g in itertools.groupby(symbols)]
        [(audit, state)] = dialogue.unrolled(runs, dialogue.FINAL, [0])
        cost, want, _ = search(talk)
        assert audit + dialogue.ENDING[state] == want
        assert dialogue.applied(dialogue.run_matrix(runs), dialogue.FINAL)[0] == cost
