"""Fingerprints: the next document and the edited text against a plain loop, likeness, and odd rows."""
import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import fingerprint as fp

DDL = "doc_id long, text string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(rng.randint(1, 9))) for _ in range(n))


def plain(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        h = len(t) // 2
        e = t[:len(t) - h] + after[:h]
        a, b, c = fp.fingerprint(t), fp.fingerprint(e), fp.fingerprint(after)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), a, b, fp.likeness(a, b), fp.likeness(a, c)))
    return sorted(out, key=str)


def compare(spark, rows, **sizes):
    got = fp.compared(spark.createDataFrame(rows, DDL).repartition(4), **sizes).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)


def test_every_range_hands_over_to_the_next(spark):
    rng = random.Random(1)
    rows = [(rng.randint(-10**12, 10**12), prose(rng, rng.randint(0, 80))) for _ in range(300)]
    for ranges in (1, 3, 40):
        compare(spark, rows, ranges=ranges)


def test_odd_rows(spark):
    rng = random.Random(2)
    compare(spark, [(5, "alone")])
    compare(spark, [(1, None), (2, ""), (3, "x"), (4, prose(rng, 30_000)), (9, "ends")])
    compare(spark, [(None, "b"), (None, "a"), (7, "same"), (7, "same"), (7, "other"), (8, "last")], ranges=3)
    assert fp.compared(spark.createDataFrame([], DDL)).count() == 0
    df = spark.createDataFrame([(1, "a", 3, "x")], DDL + ", range int, last string")
    assert fp.compared(df).count() == 1


def test_half_a_text_is_half_alike_and_strangers_are_not():
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(60, 900)) for _ in range(60)]
    for a, b in zip(texts, texts[1:]):
        h = len(a) // 2
        assert 0.25 < fp.likeness(fp.fingerprint(a), fp.fingerprint(a[:len(a) - h] + b[:h])) < 0.9
        assert fp.likeness(fp.fingerprint(a), fp.fingerprint(b)) < 0.2
        word = a.split(" ")
        word[len(word) // 2] = "changed"
        assert fp.likeness(fp.fingerprint(a), fp.fingerprint(" ".join(word))) > 0.85


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before if x == y else 1 + min(row[j], row[j - 1])
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abcd", max_size=90), st.text("abcd", max_size=90))
def test_the_letters_edit_distance(a, b):
    x, y = fp._short_runs(a), fp._short_runs(b)
    got = fp._alike(a, b)
    run = min(fp.COMMON, max(1, min(len(x), len(y)) // 3))
    if not x or not y or not any(x[i:i + run] in y for i in range(len(x) - run + 1)):
        assert got == 0
    else:
        assert abs(got - (1 - edit_distance(x, y) / (len(x) + len(y)))) < 1e-12


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=400))
def test_equal_texts_have_equal_fingerprints(text):
    assert fp.fingerprint(text) == fp.fingerprint("".join(list(text)))
    assert fp.likeness(fp.fingerprint(text), fp.fingerprint(text)) == 1.0
