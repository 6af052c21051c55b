"""Personal data: base spans against Python's regular expressions, patterns that find unseen identifiers, redaction."""
import random
import re
import time

from pyspark.sql import functions as F

from barloom.llm import pii

DDL = "doc_id long, text string"
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(v - 9 * (v > 9) for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits)))) % 10 == 0


def good(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in text.split(".")), "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
            "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def plain(text):
    return sorted((m.start(), p, m.end(), k) for p, (k, r) in enumerate(PATTERNS.items()) for m in re.finditer(r, text or "") if good(k, m[0]))


def spans(spark, rows):
    got = pii.find_personal(spark.createDataFrame(rows, DDL), ["doc_id", "text"]).collect()
    return sorted(((r["doc_id"], r["text"], [tuple(s) for s in r["__spans"]]) for r in got), key=str)


PIECES = ["a@b.co", "x.y+z@mail.example.com", "@", ".", "user", "10.0.0.1", "999.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "378282246310005", "+1 (415) 555-2671",
          "+44 20 7946 0958", "+", "-", " ", "12", "007", "é", "\n", "(", "00000000000000000000000012.1.1.1", "%", "_"]


def test_random_texts(spark):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 20)))) for i in range(700)]
    for _, text, got in spans(spark, rows):
        assert [s for s in got if s[3] != "context"] == plain(text), text


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a@b.co"), (None, "a@b.co"), (3, "9" * 60_000), (4, "1 " * 30_000), (5, "a" * 100_000 + "@x.org"), (6, "a." * 30_000), (7, "x@" + "a." * 30_000 + "b")]
    got = spans(spark, rows)
    assert len(got) == len(rows)
    for _, text, s in got:
        assert s == plain(text)
    assert spans(spark, []) == []


def test_a_pattern_with_many_known_instances_finds_unseen_ones(spark):
    rows = [(i, f"Some words here. Please call phone number +1 415 555 {1000 + i} or else nothing.") for i in range(40)]
    rows += [(100, "Please call phone number 4155550000x or else."), (101, "the total of 123456789 items"), (102, "Please call phone number soon.")]
    got = {i: s for i, _, s in spans(spark, rows)}
    assert [s[3] for s in got[100]] == ["context"] and rows[40][1][got[100][0][0]:got[100][0][2]] == "4155550000x"
    assert got[101] == [] and got[102] == [] and all([s[3] for s in got[i]] == ["phone"] for i in range(40))


def test_copies_of_one_instance_make_no_pattern_sure(spark):
    rows = [(i, "call phone number +1 415 555 1000 now") for i in range(60)] + [(100, "call phone number 12345678 now")]
    assert [s for i, _, s in spans(spark, rows) if i == 100] == [[]]


def contexts(spark, rows):
    return {i: [text[s[0]:s[2]] for s in got if s[3] == "context"] for i, text, got in spans(spark, rows)}


def test_grouped_short_and_at_identifiers(spark):
    rows = [(i, f"Please call phone number +1 415 555 {1000 + i} or else nothing.") for i in range(40)]
    rows += [(50 + i, f"You may write to user{i}@mail.example.com or else nothing.") for i in range(40)]
    rows += [(100, "call phone number DE89 3704 0044 0532 0130 00 now"), (101, "call phone number 123 45 6789 now"), (102, "call phone number 4711 now"),
             (103, "may write to john@localhost now"), (104, "may write to @jane now"), (105, "may write to @ once"), (106, "the total of 123 45 6789 items by @jim"),
             (107, "call phone number 12 34, 56 +1 415 555 9999 7\n8")]
    got = contexts(spark, rows)
    assert got[100] == ["DE89 3704 0044 0532 0130 00"] and got[101] == ["123 45 6789"] and got[102] == ["4711"]
    assert got[103] == ["john@localhost"] and got[104] == ["@jane"] and got[105] == [] and got[106] == [] and got[107] == ["12 34,"]
    assert not any(got[i] for i in range(40))


def test_unknown_values_do_not_speak_against_a_pattern(spark):
    rows = [(i, f"call phone number +1 415 555 {1000 + i} now") for i in range(20)] + [(100 + i, f"call phone number {5550000 + i}x now") for i in range(60)]
    got = contexts(spark, rows)
    assert all(got[100 + i] == [f"{5550000 + i}x"] for i in range(60))


def test_common_numbers_and_chance_cards_speak_against_a_pattern(spark):
    rows = [(i, f"most of the +1 415 555 {1000 + i} now") for i in range(20)] + [(100 + i, f"most of the {1900 + i} now") for i in range(60)]
    rows += [(200 + i, f"word{i} in {1900 + i} now") for i in range(60)] + [(300, "most of the 12345678x now")]
    rows += [(1000 + i, f"this order number {4000000000000000 + 7 * i} now") for i in range(300)]
    assert not any(contexts(spark, rows).values())


def test_a_word_inside_a_run_has_its_own_pattern(spark):
    rows = [(i, f"call office 2 +1 415 555 {1000 + i} now") for i in range(40)] + [(100, "call office 2 4155550000x now")]
    assert contexts(spark, rows)[100] == ["4155550000x"]


def test_redaction_keeps_all_else(spark):
    df = spark.createDataFrame([(1, "mail a@b.co or 10.0.0.1!", "en", 24, 9), (2, "clean", None, 77, None), (3, None, "en", None, 1), (None, "é +1 (415) 555-2671 é", "fr", 21, 2)],
                               DDL + ", lang string, n_chars long, place int")
    got = sorted(map(tuple, pii.without_personal(df).collect()), key=str)
    assert got == sorted([(1, "mail <EMAIL> or <IP>!", "en", 21, 9), (2, "clean", None, 77, None), (3, None, "en", None, 1), (None, "é <PHONE> é", "fr", 11, 2)], key=str)


def test_spans_that_overlap_are_redacted_once(spark):
    df = spark.createDataFrame([("+4111 1111 1111 1111 x",)], "text string")
    spans_ = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(0).alias("place"), F.lit(b).alias("end"), F.lit(k).alias("kind")) for a, b, k in ((0, 20, "phone"), (1, 20, "card"))])
    assert df.select(pii.redacted(F.col("text"), spans_)).first()[0] == "<PHONE> x"


def test_time_follows_the_matches_of_a_text(spark):
    """200,000 addresses in one text: the same spans, and a redacted text, in time in proportion."""
    def of(n):
        text = " ".join(f"u{i}@ex.org" for i in range(n))
        df = spark.createDataFrame([(1, text, len(text))], DDL + ", n_chars long")
        start = time.perf_counter()
        [row] = pii.find_personal(df, ["doc_id"]).select(F.size("__spans").alias("n"), F.element_at("__spans", -1).alias("last")).collect()
        [clean] = pii.without_personal(df).collect()
        assert (row["n"], row["last"]["start"], row["last"]["end"]) == (n, len(text) - len(f"u{n - 1}@ex.org"), len(text))
        assert clean["text"] == " ".join(["<EMAIL>"] * n) and clean["n_chars"] == len(clean["text"])
        return time.perf_counter() - start
    of(100)
    small, large = of(20_000), of(200_000)
    assert large < 25 * max(small, 1.0)


def test_places_across_blocks(spark):
    from barloom.llm import spans
    text = "é" * 1023 + "𝒳b" + "c\n" * 3000
    df = spark.createDataFrame([(text, i, n) for i in (0, 1, 1022, 1023, 1024, 1025, 2047, 7000) for n in (0, 1, 2, 1024, 3000)], "t string, i int, n int")
    got = df.select("i", "n", spans.bound(spans.blocks(F.col("t")), lambda b: spans.cut(b, F.col("i"), F.col("n"))).alias("x")).collect()
    assert all(r["x"] == text[r["i"]:r["i"] + r["n"]] for r in got)
