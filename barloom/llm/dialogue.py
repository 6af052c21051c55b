"""Repair of damaged conversations by the cheapest edits, found by a dynamic programme over runs of equal rows.

A row matters to the programme only by its symbol: the initial of its role and whether it is truncated or has to go. Each
symbol is a 4 x 4 min-plus matrix between the states of the wanted pattern (nothing yet, system, user, assistant), inserts
before the row included. Equal neighbours are one run; a run of n rows is passed by the symbol's cached powers of two, so
costs at all run boundaries take about log n small products a run. Choices are then unrolled run by run from these costs.

Rows are laid out in ranges of (conversation, turn, role, text digest), so a conversation of any size lies in as many ranges
as it fills. Those within a range are finished there. Of one that crosses a border each range hands on one matrix, learns
the cost vector behind it, unrolls its part for each of the four states it may be entered in, and a last pass picks
the parts that fit and streams the texts to the digest, which is serial by nature but holds no texts.
"""
from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import dropped, query, staged, table

SPACES = " \t\n\x0b\x0c\r"
#: States of the pattern (s?(ua)+)?, and where each role's initial leads; user and assistant are what edits can make.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ENTER = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "?": {}}
MADE = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
#: Cost of the inserts that end a conversation in each state, and these inserts.
FINAL, ENDING = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")
#: Symbol of a row that has to be deleted; the others are 2 * place of the initial in ROLES + truncated.
ROLES, MUST_GO = "sua?", 8
INF = 1 << 60
#: Bytes of texts that a conversation may hold in a task; a longer one takes the way of those that cross borders.
HELD_BYTES = 8 << 20
#: Bytes of texts in a range.
RANGE_BYTES = 64 << 20

Vector = tuple[int, int, int, int]


def _actions(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what can be done with a row of the symbol, letters ascending."""
    out = [("D", DELETE, state)]
    if symbol != MUST_GO:
        cut = CUT * (symbol % 2)
        if (to := ENTER[ROLES[symbol // 2]].get(state)) is not None:
            out.append(("K", cut, to))
        out.append(("R", REROLE + cut, MADE[state]))
    return out


@lru_cache(None)
def power(symbol: int, exponent: int) -> tuple[Vector, ...]:
    """The min-plus matrix of 2^exponent rows of the symbol: least cost from state to state, inserts before rows included."""
    if exponent:
        half = power(symbol, exponent - 1)
        return product(half, half)
    out = []
    for start in range(4):
        best, state, paid = [INF] * 4, start, 0
        for _ in range(3):
            for _, cost, to in _actions(symbol, state):
                best[to] = min(best[to], paid + cost)
            state, paid = MADE[state], paid + INSERT
        out.append(tuple(best))
    return tuple(out)


def product(a, b):
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def applied(matrix, behind: Vector) -> Vector:
    return tuple(min(m + c for m, c in zip(row, behind)) for row in matrix)


IDENTITY = tuple(tuple(0 if i == j else INF for j in range(4)) for i in range(4))


def before_run(symbol: int, n: int, behind: Vector) -> Vector:
    """Costs to go before a run, from those behind it."""
    exponent = 0
    while n:
        if n & 1:
            behind = applied(power(symbol, exponent), behind)
        n, exponent = n >> 1, exponent + 1
    return behind


def run_matrix(runs) -> tuple[Vector, ...]:
    out = IDENTITY
    for symbol, n in runs:
        exponent = 0
        while n:
            if n & 1:
                out = product(out, power(symbol, exponent))
            n, exponent = n >> 1, exponent + 1
    return out


@lru_cache(1 << 16)
def _choices(symbol: int, behind: Vector):
    """For each state before a row: letters (inserts and the row's own) and the state behind it, least cost, then ASCII-least.

    `behind` may lack a constant; also given: the vector before the row.
    """
    costs = applied(power(symbol, 0), behind)
    out = []
    for state in range(4):
        letters = ""
        while True:
            options = [("I", INSERT + costs[MADE[state]], None)] + [(a, cost + behind[to], to) for a, cost, to in _actions(symbol, state)]
            letter, _, to = min(o for o in options if o[1] == costs[state])
            letters += letter
            if to is not None:
                break
            state = MADE[state]
        out.append((letters, to))
    return costs, tuple(out)


def _levelled(v: Vector) -> Vector:
    low = min(v)
    return tuple(c - low for c in v)


def unrolled(runs, behind: Vector, entries) -> list[tuple[str, int]]:
    """(letters, state behind) of the runs for each entry state, given the costs to go behind them."""
    ends = [behind]
    for symbol, n in reversed(runs):
        ends.append(before_run(symbol, n, ends[-1]))
    ends.reverse()
    states, pieces = list(entries), [[] for _ in entries]
    for (symbol, n), end in zip(runs, ends[1:]):
        vector, rows = _levelled(end), []
        for _ in range(n):
            vector, choice = _choices(symbol, vector)
            vector = _levelled(vector)
            rows.append(choice)
        for choice in reversed(rows):
            for i, state in enumerate(states):
                letters, states[i] = choice[state]
                pieces[i].append(letters)
    return [("".join(p), s) for p, s in zip(pieces, states)]


class Writer:
    """Follows an audit over rows given one by one; keeps only a running SHA-256 of the repaired lines."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.lines, self.digest = audit, 0, EMPTY, 0, hashlib.sha256()

    def _line(self, line: str):
        self.digest.update(("\n" + line if self.lines else line).encode("utf-8", "surrogatepass"))
        self.lines += 1

    def _made(self, text: str):
        self.state = MADE[self.state]
        self._line(f"{NAMES[self.state]}:{text}")

    def inserts(self):
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self._made("")

    def row(self, role: str, text: str):
        self.inserts()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter == "K":
            self.state = ENTER[role[0]][self.state]
            self._line(f"{role}:{text}")
        elif letter == "R":
            self._made(text)

    def end(self) -> str:
        self.inserts()
        return self.digest.hexdigest()


class _Part:
    """What a range knows of a conversation's rows, taken in order; parts of neighbouring ranges can be joined."""
    FIELDS = ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "initial", "last")

    def __init__(self, **known):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.initial = self.last = None
        self.__dict__.update(known)

    def take(self, turn, initial, fault, n):
        if fault == 1:
            self.blank += n
        else:
            self.duplicate += n - (fault != 2)
            self.truncated += fault == 3
        self.join(_Part(illegal=n - 1, turns=int(turn is not None), low=turn, high=turn, initial=initial, last=initial))

    def join(self, later: _Part):
        for field in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, field, getattr(self, field) + getattr(later, field))
        self.turns += later.turns - (self.high is not None and self.high == later.low)
        self.low = later.low if self.low is None else self.low
        self.high = self.high if later.high is None else later.high
        if self.last is not None and later.initial is not None:
            self.illegal += self.last + later.initial not in ("su", "ua", "au")
        self.initial = later.initial if self.initial is None else self.initial
        self.last = self.last if later.last is None else later.last

    def gaps(self):
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _result(conv, part: _Part, cost: int, writer: Writer) -> dict:
    return {"conv": conv, "gaps": part.gaps(), "blank": part.blank, "duplicate": part.duplicate, "truncated": part.truncated,
            "illegal": part.illegal, "cost": cost, "audit": writer.audit, "repaired_sha256": writer.end()}


def damaged(rows: DataFrame) -> DataFrame:
    """rows(conv_id, turn, role, text) -> (conv, turn, role, text, n): n equal rows after the damage; n = 0 keeps a conversation known."""
    blank = F.lit(" ")
    draw = F.pmod(F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))), F.lit(20))
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    drawn = rows.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), draw.alias("draw"))
    gone = F.col("draw") == 0
    return drawn.select(
        "conv", F.when(~gone, F.col("turn")).alias("turn"), F.when(gone, "").when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone | (F.col("draw") == 1), "").when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(gone, 0).when(F.col("draw") == 3, 2).otherwise(1).alias("n"))


def _marked(rows: DataFrame) -> DataFrame:
    """Staged rows(conv, turn, role, text, sha, n) -> the same with initial, fault (1 blank, 2 duplicate, 3 truncated) and symbol."""
    seen = rows.where("n > 0").groupBy("conv", "role", "sha").agg(F.count("*").alias("times"), F.min("turn").alias("least"), F.bool_or(F.col("turn").isNull()).alias("unplaced")) \
        .where("times > 1").select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("sha").alias("s"), "least", "unplaced")
    met = rows.join(seen, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("sha") == F.col("s")), "left").drop("c", "r", "s")
    bare: Column = F.rtrim("text", F.lit(SPACES))
    earlier = F.coalesce(F.col("turn").isNotNull() & (F.col("unplaced") | (F.col("least") < F.col("turn"))), F.lit(False))
    fault = F.when(bare == "", 1).when(earlier, 2).when(~F.substring(bare, -1, 1).isin(".", "!", "?"), 3).otherwise(0)
    out = met.select("conv", "turn", "role", "sha", "text", "n", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
    place = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    return out.withColumn("symbol", F.when(F.col("fault").isin(1, 2), MUST_GO).otherwise(2 * place + (F.col("fault") == 3).cast("int")))


ORDER = ("conv", "turn", "role", "sha")
STATS = "part int, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, initial string, last string"
MORE = "symbols array<int>, lengths array<long>, matrix array<long>"


def _schema(conv: str, *parts: str) -> str:
    return ", ".join([f"conv {conv}", *parts])


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "bigint": pa.int64(), "string": pa.string(), "smallint": pa.int16(), "tinyint": pa.int8(), "boolean": pa.bool_(),
             "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split(" ") for field in ddl.split(", "))])


def _ranges(marked: DataFrame, conv: str) -> DataFrame:
    """Rows in their ranges -> a result for each conversation inside a range (done), a part for each that may cross a border."""
    ddl = _schema(conv, "done boolean", *(f"{c} long" for c in RESULT if c not in STATS), "audit string", "repaired_sha256 string", STATS, MORE)

    def run(batches):
        schema, number = _arrow(ddl), TaskContext.get().partitionId()
        out, now, first = [], None, True

        def close(border: bool):
            conv, part, runs, texts = now
            if border or texts is None:
                out.append({"conv": conv, "done": False, "part": number, **{f: getattr(part, f) for f in _Part.FIELDS}, "symbols": [s for s, _ in runs],
                            "lengths": [n for _, n in runs], "matrix": [c for row in run_matrix(runs) for c in row]})
                return
            [(audit, state)] = unrolled(runs, FINAL, [EMPTY])
            cost = FINAL
            for symbol, n in reversed(runs):
                cost = before_run(symbol, n, cost)
            writer = Writer(audit + ENDING[state])
            for role, text, n in texts:
                for _ in range(n):
                    writer.row(role, text)
            out.append({"done": True, **_result(conv, part, cost[EMPTY], writer)})
        held = 0
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("conv", "turn", "role", "text", "n", "initial", "fault", "symbol")]
            for conv, turn, role, text, n, initial, fault, symbol in zip(*columns):
                if now is None or now[0] != conv:
                    if now is not None:
                        close(first)
                        first = False
                    now, held = [conv, _Part(), [], []], 0
                if not n:
                    continue
                now[1].take(turn, initial, fault, n)
                runs = now[2]
                for s, count in ((symbol, n),) if symbol == MUST_GO else ((symbol, 1), (MUST_GO, n - 1)):
                    if count:
                        if runs and runs[-1][0] == s:
                            runs[-1] = (s, runs[-1][1] + count)
                        else:
                            runs.append((s, count))
                held += len(text) + len(role) + 100
                if now[3] is not None:
                    now[3].append((role, text, n))
                    if held > HELD_BYTES:
                        now[3] = None
            if len(out) > 2000:
                yield _batch(out, schema)
                out.clear()
        if now is not None:
            close(True)
        yield _batch(out, schema)
    return marked.select("conv", "turn", "role", "text", "n", "initial", "fault", "symbol").mapInArrow(run, ddl)


def _behind(parts: DataFrame, conv: str) -> DataFrame:
    """parts(conv, part, matrix) -> (conv, part, behind): the costs to go behind each part, from the matrices of later ones."""
    ddl = _schema(conv, "part int", "behind array<long>")

    def run(batches):
        schema, now, vector, out = _arrow(ddl), None, FINAL, []
        for batch in batches:
            for row in batch.to_pylist():
                if now is None or now[0] != row["conv"]:
                    now, vector = [row["conv"]], FINAL
                out.append({"conv": row["conv"], "part": row["part"], "behind": list(vector)})
                vector = applied([row["matrix"][i:i + 4] for i in range(0, 16, 4)], vector)
            yield _batch(out, schema)
            out = []
    return parts.select("conv", "part", "matrix").repartition("conv").sortWithinPartitions("conv", F.desc("part")).mapInArrow(run, ddl)


def _unrolled_parts(parts: DataFrame, conv: str) -> DataFrame:
    """parts(..., symbols, lengths, behind) -> statistics, and for each entry state the letters and the state behind."""
    ddl = _schema(conv, STATS, "behind array<long>", "matrix array<long>", "audits array<string>", "exits array<int>")

    def run(batches):
        schema = _arrow(ddl)
        for batch in batches:
            for i in range(batch.num_rows):
                [row] = batch.slice(i, 1).to_pylist()
                got = unrolled(list(zip(row.pop("symbols"), row.pop("lengths"))), tuple(row["behind"]), range(4))
                yield _batch([{**row, "audits": [a for a, _ in got], "exits": [e for _, e in got]}], schema)
    return parts.mapInArrow(run, ddl)


def _last_pass(parts: DataFrame, texts: DataFrame, conv: str) -> DataFrame:
    """Unrolled parts and the rows of their conversations -> results; streams, holding a conversation's audit but no texts."""
    ddl = _schema(conv, *(f"{c} long" for c in RESULT), "audit string", "repaired_sha256 string")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("sha", "binary"), ("text", "string"), ("n", "int"))]
    heads = parts.select("conv", F.lit(0).alias("kind"), *[c for c in parts.columns if c != "conv"], *none)
    rows = texts.where("n > 0").select("conv", F.lit(1).alias("kind"), "turn", "role", "sha", "text", "n")
    placed = heads.unionByName(rows, allowMissingColumns=True).repartition("conv").sortWithinPartitions("conv", "kind", "part", "turn", "role", "sha")

    def run(batches):
        schema, out, now = _arrow(ddl), [], None

        def start():
            now["writer"] = Writer("".join(now.pop("letters")) + ENDING[now["state"]])

        def close():
            if now is not None:
                if "writer" not in now:
                    start()
                out.append(_result(now["conv"], now["part"], now["cost"], now["writer"]))
        for batch in batches:
            for row in (row for i in range(0, batch.num_rows, 64) for row in batch.slice(i, 64).to_pylist()):
                if now is None or now["conv"] != row["conv"]:
                    close()
                    now = {"conv": row["conv"], "part": _Part(), "state": EMPTY, "letters": [], "cost": None}
                if row["kind"] == 0:
                    if now["cost"] is None:  # what lies behind a part includes all later ones
                        now["cost"] = applied([row["matrix"][i:i + 4] for i in range(0, 16, 4)], row["behind"])[EMPTY]
                    now["part"].join(_Part(**{f: row[f] for f in _Part.FIELDS}))
                    now["letters"].append(row["audits"][now["state"]])
                    now["state"] = row["exits"][now["state"]]
                else:
                    if "writer" not in now:
                        start()
                    for _ in range(row["n"]):
                        now["writer"].row(row["role"], row["text"])
            yield _batch(out, schema)
            out.clear()
        close()
        yield _batch(out, schema)
    return placed.mapInArrow(run, ddl)


def repaired(rows: DataFrame) -> DataFrame:
    """damaged(conv, turn, role, text, n) -> a row for each conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are taken by turn (null first), then role, then the text's SHA-256, so that equal rows are neighbours. A row's first
    fault counts: blank, duplicate (role and text seen earlier in the conversation), truncated. Roles count by their first
    character; one that is not s, u or a cannot be kept. A conversation of which no row is left has zeros, an empty audit
    and the digest of an empty string. Rows without a conversation id are one conversation. An empty table gives an empty one.
    """
    conv = dict(rows.dtypes)["conv"]
    whole = staged(rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n")).withColumn("sha", F.unhex(F.sha2("text", 256))), "rows")
    marked = _marked(whole)
    size = whole.agg(F.sum(F.length("text") + F.length("role") + 100)).first()[0] or 0
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = marked.repartitionByRange(max(least, -(-size // RANGE_BYTES)), *ORDER).sortWithinPartitions(*ORDER)
    found = staged(_ranges(ranged, conv), "ranges")
    done = found.where("done").select("conv", *RESULT, "audit", "repaired_sha256")
    parts = found.where("not done")
    behind = _behind(parts, conv).withColumnRenamed("conv", "c").withColumnRenamed("part", "p")
    stats = [field.split(" ")[0] for field in STATS.split(", ")]
    met = parts.select("conv", *stats, "matrix", "symbols", "lengths").join(behind, F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    unrolled_ = staged(_unrolled_parts(met.select("conv", *stats, "behind", "matrix", "symbols", "lengths"), conv), "unrolled")
    open_ = parts.select(F.col("conv").alias("c")).distinct()
    texts = whole.join(open_, F.col("conv").eqNullSafe(F.col("c")), "left_semi")
    out = staged(done.unionByName(_last_pass(unrolled_, texts, conv)), "repaired")
    dropped(whole, found, unrolled_)
    return out


@query("op12_conversations")
def op12_conversations(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repaired(damaged(rows)).withColumnRenamed("conv", "conv_id")
