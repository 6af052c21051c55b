"""Mixture-controlled packing of token streams into sequences of fixed length.

Each source is a queue of tokens: its documents one after another. A window takes from every queue the quota that its
target proportion gives; what rounding leaves over (the deficit) is carried to the next window. As quotas are rounded
running totals, the deficit before any window follows from the window's number alone, so windows, partitions and tasks
need no hand-over: floor(k * T / K) tokens of a queue of T lie before window k of K.
"""
from __future__ import annotations

import string
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import claim_memory, query, staged, table

SEQUENCE = 4096
#: Sequences in a window: the mixture holds in every run of so many, and a document is cut at most once a window more.
WINDOW_SEQUENCES = 16
END_ID = 2
#: Most queues: the vector of queue lengths (8 bytes each) goes to every task. With more sources the largest keep queues of
#: their own, and the rest lie one behind another in POOLS shared queues.
MAX_SOURCES, POOLS = 65_536, 4096
#: Bytes of run begins (8 a queue and window) that a task keeps at once.
BASE_BYTES = 64 << 20
#: Words whose ids a worker remembers (with their cores about 180 MB at most); full, it starts anew.
REMEMBERED = 600_000
BATCH_BYTES = 4 << 20
#: Up to so many (source, task) offsets, about 40 bytes each, are sent to every task; beyond, the tokens are shuffled.
BROADCAST_STARTS = 500_000

PIECE_DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
             "source string, sequence_length long")
PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                   ("sequence_id", pa.int64()), ("offset", pa.int64()), ("source", pa.string()), ("sequence_length", pa.int64())])
TOKENS_DDL = "doc_id long, source string, part int, ahead long, n long, ids binary"
TOKENS = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("part", pa.int32()), ("ahead", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

_ENCODERS: dict = {}


#: The tokenizer's letters for bytes: printable ones stand for themselves, the rest for 256 and up, in order.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_LETTERS = dict(zip([b for b in range(256) if b not in _PLAIN], map(chr, range(256, 512)), strict=False))


def _packed(ids: list[int]) -> bytes:
    """Ids as 16-bit little-endian numbers."""
    return struct.pack(f"<{len(ids)}H", *ids)


class WordEncoder:
    """ids of a text as the tokenizer gives them for the whole text.

    The tokenizer drops white space and never joins characters across a space or a line feed, so the ids of a text are
    those of its pieces between them, and a piece seen before is looked up. A new piece that is one run of Latin-1
    letters, with ASCII punctuation behind it or not, is lower-cased and goes to the tokenizer's own model as the two
    pre-tokens that it is; any other piece goes through the whole tokenizer. Ids are kept as 16-bit numbers.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, bytes] = {"": b""}
        self.cores: dict[str, bytes] = {"": b""}

    def _core(self, word: str) -> bytes:
        """A run of Latin-1 letters in lower case."""
        if word not in self.cores:
            pre_token = word if word.isascii() else word.encode().decode("latin-1").translate(_LETTERS)
            self.cores[word] = _packed([t.id for t in self.model.tokenize(pre_token)])
        return self.cores[word]

    def _behind(self, marks: str) -> bytes:
        """A run of ASCII punctuation, as a word of its own."""
        if marks not in self.known:
            self.known[marks] = _packed(self.tokenizer.encode(marks, add_special_tokens=False).ids)
        return self.known[marks]

    def _learn(self, words: set[str]) -> None:
        whole = []
        for word in words:
            core = word.rstrip(string.punctuation)
            if core.isalpha() and (core.isascii() or max(core) <= "\xff"):
                self.known[word] = self._core(core.lower()) + self._behind(word[len(core):])
            else:
                whole.append(word)
        for at in range(0, len(whole), 4096):
            some = whole[at:at + 4096]
            for word, got in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                self.known[word] = _packed(got.ids)

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        words_here = set().union(*split)
        if fresh := words_here.difference(self.known):
            if len(self.known) + len(fresh) > REMEMBERED:
                self._forget()
                fresh = words_here.difference(self.known)
            self._learn(fresh)
        look = self.known.__getitem__
        return [b"".join(map(look, words)) for words in split]


def encoder(path: str) -> WordEncoder:
    claim_memory("packing", _ENCODERS.clear)
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """docs(doc_id, text, source) -> doc_id, source, part, ahead, n, ids (16-bit little-endian), the end id included.

    part is the task's number and ahead the tokens of the same source before the document in that task: the order within
    a queue is by task, then as read. Only rows within one piece of work are ordered, so nothing is shuffled.
    """
    end = np.asarray([end_id], "<u2").tobytes()

    def run(batches):
        encode, part, ahead = encoder(tokenizer), TaskContext.get().partitionId(), {}
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, upto, size = [], at, 0
                while upto < batch.num_rows and size < BATCH_BYTES:
                    texts.append(batch["text"][upto].as_py() or "")
                    size += len(texts[-1])
                    upto += 1
                ids = [x + end for x in encode(texts)]
                sources = batch["source"].slice(at, upto - at).to_pylist()
                counts = [len(x) // 2 for x in ids]
                before = []
                for s, n in zip(sources, counts, strict=True):
                    before.append(ahead.get(s, 0))
                    ahead[s] = before[-1] + n
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(at, upto - at), pa.array(sources, pa.string()), pa.array([part] * len(ids), pa.int32()),
                                                  pa.array(before, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], schema=TOKENS)
                at = upto
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.col("source").cast("string").alias("source")).mapInArrow(run, TOKENS_DDL)


def _before(k, totals, windows: int):
    """floor(k * total / windows) without overflow; of plain numbers or of an array of totals."""
    whole, rest = totals // windows, totals % windows
    return k * whole + k * rest // windows


def pack(tokens: DataFrame, length: int = SEQUENCE, window_sequences: int = WINDOW_SEQUENCES) -> DataFrame:
    """Pieces of the documents with their place: sequence_id, offset, and the sequence's length.

    tokens: a written result of `tokenized` (it is read twice). The windows hold the sources in the corpus' proportions,
    so all queues end together and every id is used once. Sequences are cut from the windows in turn; what is left after
    the last full one is cut into sequences whose lengths are powers of two, so there is no padding at all. A source
    that holds most documents is one queue in many tasks. No rows: no pieces. Rows that repeat are packed each. Of more than
    MAX_SOURCES sources the smallest share queues: the mixture then holds for the shared queue, and a source's tokens keep
    together in it.
    """
    per_part = tokens.groupBy("source", "part").agg(F.sum("n").alias("tokens"))
    sources = per_part.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    queues = sources.orderBy(F.col("tokens").desc(), F.col("source").asc_nulls_last()).limit(MAX_SOURCES + 1).collect()
    pools = POOLS if len(queues) > MAX_SOURCES else 0
    if pools:
        queues = queues[:MAX_SOURCES - pools]
    queues.sort(key=lambda q: (q["source"] is None, q["source"] or ""))
    own = tokens.sparkSession.createDataFrame([(q["source"], i) for i, q in enumerate(queues)], "__source string, __own int")
    pool = F.lit(len(queues)) + F.pmod(F.xxhash64("source"), F.lit(max(1, pools))).cast("int")
    per_part = per_part.join(F.broadcast(own), F.col("source").eqNullSafe(F.col("__source")), "left").select("source", "part", "tokens", F.coalesce("__own", pool).alias("queue"))
    totals = np.asarray([q["tokens"] for q in queues] + [0] * pools, np.int64)
    if pools:
        for row in per_part.where(F.col("queue") >= len(queues)).groupBy("queue").agg(F.sum("tokens").alias("tokens")).collect():
            totals[row["queue"]] = row["tokens"]
    total = int(totals.sum())
    windows = max(1, -(-total // (length * window_sequences)))
    full = total // length
    tail = [1 << b for b in reversed(range(length.bit_length())) if (total % length) >> b & 1]
    ends = np.cumsum([0, *tail]) + full * length
    upto = Window.partitionBy("queue").orderBy("source", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select(F.col("source").alias("__source"), F.col("part").alias("__part"), F.col("queue").alias("__queue"), F.coalesce(F.sum("tokens").over(upto), F.lit(0)).alias("__start"))
    if per_part.count() <= BROADCAST_STARTS:
        starts = F.broadcast(starts)
    placed = tokens.join(starts, tokens["source"].eqNullSafe(starts["__source"]) & (tokens["part"] == starts["__part"]), "left")

    def run(batches):
        for batch in batches:
            ids = batch["ids"]
            q = batch["__queue"].to_numpy()
            n, x0 = batch["n"].to_numpy(), batch["ahead"].to_numpy() + batch["__start"].to_numpy()
            held: list[dict] = []
            base: dict[int, np.ndarray] = {}
            for i in range(batch.num_rows):
                own, t, at, end = int(q[i]), int(totals[q[i]]), int(x0[i]), int(x0[i] + n[i])
                raw = np.frombuffer(ids[i].as_py(), "<u2").astype("<u4").tobytes()
                doc, source, start = batch["doc_id"][i].as_py(), batch["source"][i].as_py(), 0
                k = max(0, at * windows // t - 1)
                while at < end:
                    while _before(k + 1, t, windows) <= at:
                        k += 1
                    if k not in base:  # where each queue's run begins in this window
                        if (len(base) + 1) * totals.nbytes > BASE_BYTES:
                            base.clear()
                        low = _before(np.int64(k), totals, windows)
                        run_lengths = _before(np.int64(k + 1), totals, windows) - low
                        base[k] = (int(low.sum()) + np.concatenate([[0], np.cumsum(run_lengths)[:-1]]) - low)
                    place = int(base[k][own]) + at
                    stop = min(end, _before(k + 1, t, windows))
                    if place < full * length:
                        sequence, offset, room, whole = place // length, place % length, length - place % length, length
                    else:
                        j = int(np.searchsorted(ends, place, "right")) - 1
                        sequence, offset, room, whole = full + j, place - int(ends[j]), int(ends[j + 1]) - place, tail[j]
                    stop = min(stop, at + room)
                    m = stop - at
                    held.append({"doc_id": doc, "start": start, "length": m, "ids_crc32": zlib.crc32(raw[4 * start:4 * (start + m)]), "doc_tokens": int(n[i]),
                                 "sequence_id": sequence, "offset": offset, "source": source, "sequence_length": whole})
                    start, at = start + m, stop
                if len(held) >= 20_000:
                    yield pa.RecordBatch.from_pylist(held, schema=PIECE)
                    held, base = [], {}
            if held:
                yield pa.RecordBatch.from_pylist(held, schema=PIECE)
    return placed.select("doc_id", "source", "ahead", "n", "ids", "__start", "__queue").mapInArrow(run, PIECE_DDL)


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op9_packing")
def op9_packing(spark, sf_dir):
    tokens = staged(tokenized(table(spark, sf_dir, "documents"), tokenizer_path()), "tokens")
    return pack(tokens).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
