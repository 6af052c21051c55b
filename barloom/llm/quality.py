"""Quality classifier: a document's own evidence combined with what its host and path are known for.

Hierarchical empirical Bayes: a linear classifier, fitted on a bounded sample of labelled documents, gives each document
a log likelihood ratio. Grouped sums of the documents' soft labels give each host and each path in it a posterior mean,
shrunk to the level above (path to host, host to the global prior) by a strength that is estimated from how much sites
differ. A document's posterior is its path's prior odds, its own part taken out, times its likelihood ratio.
"""
from __future__ import annotations

import operator
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import claim_memory, query, staged, table

#: Most labelled documents that the classifier is fitted on, drawn by a hash of the document id.
SAMPLE = 6_000
BUCKETS = 1 << 18
#: A word counts from so many sampled documents on.
LEAST_DOCS = 4
#: Standard errors by which a word's log odds ratio must differ from 0.
SURE = 3.0
STYLE = ("upper", "symbols", "marks", "digits", "repeats", "top_share")
HEADS = ("quality", "toxic")
#: Words whose codes a worker remembers, about 200 bytes each; full, it starts anew.
REMEMBERED = 200_000
SHRINK_LIMITS = (1.0, 1e6)
EVIDENCE_LIMIT = 30.0

_KNOWN: dict[str, int] = {}
_MARKS = ".,!?;:%$&#*|\"'()[]{}<>-_=+/"


def _code(word: str) -> int:
    """The word's bucket in the low bits; above them: in capitals, without letters or digits, ends in two marks, has a digit."""
    bare = word.strip(_MARKS)
    flags = word.isupper() | (not bare) << 1 | (len(word) > 1 and word[-1] in _MARKS and word[-2] in _MARKS) << 2 | any(map(str.isdigit, word)) << 3
    return zlib.crc32(bare.lower().encode("utf-8", "surrogatepass")) % BUCKETS | flags << 18


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Square roots of style shares of all words, and the distinct word buckets, of the whole text; no words: zeros and none."""
    words = (text or "").split()
    if not words:
        return np.zeros(len(STYLE)), np.zeros(0, np.int64)
    claim_memory("quality", _KNOWN.clear)
    if len(_KNOWN) > REMEMBERED:
        _KNOWN.clear()
    for w in set(words).difference(_KNOWN):
        _KNOWN[w] = _code(w)
    codes = np.fromiter(map(_KNOWN.__getitem__, words), np.int64, len(words))
    n, flags = len(words), codes >> 18
    buckets, counts = np.unique(codes & (BUCKETS - 1), return_counts=True)
    style = [float((flags >> b & 1).sum()) / n for b in range(4)]
    return np.sqrt([*style, sum(map(operator.eq, words, words[1:])) / n, counts.max() / n if n >= 20 else 0.0]), buckets


def _lexical(buckets: np.ndarray, lexicon: np.ndarray) -> list[float]:
    """Sums of a document's three strongest words for and against; few words say it, however long the text."""
    w = np.sort(lexicon[buckets])
    return [float(w[-3:].clip(0).sum()), float(w[:3].clip(None, 0).sum())]


@dataclass
class Head:
    lexicon: np.ndarray
    middle: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float


@dataclass
class Model:
    heads: dict[str, Head]

    def evidence(self, text: str | None) -> list[float]:
        """Log likelihood ratio of each head; 0 for a text without words and for a head that could not be fitted."""
        style, buckets = features(text)
        out = []
        for name in HEADS:
            head = self.heads.get(name)
            if head is None or not len(buckets):
                out.append(0.0)
                continue
            x = (np.concatenate([style, _lexical(buckets, head.lexicon)]) - head.middle) / head.scale
            out.append(float(np.clip(head.weights[0] + x @ head.weights[1:] - head.prior, -EVIDENCE_LIMIT, EVIDENCE_LIMIT)))
        return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, ridge: float = 1e-4) -> Model:
    """Logistic regression of quality and of toxic on at most `sample` labelled documents.

    Labelled rows that are null in an id or in both labels are left out. A head whose sample has one class only is not fitted.
    """
    some = labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)").select(
        F.col("doc_id").alias("__id"), F.col("quality").alias("__quality"), F.col("toxic").alias("__toxic")) \
        .orderBy(F.xxhash64("__id", F.lit("fit")), "__id", "__quality", "__toxic").limit(sample)

    def describe(batches):
        for batch in batches:
            rows = [features(batch["text"][i].as_py()) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch["__quality"].cast(pa.int32()), batch["__toxic"].cast(pa.int32()), pa.array([s.tobytes() for s, _ in rows], pa.binary()),
                                              pa.array([b.astype("<i4").tobytes() for _, b in rows], pa.binary())], names=["quality", "toxic", "style", "words"])
    chosen = docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("__id"))  # the sample is bounded
    rows = chosen.select("__quality", "__toxic", "text").mapInArrow(describe, "quality int, toxic int, style binary, words binary").limit(2 * sample).collect()
    rows.sort(key=lambda r: (bytes(r["words"]), bytes(r["style"])))
    style = np.array([np.frombuffer(r["style"], "<f8") for r in rows]).reshape(-1, len(STYLE))
    words = [np.frombuffer(r["words"], "<i4") for r in rows]
    heads = {}
    for name in HEADS:
        have = [i for i, r in enumerate(rows) if r[name] is not None]
        y = np.array([float(rows[i][name] > 0) for i in have])
        if len(y) and 0 < y.sum() < len(y):
            heads[name] = _head(style[have], [words[i] for i in have], y, ridge)
    return Model(heads)


def _copy_weights(words: list[np.ndarray]) -> np.ndarray:
    """1 / number of sampled documents with the same four smallest word hashes, so that a group of copies counts about once."""
    salts = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint64)
    marks = [tuple(((w.astype(np.uint64)[:, None] * salts) % np.uint64(2**32)).argmin(0)) if len(w) else () for w in words]
    marks = [tuple(w[list(m)]) for w, m in zip(words, marks, strict=True)]
    counts = Counter(marks)
    return np.array([1.0 / counts[m] for m in marks])


def _word_weights(words: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Log odds ratio of each word bucket between the classes, half a document added to each cell; 0 where unsure."""
    n_one, n_zero = float((weight * y).sum()), float((weight * (1 - y)).sum())
    if not n_one or not n_zero:
        return np.zeros(BUCKETS, np.float32)
    lengths, every = [len(w) for w in words], np.concatenate(words)
    one, zero = (np.bincount(every, np.repeat(weight * k, lengths), BUCKETS) for k in (y, 1 - y))
    ratio = np.log((one + 0.5) / (n_one - one + 0.5)) - np.log((zero + 0.5) / (n_zero - zero + 0.5))
    sure = np.abs(ratio) > SURE * np.sqrt(1 / (one + 0.5) + 1 / (zero + 0.5))
    return np.where(sure & (one + zero >= LEAST_DOCS), ratio, 0).astype(np.float32)


def _head(style: np.ndarray, words: list[np.ndarray], y: np.ndarray, ridge: float) -> Head:
    """Logistic regression (Newton steps) on the style shares and the lexical sums, the latter from the other half's words."""
    weight = _copy_weights(words)
    half = np.arange(len(y)) % 2
    lexical = np.zeros((len(y), 2))
    for k in (0, 1):
        other = _word_weights([w for w, h in zip(words, half, strict=True) if h != k], y[half != k], weight[half != k])
        for i in np.flatnonzero(half == k):
            lexical[i] = _lexical(words[i], other)
    x = np.hstack([style, lexical])
    middle, scale = x.mean(0), x.std(0) + 1e-3
    x = np.hstack([np.ones((len(y), 1)), (x - middle) / scale])
    share = (weight * y).sum() / weight.sum()
    prior = float(np.log(share / (1 - share)))
    w = np.zeros(x.shape[1])
    w[0] = prior
    penalty = ridge * weight.sum() * np.diag([0.0, *np.ones(x.shape[1] - 1)])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)), x.T @ (weight * (y - p)) - penalty @ w)
        w += step * min(1.0, 3.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return Head(_word_weights(words, y, weight), middle, scale, w, prior)


def with_evidence(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs(any columns) with a struct `__evidence` of one log likelihood ratio for each head; nothing is shuffled."""
    @F.pandas_udf("quality double, toxic double")
    def score(texts):
        import pandas as pd
        return pd.DataFrame([model.evidence(t) for t in texts], columns=list(HEADS), dtype="float64")
    score.func.__annotations__ = {}
    return docs.withColumn("__evidence", score(F.col(text)))


def _soft(evidence, prior: float):
    return 1 / (1 + F.exp(-(evidence + F.lit(float(np.log(prior / (1 - prior)))))))


def _strength(groups: DataFrame, prior_mean, prior: float) -> float:
    """Shrinkage in documents, by moments: how far groups' means lie apart beyond what their sizes explain."""
    r = groups.agg(F.sum("n"), F.sum(F.col("n") * F.col("n")), F.count("*"), F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - prior_mean, 2))).first()
    n, squares, count, spread = (float(x or 0) for x in r)
    within = prior * (1 - prior)
    room = n - squares / n if n else 0.0
    between = (spread - (count - 1) * within) / room if room > 0 else 0.0
    return float(np.clip(within / between - 1 if between > 0 else SHRINK_LIMITS[1], *SHRINK_LIMITS))


def site_posteriors(evidence: DataFrame, head: str, prior: float) -> tuple[DataFrame, float, float]:
    """evidence(host, path, <head>) -> (host, path, n, s, host_mean) with the strengths of both levels.

    Sums combine before the shuffle, so a host with a third of all documents is one row a task. Null hosts and paths are
    groups of their own.
    """
    paths = staged(evidence.groupBy("host", "path").agg(F.count("*").cast("double").alias("n"), F.sum(_soft(F.col(head), prior)).alias("s")), "paths")
    hosts = staged(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "hosts")
    above = _strength(hosts, F.lit(prior), prior)
    means = hosts.select(F.col("host").alias("__host"), ((F.col("s") + above * prior) / (F.col("n") + above)).alias("host_mean"))
    joined = staged(paths.join(means, F.col("host").eqNullSafe(F.col("__host"))).drop("__host"), "sites")
    return joined, above, _strength(joined, F.col("host_mean"), prior)


def classify(docs: DataFrame, labels: DataFrame, host, path, sample: int = SAMPLE) -> DataFrame:
    """docs with __quality and __toxic (posteriors), __host_prior, __path_prior, __evidence and `__kept`.

    host, path: columns that name a document's site and its part. __kept: quality is at least as likely as not and
    toxicity is less likely than not. Null or wordless texts have evidence 0: their site decides. Without usable labels
    all evidence is 0 and all documents stay. Repeated rows are judged alike. An empty table gives an empty one.
    """
    model = fit(docs, labels, sample)
    inner = docs.withColumns({"__host": host.cast("string"), "__path": path.cast("string")})
    scored = with_evidence(inner, model)
    narrow = staged(scored.select(F.col("__host").alias("host"), F.col("__path").alias("path"), "__evidence.*"), "evidence")
    out = scored
    for head in HEADS:
        prior = float(1 / (1 + np.exp(-model.heads[head].prior))) if head in model.heads else (0.999 if head == "quality" else 0.001)
        sites, _, strength = site_posteriors(narrow, head, prior)
        side = sites.select(F.col("host").alias("__h"), F.col("path").alias("__p"), F.col("n").alias("__n"), F.col("s").alias("__s"), F.col("host_mean").alias(f"__{head}_host"))
        own = F.col("__evidence")[head]
        joined = out.join(side, out["__host"].eqNullSafe(side["__h"]) & out["__path"].eqNullSafe(side["__p"]), "left")
        mean = (F.col("__s") - _soft(own, prior) + strength * F.col(f"__{head}_host")) / (F.col("__n") - 1 + strength)
        mean = F.least(F.greatest(mean, F.lit(1e-6)), F.lit(1 - 1e-6))
        out = joined.withColumn(f"__{head}_path", mean).withColumn(f"__{head}", 1 / (1 + F.exp(-(own + F.log(mean / (1 - mean)))))) \
            .drop("__h", "__p", "__n", "__s")
    return out.withColumn("__kept", (F.col("__quality") >= 0.5) & (F.col("__toxic") < 0.5))


@query("op1_quality")
def op1_quality(spark, sf_dir):
    """Hosts are the documents' sources, paths the languages in them: the table has no addresses."""
    out = classify(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"), table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))
    return out.select("doc_id", F.col("source").alias("host"), F.col("lang").alias("path"), F.col("__evidence.quality").alias("quality_evidence"),
                      F.col("__evidence.toxic").alias("toxic_evidence"), F.col("__quality_host").alias("host_quality"), F.col("__quality_path").alias("path_quality"),
                      F.col("__quality").alias("quality"), F.col("__toxic").alias("toxic"), F.col("__kept").alias("kept"))
