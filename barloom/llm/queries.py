"""The registered queries of this package and the pipeline."""
from __future__ import annotations

import corpus_pipeline
from barloom.llm import dialogue, embedding, exact, fingerprint, minhash, mixing, packing, pii, quality, secrets, sharding, warc, whitening  # noqa: F401
from barloom.llm.common import ORACLES, QUERIES


def queries():
    return dict(QUERIES) | {"pipeline": corpus_pipeline.run}


def oracle_sql():
    extra = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return dict(ORACLES) | extra
