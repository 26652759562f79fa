"""Hashing embedder: deterministic vectors without a model."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

WORD = re.compile(r"[^\W_]+")


def vector_of(text: str, size: int, seen: dict[str, int]) -> np.ndarray:
    """Unit vector of hashed words and adjacent word pairs; a text without words is the first axis."""
    words = WORD.findall(text.lower())
    out = np.zeros(size, dtype=np.float32)
    for token in [*words, *(f"{a}_{b}" for a, b in zip(words, words[1:]))]:
        at = seen.get(token)
        if at is None:
            if len(seen) > 500_000:
                seen.clear()
            at = seen[token] = int.from_bytes(hashlib.blake2b(token.encode(), digest_size=8).digest(), "big") % size
        out[at] += 1
    norm = np.linalg.norm(out)
    if norm == 0:
        out[0] = norm = 1.0
    return out / norm


def hashing_vectors(df: DataFrame, id_col: str, text: Column, size: int = 1024) -> DataFrame:
    """(id, v): one unit vector per row; null text counts as empty, null ids are skipped."""

    def run(batches):
        seen: dict[str, int] = {}
        for batch in batches:
            vs = [vector_of(t or "", size, seen) for t in batch.column(1).to_pylist()]
            flat = pa.array(np.concatenate(vs) if vs else np.zeros(0, np.float32))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(vs) + 1, dtype=np.int32) * size), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "v"])

    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    return rows.mapInArrow(run, "id bigint, v array<float>")
