"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata
computed from the text (its length, its lines). See :mod:`lineweave.llm.fm` for the method, its bounds
and its cases. Null ids are scored, counted as held out and never learned from.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweave.llm import fm
from lineweave.llm import textops as T
from lineweave.llm.tables import read_table

FOLDS, HELD_OUT = 3, 1

_KINDS = (
    T.byte_class([(0x41, 0x5A)]),
    T.byte_class([(0x30, 0x39)]),
    T.byte_class([(0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)]),
    T.byte_class([(0x21, 0x21), (0x23, 0x26), (0x2A, 0x2A), (0x7C, 0x7C), (0x3C, 0x3E)]),
    T.byte_class([(0x2C, 0x2C), (0x2E, 0x2E)]),
    T.byte_class([(0x80, 0xFF)]),
    T.byte_class([(0x0A, 0x0A)]),
)


def structure(words: T.Words, texts: list[bytes]) -> np.ndarray:
    """Rows x statistics: length, words, word length, kinds of bytes, lines, share of distinct words."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    base, sizes = words.base, np.maximum(np.diff(words.base) - 1, 0)
    n = np.maximum(sizes, 1)
    count, own = words.counts, np.maximum(words.counts, 1)
    out = [np.log1p(sizes), np.log1p(count), sizes / own]
    for i, kind in enumerate(_KINDS):
        total = np.concatenate([[0], np.cumsum(kind[raw], dtype=np.int64)])
        found = total[base[1:] - 1] - total[base[:-1]]
        out.append(found / n if i < len(_KINDS) - 1 else (found + 1) / own)
    order = np.lexsort((words.h, words.doc))
    h, doc = words.h[order], words.doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    out.append(np.bincount(doc[new], minlength=len(texts)) / own)
    return np.stack(out, axis=1).astype(float)


SETTINGS = fm.Settings(separators=T.WHITE, statistics=structure)


def fit_quality(docs: DataFrame, labels: DataFrame, settings: fm.Settings = SETTINGS) -> fm.Model:
    return fm.fit(docs, labels.where(fm.fold("doc_id", FOLDS) != HELD_OUT), "quality", settings)


def keep_quality(docs: DataFrame, labelled: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that a model fitted on ``labelled`` documents rejects; same columns."""
    return fm.kept(docs, fit_quality(labelled, labels))


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    out = fm.scored(docs, fit_quality(docs, labels))
    held_out = F.coalesce(fm.fold("doc_id", FOLDS) == HELD_OUT, F.lit(True))
    return out.select("doc_id", held_out.alias("held_out"), "score", "predicted")
