"""Toxicity: a factorisation machine over hashed terms, whose pairwise weights learn combinations
(an insult next to a group's mention) that additive weights miss. See :mod:`lineweave.llm.fm` for the
method, its bounds and its cases. Null ids are scored, counted as held out and never learned from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweave.llm import fm
from lineweave.llm import textops as T
from lineweave.llm.tables import read_table

#: Beginnings of words catch inflected and lengthened insults whose full form is new.
SETTINGS = fm.Settings(separators=T.NON_ALNUM, prefixes=(4, 5, 6))
FOLDS, HELD_OUT = 5, 0


def fit_toxicity(docs: DataFrame, labels: DataFrame, settings: fm.Settings = SETTINGS) -> fm.Model:
    return fm.fit(docs, labels.where(fm.fold("doc_id", FOLDS) != HELD_OUT), "toxic", settings)


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    out = fm.scored(docs, fit_toxicity(docs, labels))
    held_out = F.coalesce(fm.fold("doc_id", FOLDS) == HELD_OUT, F.lit(True))
    return out.select("doc_id", held_out.alias("held_out"), "score", "predicted")
