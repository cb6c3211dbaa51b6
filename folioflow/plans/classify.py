"""Labels for posts, from a scorer that can be exchanged."""

from __future__ import annotations

import json
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from folioflow.config import FlowConfig
from folioflow.functions import scalars as sc, variants as vr
from folioflow.plans.tasks import take

PENDING, DONE, FAILED = 0, 1, 2


class Scorer(Protocol):
    """Pickled to the executors; gives a JSON verdict per cleaned text.

    Two more methods are used where a scorer has them: ``open()``, called once per Python worker,
    gives the object that scores (a loaded model), and ``score_batch(texts)`` gives the verdicts of a
    whole Arrow batch in order.
    """

    def score(self, text: str) -> str: ...


@dataclass(frozen=True)
class RuleScorer:
    """Deterministic scorer: the first matching pattern names the category."""

    valuable: str = "[0-9]"
    categories: tuple[tuple[str, str], ...] = field(default=(
        ("A股|沪|深", "A股"), ("港股|恒生", "港股"), ("美股|纳斯达克", "美股"),
    ))

    def score(self, text: str) -> str:
        cat = next((c for p, c in self.categories if re.search(p, text)), sc.CATEGORY_DEFAULT)
        verdict = {"valuable": bool(re.search(self.valuable, text)), "cat": cat}
        return json.dumps(verdict, ensure_ascii=False)


# What ``open`` gave, by the scorer's pickled form: workers are used for many tasks.
_OPENED: dict[bytes, object] = {}


def _opened(scorer: Scorer):
    if not hasattr(scorer, "open"):
        return scorer
    key = pickle.dumps(scorer)
    if key not in _OPENED:
        _OPENED[key] = scorer.open()
    return _OPENED[key]


def _one(worker, text: str) -> tuple[str | None, str | None]:
    try:
        return (worker.score(text) if hasattr(worker, "score") else worker.score_batch([text])[0]), None
    except Exception as error:
        return None, f"{type(error).__name__}: {error}"


def _all(worker, texts: list[str]) -> list[tuple[str | None, str | None]]:
    """Reply and error of every text. A batch that fails is scored text by text."""
    if texts and hasattr(worker, "score_batch"):
        try:
            found = list(worker.score_batch(texts))
            if len(found) == len(texts):
                return [(reply, None) for reply in found]
        except Exception:
            pass
    return [_one(worker, text) for text in texts]


def replies(scorer: Scorer):
    """Arrow batches through the scorer: a reply, or the error of a row it fails on."""
    @F.pandas_udf("reply string, error string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        worker = _opened(scorer)
        for batch in batches:
            out = pd.DataFrame({"reply": None, "error": None}, index=batch.index, dtype=object)
            asked = batch.notna()
            found = _all(worker, batch[asked].tolist())
            out.loc[asked, "reply"] = pd.Series([r for r, _ in found], index=batch.index[asked], dtype=object)
            out.loc[asked, "error"] = pd.Series([e for _, e in found], index=batch.index[asked], dtype=object)
            yield out

    return run


def queue(statuses: DataFrame, limit: int | None = None) -> DataFrame:
    return take(statuses.filter(F.col("is_analyzed") == PENDING), ["status_id"], limit)


def long_enough(clean: Column, cfg: FlowConfig) -> Column:
    return F.coalesce(F.length(clean) >= cfg.min_text_length, F.lit(False))


def score_posts(pending: DataFrame, scorer: Scorer, cfg: FlowConfig) -> DataFrame:
    """Pending posts with status and, where they were scored, their verdict.

    Short and null texts are done without a verdict; only the others reach Python. ``error`` says
    why a post failed.
    """
    clean = sc.clean_text(F.col("description"))
    text = F.when(long_enough(clean, cfg), clean)
    scored = (
        pending.withColumn("__clean", text)
        .withColumn("__scored", replies(scorer)(F.col("__clean")))
        .withColumn("__reply", F.col("__scored.reply"))
    )
    valuable, category = sc.verdict_fields(F.col("__reply"))
    tried, good = F.col("__clean").isNotNull(), F.coalesce(vr.is_readable(F.col("__reply")), F.lit(False))
    return scored.select(
        *[c for c in pending.columns if c != "is_analyzed"],
        F.when(tried & ~good, FAILED).otherwise(DONE).alias("is_analyzed"),
        F.when(tried & good, valuable).alias("valuable"),
        F.when(tried & good, sc.value_label(valuable, category)).alias("category"),
        F.when(tried & ~good, F.coalesce("__scored.error", F.lit("reply is no JSON"))).alias("error"),
    )


def value_comments(scored: DataFrame) -> DataFrame:
    """Rows for the labelled table; the raw text is stored, not the cleaned one."""
    return scored.filter(F.col("category").isNotNull()).select(
        F.col("status_id").alias("comment_id"), "user_id",
        F.col("description").alias("content"), F.col("created_at").alias("publish_time"),
        F.col("stock_tags").alias("mentioned_stocks"), "category", "forward", "comment_count",
        "like_count",
    )


def status_rows(scored: DataFrame) -> DataFrame:
    return scored.select("status_id", "is_analyzed")
