"""Run parameters, in one place so that every plan takes them as an argument."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class FlowConfig:
    # The thresholds and quotas the results depend on. None means no bound.
    post_quota: int | None = 20     # posts per user and visit, page-granular
    user_cap: int | None = 30       # expansion stops at this many known users
    target_goal: int | None = 5     # the run stops at this many targets
    batch_size: int | None = 1      # users per step, and new high-quality users per source
    backlog_factor: int = 5         # expansion waits at batch_size * backlog_factor pending
    cache_days: int = 21            # a finished user is due again after this
    portfolio_cache_hours: int = 3  # a portfolio's detail is fresh for this long
    min_followers: int = 5000       # strictly more than this
    min_statuses: int = 20          # strictly more than this
    page_cap: int | None = 21       # follow pages read per source
    min_text_length: int = 10       # shorter cleaned posts are not scored

    # Portfolio updates: 'overwrite' lets an absent value replace a stored one, 'keep' does not.
    on_null: str = "overwrite"
