"""Outcomes of page and file fetches, as column expressions over a fetch log."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def page_of(status: Column, html: Column, strategy: str = "local") -> Column:
    """The page that a fetch gives: a local fetch takes 404 for an empty page, proxies for none; other failures give null."""
    missing = F.lit("") if strategy == "local" else F.lit(None).cast("string")
    return F.when(status == 200, html).when(status == 404, missing)


def outcome(status: Column, attempt: Column, retries: int = 3) -> Column:
    """ok, retry (refused, but attempts are left), blocked (refused too often) or failed."""
    refused = status.isin(401, 403)
    return F.when(status == 200, "ok").when(refused & (attempt <= retries), "retry").when(refused, "blocked").otherwise("failed")


def backoff_seconds(attempt: Column, base: float = 5.0) -> Column:
    """Exponential delay before the next attempt; the first waits `base`."""
    return F.lit(base) * F.pow(F.lit(2.0), attempt - 1)


def is_retryable(status: Column) -> Column:
    """Downloads are tried again when throttled or on a server's error."""
    return (status == 429) | (status >= 500)


def wait_seconds(told: Column, attempt: Column, base: float = 1.0, most: float = 60.0) -> Column:
    """The server's own delay where it gives one, else an exponential one up to `most`."""
    return F.coalesce(told, F.least(F.lit(base) * F.pow(F.lit(2.0), attempt - 1), F.lit(most)))
