"""Crawl logs: outcomes, fetch states, challenges, redirects and robots verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlsift import constants as K
from urlsift.functions.hosts import resolve
from urlsift.functions.text import LINE_BREAK, contains_any, strip
from urlsift.operators.admission import admission_reason
from urlsift.runtime import small, written


def is_challenge(html: Column, title: Column | None = None) -> Column:
    """Whether the head of the page carries a challenge marker (the rule reads the first
    4096 characters only)."""
    head = F.left(F.coalesce(html, F.lit("")), F.lit(K.CHALLENGE_HEAD))
    text = head if title is None else F.concat_ws(" ", F.coalesce(title, F.lit("")), head)
    return contains_any(F.lower(text), K.CHALLENGE_MARKERS)


def media_type(content_type: Column) -> Column:
    return F.lower(strip(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1)))


def crawl_outcome(
    *, attempt: Column, status: Column, location: Column, hops: Column, content_type: Column,
    n_bytes: Column, html: Column, max_bytes: int = K.MAX_BYTES, max_redirects: int = K.MAX_REDIRECTS,
) -> Column:
    """Why an attempt ended as it did.

    ``attempt`` is what happened before a response: NULL, or one of disabled,
    rate_limited, dns_fail, blocked_by_policy, timeout, connection_error.
    """
    redirect = status.isin(list(K.REDIRECT_STATUS))
    kind = media_type(content_type)
    early = attempt.isin("disabled", "rate_limited", "dns_fail", "blocked_by_policy", "timeout")
    return (
        F.when(early, attempt)
        .when(attempt == "connection_error", "http_error")
        .when(redirect & (F.coalesce(location, F.lit("")) == ""), "http_error")
        .when(redirect | (hops > max_redirects), "blocked_by_policy")
        .when(status >= 400, "http_error")
        .when((kind != "") & ~kind.isin(list(K.ALLOWED_TYPES)), "unsupported_type")
        .when(n_bytes > max_bytes, "too_large")
        .when(is_challenge(html), "challenge_detected")
        .otherwise("ok")
    )


def fetch_state(outcome: Column) -> Column:
    return F.when(outcome == "ok", "scraped").when(outcome == "challenge_detected", "challenged").otherwise("unreachable")


def outcome_counts(attempts: DataFrame, outcome: str = "outcome") -> DataFrame:
    return attempts.groupBy(outcome).agg(F.count("*").alias("n"))


def follow_redirects(
    starts: DataFrame, hops: DataFrame, *, key: str, url: str = "url", deny=(),
    max_redirects: int = K.MAX_REDIRECTS,
) -> DataFrame:
    """Key, final URL, the hops left behind, and the reason a chain was cut, if any.

    ``hops`` has url and location, one row per redirecting URL. A chain
    has at most ``max_redirects`` + 1 steps, so the lookups are unrolled. Every hop
    is admitted anew. Of several locations of one URL the first in order counts. The hop table is
    measured once and broadcast while small.
    """
    table = hops.select(F.col("url").alias("_at"), F.col("location").alias("_next"))
    table = small(written(table.groupBy("_at").agg(F.min("_next").alias("_next")), "hops"))
    walk = starts.select(
        key, F.col(url).alias("_at"), F.array().cast("array<string>").alias("chain"),
        admission_reason(F.col(url), deny).alias("reason"),
    )
    for step in range(max_redirects + 1):
        walk = walk.join(table, ["_at"], "left")
        walk = walk.withColumn("_next", resolve(F.col("_at"), F.col("_next")))
        moves = F.col("reason").isNull() & F.col("_next").isNotNull()
        broken = F.when(F.lit(step == max_redirects), F.lit("too_many_redirects")).otherwise(
            admission_reason(F.col("_next"), deny)
        )
        walk = walk.select(
            key,
            F.when(moves, F.col("_next")).otherwise(F.col("_at")).alias("_at"),
            F.when(moves, F.array_append("chain", F.col("_at"))).otherwise(F.col("chain")).alias("chain"),
            F.when(moves, broken).otherwise(F.col("reason")).alias("reason"),
        )
    return walk.select(key, F.col("_at").alias("final_url"), "chain", "reason")


def blanket_disallow(robots: Column) -> Column:
    """Whether the group for every agent holds a bare ``Disallow: /``.

    A fold over the lines of one file; no file leaves its row.
    """
    lines = F.split(robots, LINE_BREAK)

    def field(line):
        bare = F.substring_index(line, "#", 1)
        name = F.lower(strip(F.substring_index(bare, ":", 1)))
        value = strip(F.substring(bare, F.instr(bare, ":") + 1, F.length(bare)))
        known = F.instr(bare, ":") > 0
        return F.struct(F.when(known, name).alias("name"), value.alias("value"))

    def step(state, f):
        agent = f["name"] == "user-agent"
        return F.struct(
            F.when(agent, f["value"] == "*").otherwise(state["star"]).alias("star"),
            (state["found"] | F.coalesce((f["name"] == "disallow") & state["star"] & (f["value"] == "/"), F.lit(False))).alias("found"),
        )

    start = F.struct(F.lit(False).alias("star"), F.lit(False).alias("found"))
    return F.aggregate(F.transform(lines, field), start, step, lambda s: s["found"])


def robots_allowed(robots: Column) -> Column:
    """0 on a blanket disallow, 1 otherwise, NULL without a robots text."""
    return F.when(robots.isNotNull(), F.when(blanket_disallow(robots), 0).otherwise(1))
