"""From a log of fetch attempts to one response per URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagegraph.functions.text import is_html
from pagegraph.operators.counts import Counts, how_many, watched
from pagegraph.session import staged

# Retries unless told otherwise, and errors a retry may cure, which are
# timeouts and failed connections of every kind.
DEFAULT_RETRIES = 1
RETRYABLE_ERRORS = ("Timeout", "ConnectTimeout", "ReadTimeout", "ConnectionError", "ProxyError", "SSLError")


def is_success(status: Column) -> Column:
    return status.between(200, 299)


def is_server_error(status: Column) -> Column:
    return status.between(500, 599)


def usable_body(status: Column, content_type: Column, body: Column) -> Column:
    """Body of a successful HTML response, NULL for any other."""
    return F.when(is_success(status) & is_html(content_type), body)


def _unhandled(error: Column) -> Column:
    """Whether an error, named plainly or with its module, is none a retry may cure."""
    return F.coalesce(~F.substring_index(error, ".", -1).isin(*RETRYABLE_ERRORS), F.lit(False))


def _classified(attempts: DataFrame, retries: int) -> DataFrame:
    """Attempts within the retries, with ``ends``: no later attempt is looked at."""
    attempt, status = F.col("attempt"), F.col("status")
    retried = is_server_error(status) & (attempt < retries + 1)
    answered = F.col("error").isNull() & status.isNotNull()
    return attempts.filter(attempt <= retries + 1).select(
        "url",
        "attempt",
        answered.alias("answered"),
        ((answered & ~retried) | _unhandled(F.col("error"))).alias("ends"),
        status,
        F.col("final_url"),
        "error",
        "content_type",
        "body",
    )


def _verdicts(tried: DataFrame) -> DataFrame:
    """Per URL the attempt that ends it, if any, and the attempt that is reported:
    that one or else the last answered. Numbers only, so a hash aggregate."""
    attempt = F.col("attempt")
    verdicts = tried.groupBy("url").agg(
        F.min(F.when(F.col("ends"), attempt)).alias("end"),
        F.max(F.when(F.col("answered"), attempt)).alias("last"),
    )
    return verdicts.select("url", "end", F.coalesce("end", "last").alias("attempt"))


def quarantined_urls(attempts: DataFrame, retries: int = DEFAULT_RETRIES) -> DataFrame:
    """URLs that meet an error no retry can cure, with the attempt and the error."""
    tried = _classified(attempts, retries)
    refused = tried.filter(_unhandled(F.col("error"))).select("url", "attempt", "error")
    met = _verdicts(tried).select("url", "attempt")
    return refused.join(met, ["url", "attempt"], "left_semi").withColumnRenamed("url", "requested_url")


def resolve_attempts(
    attempts: DataFrame, retries: int = DEFAULT_RETRIES, on_error: str = "quarantine", counts: Counts | None = None
) -> DataFrame:
    """One response per URL: ``requested_url, status, final_url, html``.

    Attempts count up to the first answer that is not a server error with retries
    left; status and final URL are those of the last answer, 0 and the URL itself
    where none came. URLs that meet an error no retry can cure are left out
    (``quarantined_urls`` lists them, ``counts`` gets ``urls_refused`` in passing), or
    fail the job with ``on_error='fail'``.

    Nearly every URL is ended by its first attempt, so those go through without a
    shuffle of their bodies. Verdicts on the rest come from a grouping of attempt
    numbers and are joined only to attempts of another kind.
    """
    if on_error not in ("quarantine", "fail"):
        raise ValueError("on_error is 'quarantine' or 'fail'")
    if retries < 0:
        return attempts.select(F.col("url").alias("requested_url")).distinct().select(
            "requested_url",
            F.lit(0).alias("status"),
            F.col("requested_url").alias("final_url"),
            F.lit(None).cast("string").alias("html"),
        )
    tried = _classified(attempts, retries)
    outcomes = tried.withColumn("html", usable_body(F.col("status"), F.col("content_type"), F.col("body")))
    outcomes = outcomes.drop("content_type", "body")
    first_ended = (F.col("attempt") == 1) & F.col("ends")
    unended = _verdicts(tried).filter(F.coalesce(F.col("end") > 1, F.lit(True))).select("url", "attempt")
    later = staged(unended, "verdicts").join(outcomes.filter(~first_ended), ["url", "attempt"], "left")
    columns = ("url", "status", "final_url", "error", "html")
    resolved = outcomes.filter(first_ended).select(*columns).unionByName(later.select(*columns))
    refused = _unhandled(F.col("error"))
    resolved = watched(resolved, counts, urls_refused=how_many(refused))
    if on_error == "fail":
        message = F.concat(F.lit("unhandled fetch error: "), F.col("error"))
        # A condition on rows, unlike a column, is worked out whatever is read of the result.
        resolved = resolved.filter(F.when(refused, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    else:
        resolved = resolved.filter(~refused)
    return resolved.select(
        F.col("url").alias("requested_url"),
        F.coalesce(F.col("status"), F.lit(0)).alias("status"),
        F.coalesce(F.col("final_url"), F.col("url")).alias("final_url"),
        "html",
    )
