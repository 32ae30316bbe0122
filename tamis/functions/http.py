"""What became of a request, out of its status, error code and message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def failure_kind(status: Column, code: Column, message: Column) -> Column:
    """The first class that fits: the status decides before the error code, and that before the message. Null status is 0."""
    s, c, m = F.coalesce(status, F.lit(0)), F.upper(F.coalesce(code, F.lit(""))), F.lower(F.coalesce(message, F.lit("")))
    by_status = F.when(s == 403, "blocked").when(s == 404, "stale_or_missing_url").when(s == 429, "rate_limited").when(s.isin(402, 409), "http_state").when(s >= 500, "transient_http")
    by_error = (
        F.when(c.isin("ENOTFOUND", "EAI_AGAIN") | m.rlike("getaddrinfo|enotfound|name or service"), "dns").when(m.rlike("certificate|ssl|tls"), "tls_certificate")
        .when((c == "ECONNABORTED") | m.contains("timeout"), "timeout").when((c == "ERR_FR_TOO_MANY_REDIRECTS") | m.contains("redirect"), "redirect_loop")
    )
    return F.coalesce(by_status, by_error, F.when(s == 0, F.lit("network")).otherwise("unknown"))


def retryable(status: Column) -> Column:
    """Whether a request may be tried again: no answer, refused, too many, or an error of the server."""
    s = F.coalesce(status, F.lit(0))
    return s.isin(0, 403, 429) | (s >= 500)
