"""What remote calls return: error classes, delays, and the text of nested responses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmill.functions.text import SPACES


def classify_error(status: Column, timed_out: Column) -> Column:
    """``permanent``, ``retryable`` or ``fatal``, for an HTTP status or a transport failure."""
    return F.when(status.isin(404, 406), "permanent").when((status == 429) | (status >= 500), "retryable").when(status.isNotNull(), "fatal").when(F.coalesce(timed_out, F.lit(False)), "retryable").otherwise("fatal")


def retry_after(header: Column) -> Column:
    return F.greatest(F.lit(0.0), F.coalesce(header.try_cast("double"), F.lit(0.0)))


def backoff(base: Column, attempt: Column) -> Column:
    return base * F.pow(F.lit(2.0), attempt - 1)


def strip(text: Column) -> Column:
    """Without white space at the ends, as ``str.strip`` sees it."""
    return F.regexp_replace(text, f"^{SPACES}+|{SPACES}+$", "")


#: Schema of a response: ``content`` is read as its JSON text, since it is a list of parts or plain text.
RESPONSE = "output_text string, output array<struct<content: string>>"


def response_text(response: Column) -> Column:
    """``output_text`` where given, or the texts of ``output[].content`` joined by newlines.

    A content is a list of parts with a ``text``, or the text itself.  Null means that there is no
    text, which callers treat as a retryable error.
    """

    def texts(content: Column) -> Column:
        parts = F.from_json(F.when(content.startswith("["), content), "array<struct<text: string>>")
        return F.coalesce(F.transform(parts, lambda c: strip(c["text"])), F.array(strip(content)))

    parts = F.flatten(F.transform(F.coalesce(response["output"], F.array()), lambda o: texts(o["content"])))
    joined = F.array_join(F.filter(parts, lambda t: F.coalesce(t, F.lit("")) != ""), "\n")
    return F.coalesce(strip(response["output_text"]), F.nullif(joined, F.lit("")))
