"""What is asked of the remote sources, and how their answers become pages; the transport is injected.

A transport is ``send(method, url, params) -> (status, headers, body)``; it raises ``RemoteError`` without a
status where no answer came.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable

from quillmill.sources.paged import RemoteError, parse_feed, with_retries

Send = Callable[[str, str, dict[str, str]], tuple[int, dict[str, str], str]]
# Addresses and identifiers of the public services.
FEED_URL = "https://export.arxiv.org/api/query"
WORKS_URL = "https://api.openalex.org/works"
SOURCE_ID = "S4306400194"
FIELD_ID = "fields/17"


def answered(answer: tuple[int, dict[str, str], str]) -> str:
    """The body of a good answer; any other raises its status and how long the server wants to wait."""
    status, headers, body = answer
    if status == 200:
        return body
    try:
        wait = max(0.0, float(headers.get("retry-after") or 0))
    except ValueError:
        wait = 0.0
    raise RemoteError(status, wait)


def feed_request(categories: Iterable[str], start: int = 0, size: int = 100) -> dict[str, str]:
    """Parameters for the newest papers of some categories."""
    return {"search_query": " OR ".join(f"cat:{c}" for c in categories), "start": str(start), "max_results": str(size), "sortBy": "submittedDate", "sortOrder": "descending"}


def feed_page(send: Send, categories: Iterable[str], start: int = 0, size: int = 100, sleep: Callable[[float], None] = time.sleep) -> list[tuple]:
    """Entries of one feed page; overload, server and transport errors are tried again."""
    params = feed_request(categories, start, size)
    return parse_feed(with_retries(lambda: answered(send("GET", FEED_URL, params)), sleep=sleep))


def works_request(cursor: str = "*", size: int = 100, least_citations: int = 21, mail: str | None = None) -> dict[str, str]:
    """Parameters for works of the field and source with enough citations, newest first."""
    wanted = [f"locations.source.id:{SOURCE_ID}", f"cited_by_count:>{least_citations - 1}", f"topics.field.id:{FIELD_ID}"]
    return {"filter": ",".join(wanted), "sort": "publication_date:desc", "per-page": str(size), "cursor": cursor} | ({"mailto": mail} if mail else {})


def works_page(send: Send, cursor: str = "*", size: int = 100, least_citations: int = 21, mail: str | None = None) -> tuple[list[tuple[str]], str | None]:
    """A page of works as JSON texts, and the next cursor: what ``paged.PagedSource`` reads."""
    payload = json.loads(answered(send("GET", WORKS_URL, works_request(cursor, size, least_citations, mail))))
    return [(json.dumps(w, ensure_ascii=False),) for w in payload.get("results") or []], (payload.get("meta") or {}).get("next_cursor")


def found_works(send: Send, base_id: str, title: str | None = None, mail: str | None = None) -> list[tuple[str, int, str]]:
    """``arxiv_base_id, position, work`` of each search result for a paper's title, or else its id."""
    params = {"search": title or base_id} | ({"mailto": mail} if mail else {})
    results = json.loads(answered(send("GET", WORKS_URL, params))).get("results") or []
    return [(base_id, k, json.dumps(w, ensure_ascii=False)) for k, w in enumerate(results)]


def page_probe(send: Send) -> Callable[[str], tuple[int, str]]:
    """Status and type of a page, for ``usable_pages``: by HEAD, or by GET where that is not allowed."""

    def probe(url: str) -> tuple[int, str]:
        status, headers, _ = send("HEAD", url, {})
        if status == 405:
            status, headers, _ = send("GET", url, {})
        return status, headers.get("content-type", "")

    return probe


def any_status_retried(call: Callable[[], str], attempts: int = 5, base: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> str:
    """The comparison's rule: every failed call is tried again, but a payload that is no text never is."""
    for attempt in range(1, attempts + 1):
        try:
            return call()
        except RemoteError as error:
            if attempt == attempts:
                raise
            sleep(max(error.retry_after, base * 2 ** (attempt - 1)))
    raise ValueError("at least one attempt is needed")
