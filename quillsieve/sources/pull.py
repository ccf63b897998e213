"""A Spark data source over a paged HTTP interface: one row a record, pages followed by their tokens.

A feed's pages form a chain, so a feed is one task; several feeds are pulled at once. A page is a JSON object of
``records`` and ``metadata`` (record_count, page_token, next_page_token, high_water_mark), and is checked as such before
any of its rows is given. A token that comes a second time, too many pages or records, or a body beyond the size limit
ends the task with an error. Answers 429 and 5xx and failed connections are tried again, with growing pauses or the pause
that the server asks for.

    spark.dataSource.register(Pages)
    spark.read.format("pages").option("url", ...).option("feeds", "eligibility,medical-claims").load()
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from urllib.error import HTTPError, URLError
from urllib.parse import urlencode
from urllib.request import Request, urlopen

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "feed string, page_number int, position int, payload string, page_token string, next_page_token string, high_water_mark string"
# Bounds of a pull, where the caller sets none.
LIMITS = {"most_pages": 10_000, "most_records": 2_000_000, "most_bytes": 64 * 1024 * 1024, "page_size": 1000, "tries": 4}
LONGEST_PAUSE = 60.0


class PageError(Exception):
    """A page that breaks a rule, or a pull beyond its limits."""


def page_problem(page: object, requested: str | None) -> str | None:
    """The first rule that a decoded page breaks; None for a valid one."""
    if not isinstance(page, dict) or not isinstance(page.get("records"), list):
        return "records_not_an_array"
    if not all(isinstance(r, dict) for r in page["records"]):
        return "record_not_an_object"
    meta = page.get("metadata") if isinstance(page.get("metadata"), dict) else {}
    count, following, mark = meta.get("record_count"), meta.get("next_page_token"), meta.get("high_water_mark")
    if not isinstance(count, int) or isinstance(count, bool) or count < 0:
        return "bad_record_count"
    if count != len(page["records"]):
        return "record_count_differs"
    if (meta.get("page_token") or "") != (requested or ""):
        return "page_token_differs"
    if following is not None and not (isinstance(following, str) and following):
        return "bad_next_page_token"
    return None if isinstance(mark, str) and mark else "bad_high_water_mark"


def fetched(url: str, limits: dict[str, int], token: str | None, sleep=time.sleep) -> object:
    """The decoded JSON body of ``url``."""
    headers = {"Accept": "application/json"} | ({"Authorization": f"Bearer {token}"} if token else {})
    for turn in range(limits["tries"]):
        pause = min(LONGEST_PAUSE, 0.5 * 2**turn)
        try:
            with urlopen(Request(url, headers=headers), timeout=60) as answer:
                if answer.headers.get_content_type() != "application/json":
                    raise PageError(f"the answer is of type {answer.headers.get_content_type()}")
                body = answer.read(limits["most_bytes"] + 1)
            if len(body) > limits["most_bytes"]:
                raise PageError(f"the page is over {limits['most_bytes']} bytes")
            return json.loads(body)
        except HTTPError as e:
            if e.code != 429 and e.code < 500 or turn + 1 == limits["tries"]:
                raise PageError(f"the server answers {e.code}") from None
            asked = e.headers.get("Retry-After", "")
            pause = min(LONGEST_PAUSE, float(asked)) if asked.isdigit() else pause
        except URLError as e:
            if turn + 1 == limits["tries"]:
                raise PageError(f"no connection: {e.reason}") from None
        except ValueError:
            raise PageError("the page is no JSON") from None
        sleep(pause)
    raise PageError("no try is left")


class Pages(DataSource):
    """Options: url, feeds (separated by commas), since, token, and those of ``LIMITS``."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = {k.lower(): v for k, v in options.items()}
        self.limits = {k: int(self.options.get(k, v)) for k, v in LIMITS.items()}
        missing = [k for k in ("url", "feeds") if not self.options.get(k)]
        if missing or min(self.limits.values()) <= 0:
            raise ValueError(f"missing: {', '.join(missing) or 'none'}; limits must be positive")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(f.strip()) for f in self.options["feeds"].split(",")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        feed, token, seen, records = partition.value, None, set(), 0
        for number in range(1, self.limits["most_pages"] + 1):
            asked = {"page_size": self.limits["page_size"]} | ({"since": self.options["since"]} if self.options.get("since") else {}) | ({"page_token": token} if token else {})
            page = fetched(f"{self.options['url'].rstrip('/')}/{feed}?{urlencode(asked)}", self.limits, self.options.get("token"))
            if problem := page_problem(page, token):
                raise PageError(f"{feed}, page {number}: {problem}")
            meta, seen = page["metadata"], seen | {token}
            records += len(page["records"])
            if records > self.limits["most_records"]:
                raise PageError(f"{feed}: over {self.limits['most_records']} records")
            for i, r in enumerate(page["records"], 1):
                yield feed, number, i, json.dumps(r, sort_keys=True, ensure_ascii=False), token, meta["next_page_token"], meta["high_water_mark"]
            token = meta["next_page_token"]
            if token is None:
                return
            if token in seen:
                raise PageError(f"{feed}: token {token!r} comes a second time")
        raise PageError(f"{feed}: over {self.limits['most_pages']} pages")
