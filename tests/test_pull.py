"""Pulling pages from a server in this process, with all that can go wrong."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from quillsieve.sources import pull


def page(records, token=None, following=None, **meta):
    return {"records": records, "metadata": {"record_count": len(records), "page_token": token, "next_page_token": following, "high_water_mark": "w"} | meta}


class Handler(BaseHTTPRequestHandler):
    failed: set = set()

    def do_GET(self):
        at = urlparse(self.path)
        asked = {k: v[0] for k, v in parse_qs(at.query).items()}
        feed, token = at.path.strip("/"), asked.get("page_token")
        if feed == "shaky" and token not in Handler.failed:
            Handler.failed.add(token)
            self.send_response(503)
            self.send_header("Retry-After", "0")
            self.end_headers()
            return
        number = int(token or 0)
        body = page([{"b": number, "a": "é", "since": asked.get("since")}, {"x": None}], token, str(number + 1) if number < 2 else None)
        body |= {"cycle": page([{}], token, "7"), "short": page([{}], token, record_count=2), "denied": {}}.get(feed, {})
        self.send_response(403 if feed == "denied" else 200)
        self.send_header("Content-Type", "text/html" if feed == "html" else "application/json")
        self.end_headers()
        self.wfile.write(b"{" if feed == "broken" else json.dumps(body).encode())

    def log_message(self, *_):
        pass


@pytest.fixture(scope="module")
def url():
    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_pages_are_followed_and_tried_again(spark, url):
    spark.dataSource.register(pull.Pages)
    rows = spark.read.format("pages").option("url", url).option("feeds", "good, shaky").option("since", "2025-01-01").load().collect()
    assert sorted((r.feed, r.page_number, r.position) for r in rows) == [(f, p, i) for f in ("good", "shaky") for p in (1, 2, 3) for i in (1, 2)]
    first = next(r for r in rows if (r.feed, r.page_number, r.position) == ("good", 2, 1))
    assert (first.payload, first.page_token, first.next_page_token, first.high_water_mark) == ('{"a": "é", "b": 1, "since": "2025-01-01"}', "1", "2", "w")


@pytest.mark.parametrize("feed, options, said", [("cycle", {}, "second time"), ("short", {}, "record_count_differs"), ("denied", {}, "403"), ("html", {}, "text/html"), ("broken", {}, "no JSON"), ("good", {"most_pages": 2}, "over 2 pages"), ("good", {"most_records": 3}, "over 3 records"), ("good", {"most_bytes": 10}, "over 10 bytes")])
def test_what_ends_a_pull(url, feed, options, said):
    reader = pull._Reader({"url": url, "feeds": feed} | {k: str(v) for k, v in options.items()})
    with pytest.raises(pull.PageError, match=said):
        list(reader.read(reader.partitions()[0]))


def test_no_server_and_no_options():
    with pytest.raises(pull.PageError, match="no connection"):
        pull.fetched("http://127.0.0.1:9/x", pull.LIMITS | {"tries": 2}, "t", sleep=lambda _: None)
    with pytest.raises(ValueError):
        pull._Reader({"url": "http://h"})


@pytest.mark.parametrize("body, want", [([], "records_not_an_array"), ({"records": [1]}, "record_not_an_object"), ({"records": []}, "bad_record_count"), (page([], record_count=True), "bad_record_count"), (page([], "t"), "page_token_differs"), (page([], None, ""), "bad_next_page_token"), (page([], high_water_mark=None), "bad_high_water_mark"), (page([{}]), None)])
def test_rules_of_a_page(body, want):
    assert pull.page_problem(body, None) == want
