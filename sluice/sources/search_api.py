"""Paged searches as a data source: one partition for each page, or for each keyword where a page says which one is next."""

from __future__ import annotations

import json
import math
import random
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RETRY_STATUS, RETRIES, RETRY_AFTER = 429, 3, 60
#: Attempts at a request that fails, and seconds before the second.
ATTEMPTS, DELAY = 3, 1.0
#: Addresses that a full page lists, and the mark of a page that has a next one.
FULL_PAGE, NEXT_MARK = 10, "pg="


def with_retry(call: Callable[[], object], retries: int = 3, delay: float = 1.0, jitter: Callable[[], float] = lambda: 0.0, sleep: Callable[[float], None] = time.sleep):
    """The call's result, after up to ``retries`` attempts with doubling waits; the last error is raised."""
    for attempt in range(retries):
        try:
            return call()
        except Exception:
            if attempt == retries - 1:
                raise
            sleep(delay * 2**attempt + jitter())
    return None


class Gate:
    """At most so many requests in any window of a process: waits before each until one may go. A limit of 0 lets all go."""

    def __init__(self, limit: int, seconds: float = 3600, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.limit, self.seconds, self.clock, self.sleep = limit, seconds, clock, sleep
        self.went: list[float] = []

    def wait(self) -> None:
        if not self.limit:
            return
        if len(self.went) >= self.limit:
            left = self.went[-self.limit] + self.seconds - self.clock()
            if left > 0:
                self.sleep(left)
        self.went = [*self.went[-self.limit + 1 :], self.clock()] if self.limit > 1 else [self.clock()]


@dataclass(frozen=True)
class Schedule:
    """When the requests of a read may go, fixed as it is planned, so that tasks that don't know of each other keep one limit.

    Every attempt at every request has a place of its own, attempt j at request n
    place n + j * requests, and place p belongs to turn p // limit. A turn begins
    every window and ``slack`` seconds and lasts for ``slack``: what goes in a
    turn is no more than the limit, and two turns are never in one window. A
    request that comes too late for its turn, or is made again, takes its next
    place. A limit of 0 lets all go. Clocks must agree to well within the slack.
    """

    limit: int
    seconds: float
    requests: int
    start: float
    slack: float

    def turn(self, request: int, attempt: int) -> float:
        """When the turn of an attempt begins."""
        return self.start + (request + attempt * self.requests) // self.limit * (self.seconds + self.slack)

    def attempt(self, request: int, now: float) -> int:
        """The first attempt at a request whose turn isn't over."""
        first = max(0, math.floor((now - self.slack - self.start) / (self.seconds + self.slack)) + 1)
        return max(0, -(-(first * self.limit - request) // self.requests))


class Turns:
    """The gate of one request and its repetitions: waits before each for a turn of its own."""

    def __init__(self, schedule: Schedule, request: int, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep):
        self.schedule, self.request, self.clock, self.sleep = schedule, request, clock, sleep
        self.used = -1

    def wait(self) -> None:
        if not self.schedule.limit:
            return
        while True:
            now = self.clock()
            self.used = max(self.used + 1, self.schedule.attempt(self.request, now))
            left = self.schedule.turn(self.request, self.used) - now
            if left <= 0:
                return
            self.sleep(left)
            # a sleep may end late, but not too late
            if self.clock() < self.schedule.turn(self.request, self.used) + self.schedule.slack:
                return


class Failed(Exception):
    """A request without an answer: the status, 0 for none at all."""

    def __init__(self, status: int):
        super().__init__(status)
        self.status = status


def _answer(url: str, timeout: float, sleep: Callable[[float], None], headers: dict[str, str], gate: Gate | Turns | None) -> tuple[bytes, str]:
    """Body and MIME type. Waits as told when the quota is used up."""
    for _ in range(RETRIES + 1):
        if gate:
            gate.wait()
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as answer:
                return answer.read(), answer.headers.get_content_type()
        except urllib.error.HTTPError as error:
            if error.code != RETRY_STATUS:
                raise Failed(error.code) from error
            sleep(float(error.headers.get("Retry-After") or RETRY_AFTER))
        except (urllib.error.URLError, OSError) as error:
            raise Failed(0) from error
    raise Failed(RETRY_STATUS)


def _persistent(url: str, timeout: float, sleep: Callable[[float], None], headers: dict[str, str], gate: Gate | Turns | None, retries: int, delay: float) -> tuple[bytes | None, str, int | None]:
    """Body, MIME type and, where there is no body after all attempts, why. A file that isn't there won't be there the next time."""
    if url.startswith("file:"):
        retries = 1
    try:
        body, mime = with_retry(lambda: _answer(url, timeout, sleep, headers, gate), retries, delay, random.random, sleep)
        return body, mime, None
    except Failed as error:
        return None, "", error.status


def fetch(url: str, timeout: float = 30, sleep: Callable[[float], None] = time.sleep, headers: dict[str, str] | None = None, gate: Gate | Turns | None = None, retries: int = ATTEMPTS, delay: float = DELAY) -> tuple[str | None, int | None]:
    """A page's body, or None and why: the status, 0 for no answer. Failures are tried again, with doubling waits and a part of a second by chance."""
    body, _, status = _persistent(url, timeout, sleep, headers or {}, gate, retries, delay)
    return (None, status) if body is None else (body.decode("utf-8", "replace"), None)


def fetch_bytes(url: str, timeout: float = 30, retries: int = ATTEMPTS, delay: float = DELAY) -> tuple[bytes, str] | None:
    """A file's bytes and MIME type; None if it can't be had."""
    body, mime, _ = _persistent(url, timeout, time.sleep, {}, None, retries, delay)
    return None if body is None else (body, mime)


class Pages(InputPartition):
    """A keyword's pages from first up to last, read one after the other; the first is a request of the schedule, the next ones follow it by ``step``."""

    def __init__(self, keyword: str, first: int, last: int, request: int = 0, step: int = 1, schedule: Schedule | None = None):
        super().__init__((keyword, first, last))
        self.keyword, self.first, self.last = keyword, first, last
        self.request, self.step, self.schedule = request, step, schedule


class SearchReader(DataSourceReader):
    def __init__(self, options: dict, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep):
        self.options, self.clock, self.sleep = options, clock, sleep

    def partitions(self) -> list[Pages]:
        words, last = json.loads(self.options["keywords"]), int(self.options.get("pages", 1))
        seconds = float(self.options.get("seconds", 3600))
        limit, requests = int(self.options.get("limit", 0)), len(words) * last
        # all in one turn may take a window for it; where turns follow each other, a tenth of one is lost to each
        slack = float(self.options.get("slack", seconds if requests <= limit else seconds / 10))
        schedule = Schedule(limit, seconds, requests, self.clock(), slack)
        if self.options.get("paging", "numbered") == "numbered":
            pages = [(w, p) for w in words for p in range(1, last + 1)]
            return [Pages(w, p, p, n, 1, schedule) for n, (w, p) in enumerate(pages)]
        return [Pages(w, 1, last, n, len(words), schedule) for n, w in enumerate(words)]

    def read(self, part: Pages) -> Iterator[tuple]:
        how = self.options.get("paging", "numbered")
        agents = json.loads(self.options.get("agents", "[]"))
        headers = json.loads(self.options.get("headers", "{}"))
        retries, delay = int(self.options.get("attempts", ATTEMPTS)), float(self.options.get("delay", DELAY))
        token = ""
        for page in range(part.first, part.last + 1):
            if agents:
                headers["User-Agent"] = random.Random(f"{part.keyword} {page}").choice(agents)
            url = self.options["template"].format(keyword=urllib.parse.quote(part.keyword), page=page, token=urllib.parse.quote(token))
            gate = part.schedule and Turns(part.schedule, part.request + (page - part.first) * part.step, self.clock, self.sleep)
            body, status = fetch(url, sleep=self.sleep, headers=headers, gate=gate, retries=retries, delay=delay)
            yield part.keyword, page, body, status
            if body is None or how == "until_short" and not self.goes_on(body):
                return
            if how == "cursor":
                token = self.next_token(body)
                if not token:
                    return

    def next_token(self, body: str) -> str:
        """What the body says to ask for next, by the option ``cursor``: keys from the outside in, as in continue.gsroffset."""
        try:
            found = json.loads(body)
        except ValueError:
            return ""
        for key in self.options.get("cursor", "continue").split("."):
            found = found.get(key) if isinstance(found, dict) else None
        return "" if found is None else str(found)

    def goes_on(self, body: str) -> bool:
        """Whether a result page is full and has a next one."""
        return NEXT_MARK in body and len(re.findall(self.options.get("listed", r"<a\b[^>]*\bhref="), body)) >= FULL_PAGE


class SearchSource(DataSource):
    """Pages of searches: (keyword, page, body, status), status being why there is no body.

    Options: template (an address with {keyword}, {page} and {token}; file: addresses are fixtures), keywords (a JSON list; categories
    are keywords of another template), pages (the most of a keyword), paging (numbered: all at once; cursor: as each page says, by
    ``cursor``; until_short: until a page isn't full or links no next one, by ``listed``, what marks an address; all: every page in
    turn), limit, seconds and slack (at most so many requests of all partitions in any window, by a schedule in whose turns a request
    may be so late), attempts and delay (of a failed request), headers (a JSON object, for keys), agents (a JSON list).
    """

    @classmethod
    def name(cls) -> str:
        return "search_api"

    def schema(self) -> str:
        return "keyword string, page int, body string, status int"

    def reader(self, schema) -> SearchReader:
        return SearchReader(self.options)
