"""HTTP with retries, over an injectable opener."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field

ATTEMPTS, TIMEOUT_S = 3, 15


@dataclass
class Answer:
    """What a server said."""

    status: int
    body: bytes = b""
    headers: dict[str, str] = field(default_factory=dict)

    def json(self) -> object:
        """The body as JSON."""
        return json.loads(self.body)


#: (url, headers, timeout) → answer; raises OSError when there is none.
Opener = Callable[[str, dict[str, str], float], Answer]


def open_url(url: str, headers: dict[str, str], timeout: float) -> Answer:
    """One GET by the standard library."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as got:  # noqa: S310
            return Answer(got.status, got.read(), {k.lower(): v for k, v in got.headers.items()})
    except urllib.error.HTTPError as error:
        return Answer(error.code, b"", {k.lower(): v for k, v in error.headers.items()})


#: (url, headers, body, timeout) → answer, whatever its status; raises OSError when there is none.
Poster = Callable[[str, dict[str, str], bytes, float], Answer]


def post_url(url: str, headers: dict[str, str], body: bytes, timeout: float) -> Answer:
    """One POST by the standard library."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, data=body, headers=headers, method="POST"), timeout=timeout) as got:  # noqa: S310
            return Answer(got.status, got.read(), {k.lower(): v for k, v in got.headers.items()})
    except urllib.error.HTTPError as error:
        return Answer(error.code, error.read(), {k.lower(): v for k, v in error.headers.items()})


def get_with_retry(
    url: str, params: dict | None = None, headers: dict[str, str] | None = None, attempts: int = ATTEMPTS, timeout: float = TIMEOUT_S,
    opener: Opener = open_url, sleep: Callable[[float], None] = time.sleep,
) -> Answer | None:
    """The answer with status 200, else None.

    No answer: waits 1.5 s times the attempt and tries again. 403 and 429: waits 3, 6, ... s; 500 and
    above: 2 s times the attempt; neither after the last attempt. Any other status ends it.
    """
    whole = f"{url}?{urllib.parse.urlencode(params)}" if params else url
    for n in range(attempts):
        last = n == attempts - 1
        try:
            answer = opener(whole, headers or {}, timeout)
        except OSError:
            sleep(1.5 * (n + 1))
            continue
        if answer.status == 200:
            return answer
        if last or (answer.status not in (403, 429) and answer.status < 500):
            return None
        sleep(3 * 2**n if answer.status in (403, 429) else 2 * (n + 1))
    return None
