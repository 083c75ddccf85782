"""Time-limited links to objects: query signatures of version 4 (HMAC-SHA256), made in batches by the tasks.

A link is a pure function of key, credentials and time, so no service is asked and a repeated
task makes the same one. The secret goes to the tasks with the function and into no column.
"""

from __future__ import annotations

import hashlib
import hmac
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TTL_S, LONGEST_S = 3_600, 604_800
ALGORITHM = "AWS4-HMAC-SHA256"


@dataclass(frozen=True)
class Credentials:
    access_key: str
    secret: str = field(repr=False)
    region: str = "ap-southeast-2"
    token: str = field(default="", repr=False)


def _hmac(key: bytes, text: str) -> bytes:
    return hmac.new(key, text.encode(), hashlib.sha256).digest()


def link(host: str, key: str, who: Credentials, at: str, ttl: int, signing: bytes) -> str:
    """The link to one object at a time (YYYYMMDDTHHMMSSZ), signed by a day's key."""
    scope, path = f"{at[:8]}/{who.region}/s3/aws4_request", "/" + quote(key, safe="/-_.~")
    asked = {"X-Amz-Algorithm": ALGORITHM, "X-Amz-Credential": f"{who.access_key}/{scope}", "X-Amz-Date": at, "X-Amz-Expires": str(ttl), "X-Amz-SignedHeaders": "host"}
    if who.token:
        asked["X-Amz-Security-Token"] = who.token
    query = "&".join(f"{quote(k, safe='-_.~')}={quote(v, safe='-_.~')}" for k, v in sorted(asked.items()))
    request = "\n".join(["GET", path, query, f"host:{host}", "", "host", "UNSIGNED-PAYLOAD"])
    text = "\n".join([ALGORITHM, at, scope, hashlib.sha256(request.encode()).hexdigest()])
    return f"https://{host}{path}?{query}&X-Amz-Signature={_hmac(signing, text).hex()}"


def links(key: Column, bucket: str, who: Credentials, ttl: int = TTL_S, at: datetime | None = None, host: str | None = None) -> Column:
    """A link for each key of a bucket, good for ttl seconds from `at` (now, unless given: fixed when the plan is made). Null for a null key."""
    if not 0 < ttl <= LONGEST_S:
        raise ValueError(f"a link lasts 1 to {LONGEST_S} seconds")
    if not who.access_key or not who.secret:
        raise ValueError("links need credentials")
    stamp, where = (at or datetime.now(UTC)).astimezone(UTC).strftime("%Y%m%dT%H%M%SZ"), host or f"{bucket}.s3.{who.region}.amazonaws.com"
    signing = ("AWS4" + who.secret).encode()
    for part in (stamp[:8], who.region, "s3", "aws4_request"):
        signing = _hmac(signing, part)
    public = Credentials(who.access_key, "", who.region, who.token)  # a day's key is enough for the tasks

    @F.pandas_udf("string")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield keys.map(lambda k: None if k is None else link(where, k, public, stamp, ttl, signing))

    return made(key)


def with_links(manifest: DataFrame, bucket: str, who: Credentials, **options) -> DataFrame:
    """manifest (key) with `url`."""
    return manifest.withColumn("url", links(F.col("key"), bucket, who, **options))
