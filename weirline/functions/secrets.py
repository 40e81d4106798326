"""Masks for credentials, and what object-store endpoints tell."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import ConfigError

HIDDEN = "******"
_OPTION = re.compile(r"""(access_key_id|secret_access_key)(\s*=['"\s]*)([^,'"\s]*)""", re.IGNORECASE)
_WORD = re.compile(r"""(password\s*=\s*)('(?:[^'\\]|\\.)*(?:'|\Z)|\S+)""", re.IGNORECASE)


def mask(secret: Column) -> Column:
    """Up to 8 characters nothing is shown, up to 15 two at each end, beyond that three; the middle has a fixed width."""
    n = F.length(secret)
    ends = lambda k: F.concat(F.substring(secret, 1, k), F.lit("***"), F.substring(secret, -k, k))
    return F.when(n <= 8, F.lit(HIDDEN)).when(n <= 15, ends(2)).otherwise(ends(3))


def mask_text(secret: str) -> str:
    keep = 0 if len(secret) <= 8 else 2 if len(secret) <= 15 else 3
    return f"{secret[:keep]}***{secret[-keep:]}" if keep else HIDDEN


def mask_options(options: str) -> str:
    """The two keys' values in a list of k=v are masked, quotes and all else stay."""
    return _OPTION.sub(lambda m: m[1] + m[2] + mask_text(m[3]), options)


def mask_dsn(dsn: str) -> str:
    """The password of a connection string, in key=value or URL form, is hidden. In a URL it reaches from the first
    colon behind the scheme to the first @ (it may hold a slash); a quoted one that isn't closed reaches to the end."""
    if "://" in dsn:
        scheme, _, rest = dsn.partition("://")
        user, at, host = rest.partition("@")
        name, colon, password = user.partition(":")
        return f"{scheme}://{name}:***@{host}" if at and colon else dsn
    return _WORD.sub(r"\1***", dsn)


def copy_options(key_id: str, secret: str, delimiter: str, upsert: bool) -> str:
    return f'access_key_id={key_id},secret_access_key={secret},format=csv,header=true,delimiter="{delimiter}"' + ",mode=upsert" * upsert


# Host prefix, host suffixes, kind of store.
ENDPOINTS = [
    ("s3", (".amazonaws.com", ".amazonaws.com.cn"), "s3"),
    ("internal.s3", (".amazonaws.com", ".amazonaws.com.cn"), "s3"),
    ("oss", (".aliyuncs.com",), "oss"),
    ("cos", (".myqcloud.com",), "s3"),
    ("ks3", (".ksyuncs.com",), "s3"),
    ("s3", (".ufileos.com",), "s3"),
    ("tos-s3", (".volces.com", ".ivolces.com"), "s3"),
]
_REGIONS = [(re.compile(re.escape(p) + r"(?:[.-]([A-Za-z0-9-]+))?(?:" + "|".join(map(re.escape, s)) + r")"), kind) for p, s, kind in ENDPOINTS]


def classify_endpoint(endpoint: str) -> tuple[str, str | None] | None:
    """Kind of store and region of an endpoint that is known by its host; else None."""
    host = re.sub(r"^https?://", "", endpoint).rpartition(":")
    host = host[0] if host[1] else host[2]
    for pattern, kind in _REGIONS:
        if m := pattern.fullmatch(host):
            return (kind, None) if kind == "oss" else (kind, m[1] or "us-east-1")
        if kind == "oss" and host.startswith("oss") and host.endswith(".aliyuncs.com"):
            return kind, None
    return None


def endpoint_kind(endpoint: Column) -> Column:
    """classify_endpoint as a Column: a struct of kind and region, or null."""
    host = F.regexp_replace(F.regexp_replace(endpoint, r"^https?://", ""), r":[^:]*$", "")
    out = None
    for prefix, suffixes, kind in ENDPOINTS:
        p = "^" + re.escape(prefix) + (".*" if kind == "oss" else r"(?:[.-]([A-Za-z0-9-]+))?") + "(?:" + "|".join(map(re.escape, suffixes)) + ")$"
        region = F.lit(None).cast("string") if kind == "oss" else F.when(F.regexp_extract(host, p, 1) == "", F.lit("us-east-1")).otherwise(F.regexp_extract(host, p, 1))
        value = F.struct(F.lit(kind).alias("kind"), region.alias("region"))
        out = F.when(host.rlike(p), value) if out is None else out.when(host.rlike(p), value)
    return out


STAGING_URL = r"^s3://([^/]+)/([^/]+)(?:/(.*?))?/*$"


def staging_url(url: Column) -> Column:
    """s3://endpoint/bucket[/prefix] as a struct of endpoint, bucket and prefix; null where it isn't one."""
    part = lambda i: F.regexp_extract(url, STAGING_URL, i)
    return F.when(url.rlike(STAGING_URL), F.struct(part(1).alias("endpoint"), part(2).alias("bucket"), part(3).alias("prefix")))


def split_staging_url(url: str) -> tuple[str, str, str]:
    m = re.match(STAGING_URL, url)
    if not m:
        raise ConfigError(f"{url!r} is no s3://endpoint/bucket[/prefix]")
    return m[1], m[2], m[3] or ""
