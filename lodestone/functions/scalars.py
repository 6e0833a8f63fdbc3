"""Scalar rules: safe ratios, text tokens, identifiers, URLs, file names, dates, licences, sizes."""

from __future__ import annotations

import hashlib
import html
import json
import re
import unicodedata
import uuid
from urllib.parse import parse_qsl, quote, unquote, urlencode, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio(num, den, digits: int | None = None, default: float | None = None) -> Column:
    """num / den, null (or `default`) over zero."""
    out = F.try_divide(num, den)
    if default is not None:
        out = F.coalesce(out, F.lit(default))
    return out if digits is None else F.round(out, digits)


def tokenize(col) -> Column:
    """Lower-cased runs of word characters and apostrophes, of any script."""
    return F.regexp_extract_all(F.lower(col), F.lit("(?U)([\\w']+)"), F.lit(1))


@F.pandas_udf(T.ArrayType(T.StringType()))
def fold_tokens(text: pd.Series) -> pd.Series:
    """Tokens after NFKC and case folding, which Spark has no function for."""
    word = re.compile(r"[\w']+")
    return text.map(lambda t: word.findall(unicodedata.normalize("NFKC", t).casefold()) if t is not None else None)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("token", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))
def tokens_with_spans(text: pd.Series) -> pd.Series:
    word = re.compile(r"[\w']+")
    return text.map(lambda t: [{"token": m.group().lower(), "start": m.start(), "end": m.end()} for m in word.finditer(t)] if t is not None else None)


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFKC", t) if t is not None else None)


@F.pandas_udf(T.StringType())
def casefold(text: pd.Series) -> pd.Series:
    return text.map(lambda t: t.casefold() if t is not None else None)


@F.pandas_udf(T.StringType())
def unescape_html(text: pd.Series) -> pd.Series:
    return text.map(lambda t: html.unescape(t) if t is not None else None)


def content_hash(text) -> Column:
    """SHA-256 of the NFKC form."""
    return F.sha2(F.encode(nfkc(text), "UTF-8"), 256)


def stable_shard(key, shards: int) -> Column:
    """The first 8 bytes of SHA-256 as an unsigned number, modulo the shards."""
    head = F.conv(F.substring(F.sha2(F.encode(F.col(key) if isinstance(key, str) else key, "UTF-8"), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return F.pmod(head, F.lit(shards).cast("decimal(20,0)")).cast("int")


def chunk_uuid(doc_id, offset, text) -> Column:
    """A UUID from the first 16 bytes of SHA-256 over document, offset and NFKC text (parted by 0x1F), with version 5 and variant bits."""
    h = F.sha2(F.encode(F.concat_ws("\u001f", doc_id, F.col(offset).cast("string") if isinstance(offset, str) else offset.cast("string"), nfkc(text)), "UTF-8"), 256)
    variant = F.element_at(F.array(*(F.lit(c) for c in "89ab")), (F.pmod(F.conv(F.substring(h, 17, 1), 16, 10).cast("int"), F.lit(4)) + 1).cast("int"))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


@F.pandas_udf(T.StringType())
def legacy_chunk_uuid(doc_id: pd.Series, source: pd.Series, text: pd.Series) -> pd.Series:
    """uuid5 over document, source and the first 16 digits of the text's SHA-256."""
    space = uuid.NAMESPACE_URL
    return pd.Series([str(uuid.uuid5(space, f"{d}|{s}|{hashlib.sha256((t or '').encode()).hexdigest()[:16]}")) for d, s, t in zip(doc_id, source, text)])


def idempotency_key(parts: dict[str, Column]) -> Column:
    """SHA-256 of the parts as JSON with sorted keys and no spaces."""
    body = F.concat(F.lit("{"), F.concat_ws(",", *(F.concat(F.lit(json.dumps(k) + ":"), F.coalesce(F.to_json(F.struct(v.alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(v.alias("v")))) - 6), F.lit("null"))) for k, v in sorted(parts.items()))), F.lit("}"))
    return F.sha2(F.encode(body, "UTF-8"), 256)


#: Query parameters that only track visits (fixed values).
TRACKERS = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid", "yclid", "mc_eid", "mc_cid",
    "ref", "ref_", "referrer", "spm", "igshid", "mkt_tok", "msclkid", "_hsenc", "_hsmi",
)
PORTS = {"http": 80, "https": 443}


def ascii_host(host: str) -> str:
    """Lower case, with labels of other scripts in their ASCII (IDNA) form where they have one."""
    host = host.lower()
    if host.isascii():
        return host
    try:
        return host.encode("idna").decode()
    except UnicodeError:
        return host


def canonical(url: str | None, role: str = "index") -> str | None:
    """Scheme and host in lower case, no default port, no fragment, dot segments resolved, query sorted for the index; trackers dropped for landing pages."""
    if url is None:
        return None
    s = urlsplit(url.strip())
    scheme, host = s.scheme.lower() or "http", ascii_host(s.hostname or "")
    try:
        port = s.port
    except ValueError:
        port = None
    netloc = host if port in (None, PORTS.get(scheme)) else f"{host}:{port}"
    out: list[str] = []
    for seg in (s.path or "/").split("/"):
        if seg == "..":
            out[1:] = out[1:-1]
        elif seg != ".":
            out.append(seg)
    path = quote(unquote("/".join(out)), safe="/-._~!$&'()*+,;=:@") or "/"
    query = parse_qsl(s.query, keep_blank_values=True)
    if role == "landing":
        query = [(k, v) for k, v in query if k.lower() not in TRACKERS]
    if role == "index":
        query = sorted(query)
    return urlunsplit((scheme, netloc, path, urlencode(query), ""))


def canonical_url(role: str = "index"):
    @F.pandas_udf(T.StringType())
    def f(url: pd.Series) -> pd.Series:
        return url.map(lambda u: canonical(u, role))

    return f


def canonical_host(url) -> Column:
    return F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))


def basename_from_url(url) -> Column:
    return F.nullif(F.regexp_extract(url, "^[^?#]*/([^/?#]+)(?:[?#].*)?$", 1), F.lit(""))


def safe_filename(name) -> Column:
    clean = F.regexp_replace(F.regexp_replace(name, "[^A-Za-z0-9._-]+", "_"), "^[._]+|[._]+$", "")
    return F.when(clean == "", F.lit("file")).otherwise(F.substring(clean, 1, 255))


def relative_id(path) -> Column:
    """A path without its extension, in a plain character set, of at most 512 characters."""
    return F.substring(F.regexp_replace(F.regexp_replace(path, "\\.[A-Za-z0-9]{1,8}$", ""), "[^A-Za-z0-9._/-]", "_"), 1, 512)


def cas_path(digest) -> Column:
    return F.concat_ws("/", F.lit("sha256"), F.substring(digest, 1, 2), F.substring(digest, 3, 2), digest)


def parse_instant(col) -> Column:
    """ISO text or HTTP dates; the weekday is cut first, as its pattern letter is not allowed."""
    text = F.regexp_replace(col, "^[A-Za-z]+, ", "")
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in ("dd MMM yyyy HH:mm:ss zzz", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyyMMdd")))


#: Whole licence names, in lower case, and their SPDX identifiers (fixed values).
LICENCES = {
    "cc-by": "CC-BY-4.0", "cc by": "CC-BY-4.0", "cc-by-4.0": "CC-BY-4.0", "cc by 4.0": "CC-BY-4.0",
    "creative commons attribution": "CC-BY-4.0", "creative commons attribution 4.0": "CC-BY-4.0",
    "cc0": "CC0-1.0", "cc-0": "CC0-1.0", "cc0-1.0": "CC0-1.0", "creative commons zero": "CC0-1.0", "public domain": "CC0-1.0",
    "apache": "Apache-2.0", "apache 2": "Apache-2.0", "apache 2.0": "Apache-2.0", "apache license": "Apache-2.0", "apache license 2.0": "Apache-2.0",
}


def spdx(col) -> Column:
    """A licence's SPDX identifier where the whole name is a known one; other names stay, with single spaces (CC-BY-... in upper case), so no restriction is lost. Blank is null."""
    t = F.trim(F.regexp_replace(col, "\\s+", " "))
    known = F.element_at(F.create_map(*(F.lit(x) for pair in LICENCES.items() for x in pair)), F.lower(t))
    return F.when(t == "", F.lit(None).cast("string")).otherwise(F.coalesce(known, F.when(F.upper(t).startswith("CC-BY-"), F.upper(t)), t))


def media_type(col) -> Column:
    return F.lower(F.trim(F.split(col, ";")[0]))


def human_bytes(col) -> Column:
    x = F.col(col) if isinstance(col, str) else col
    out = F.concat(x.cast("string"), F.lit(" B"))
    for k, unit in enumerate(("KB", "MB", "GB", "TB"), 1):
        out = F.when(x >= 1024**k, F.format_string(f"%.2f {unit}", F.bround(x / float(1024**k), 2))).otherwise(out)
    return out


def masked(col) -> Column:
    """Secrets after the names that usually hold them."""
    return F.regexp_replace(col, "(?i)(api[_-]?key|token|password|secret|authorization)(\"?\\s*[:=]\\s*\"?)[^\\s\",&]+", "$1$2***")


_UNITS = {"s": 1, "h": 3600, "d": 86400, "w": 7 * 86400, "m": 30 * 86400, "y": 365 * 86400}


def period_seconds(text: str) -> int:
    """7d, 24h, 2w; m is a month of 30 days."""
    m = re.fullmatch(r"(\d+)([shdwmy])", text.strip().lower())
    if not m:
        raise ValueError(f"no period: {text!r}")
    return int(m[1]) * _UNITS[m[2]]


def rate_per_second(text: str) -> float:
    """5/second, 300/min, 10/h."""
    m = re.fullmatch(r"(\d+(?:\.\d+)?)\s*/\s*(s|sec|second|m|min|minute|h|hour|d|day)s?", text.strip().lower())
    if not m:
        raise ValueError(f"no rate: {text!r}")
    return float(m[1]) / {"s": 1, "m": 60, "h": 3600, "d": 86400}[m[2][0]]
