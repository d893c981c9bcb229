"""Contact data in evidence text: spans, exemptions and a mask of the same length.

Patterns propose spans. A span inside a URL counts only if the URL itself carries contact data: then the
whole URL is a span too; else it is a number that names content and the URL exempts what it covers. The
rules need places and Unicode classes that Spark's expressions do not give, so a helper reads one text and
an Arrow-batched UDF applies it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote_to_bytes, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from quillspark.functions.urls import CONTACT_NAMES, PROFILE_MARKS

#: The kinds of contact data; of contact and account the group is the span.
KINDS = {
    "email": re.compile(r"(?<![\w.+-])[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}(?![\w.-])", re.I),
    "mobile": re.compile(r"(?<![A-Z0-9])(?:\+?86[ -]?)?1[3-9]\d{9}(?![A-Z0-9])", re.I),
    "contact": re.compile(r"(?:电话|手机|联系方式|联系电话|phone|tel)\s*[:：=]?\s*(\+?[0-9][0-9(). -]{4,29}[0-9])", re.I),
    "account": re.compile(r"(?:微信|微\s*信|QQ|weixin|wechat|账号|账户|account)(?:\s*[:：=]\s*|\s+)([A-Z0-9_][A-Z0-9_.-]{4,39})", re.I),
    "profile": re.compile(r"https?://[^\s/]+/(?:users?|profile|people|members?)/[^\s<>，。；]+", re.I),
}
URL = re.compile(r"https?://[^\s<>，。；]+", re.I)
CONTENT_NAMES = ("id", "item", "item_id", "article", "article_id", "post", "post_id", "page", "page_id", "record", "record_id", "news", "news_id", "detail")
CONTENT_MARKS = ("id", "item", "article", "post", "page", "record", "news", "detail", "entry", "document", "content")
#: Kinds that tell a person wherever they stand in a URL; a bare number does so only in a contact field.
PERSONAL = {"email", "contact", "account", "profile"}
MARK = "＊"
SPANS = ArrayType(StructType().add("start", IntegerType()).add("end", IntegerType()).add("kind", StringType()))

Span = tuple[int, int, str]


def proposed(text: str) -> list[Span]:
    """What the patterns find, in order."""
    group = {"contact": 1, "account": 1}
    return sorted({(*m.span(group.get(kind, 0)), kind) for kind, pattern in KINDS.items() for m in pattern.finditer(text)})


def _shown(part: str) -> str:
    return unquote_to_bytes(part).decode("utf-8", "backslashreplace")


def _kinds(part: str) -> set[str]:
    return {kind for *_, kind in proposed(part)}


def url_is_personal(url: str) -> bool:
    """Whether a URL carries contact data of a person, or can't be read: in a parameter's name or value, a path or a fragment."""
    try:
        parts = urlsplit(url)
        if not parts.hostname or parts.username is not None or (parts.port or 1) < 1:
            return True
    except ValueError:
        return True
    for pair in parts.query.split("&") if parts.query else []:
        name, _, value = pair.partition("=")
        name, value = _shown(name), _shown(value)
        if _kinds(name) & PERSONAL or value and name.strip().casefold() in CONTACT_NAMES or _kinds(value) & PERSONAL:
            return True
    before = ""
    for segment in filter(None, (_shown(x) for x in parts.path.split("/") if x)):
        if before in PROFILE_MARKS or (kinds := _kinds(segment)) and (before in CONTACT_NAMES and not (before in CONTENT_MARKS and segment.isdigit()) or kinds & PERSONAL):
            return True
        before = segment.strip().casefold()
    return bool(parts.fragment and _kinds(_shown(parts.fragment)))


def spans_of(text: str | None) -> list[Span]:
    """The spans of contact data of a text: proposals that no URL exempts, and URLs that carry contact data as url_identifier."""
    if not text:
        return []
    links = [(*m.span(), url_is_personal(m[0])) for m in URL.finditer(text)]
    out = [(start, end, "url_identifier") for start, end, personal in links if personal]
    k = 0
    for start, end, kind in proposed(text):
        while k < len(links) and links[k][1] <= start:
            k += 1
        inside = k < len(links) and links[k][0] <= start and end <= links[k][1]
        if not inside or links[k][2]:
            out.append((start, end, kind))
    return sorted(out)


def merged(spans: list[Span]) -> list[tuple[int, int]]:
    """The stretches that sorted spans cover together."""
    out: list[tuple[int, int]] = []
    for start, end, _ in spans:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def hidden(text: str | None) -> str | None:
    """The text with every character of a span replaced by a mark; its length stays."""
    if not text:
        return text
    parts, at = [], 0
    for start, end in merged(spans_of(text)):
        parts += [text[at:start], MARK * (end - start)]
        at = end
    return "".join([*parts, text[at:]])


@F.pandas_udf(SPANS)
def contact_spans(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """array<struct<start, end, kind>> of each text, by code points, end exclusive; none for null."""
    for batch in texts:
        yield batch.map(lambda t: [dict(zip(("start", "end", "kind"), s, strict=True)) for s in spans_of(t)])


@F.pandas_udf(StringType())
def masked(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Each text with its contact data hidden; null stays null."""
    for batch in texts:
        yield batch.map(hidden)


def has_private(*columns: Column) -> Column:
    """Whether any of the columns holds contact data."""
    out = F.lit(False)
    for c in columns:
        out = out | (F.size(contact_spans(c)) > 0)
    return out
