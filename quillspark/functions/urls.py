"""Page identity of URLs.

The rules depend on bytes, order and percent-encoding, which Spark's expressions cannot keep apart, so a
small helper handles one URL and an Arrow-batched UDF applies it to the distinct URLs of a column.
"""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Query names that only track; signed or sensitive queries are left as they are.
TRACKING = ("fbclid", "gclid", "yclid", "mc_cid", "mc_eid", "igshid")
TRACKING_PREFIX = "utm_"
SENSITIVE = ("token", "xsec_token", "auth", "authorization", "session", "cookie", "code", "password", "access_token", "api_key", "sig", "signature")
CONTACT_NAMES = ("phone", "mobile", "telephone", "tel", "contact", "contact_phone", "联系电话", "手机", "电话", "联系方式")
PROFILE_MARKS = ("user", "users", "profile", "people", "member", "members")
SENSITIVE_PREFIXES = ("x-amz-", "x-goog-")
#: Public suffixes of more than one part.
SUFFIXES = ("com.cn", "net.cn", "org.cn", "gov.cn", "edu.cn", "com.hk", "com.tw", "co.uk", "org.uk", "com.au", "co.jp")
RESERVED = ("localhost", "local", "internal", "invalid", "test", "onion")
UNRESERVED = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_~")
PARTS = re.compile(r"(https?)://([^/?#]*)([^?#]*)(\?[^#]*)?", re.I)


def _decoded(text: str, dots: bool) -> str:
    """Percent-encoding of unreserved characters undone, other hex in capitals, the rest encoded as UTF-8."""

    def one(found: re.Match) -> str:
        byte = int(found[1], 16)
        return chr(byte) if byte in UNRESERVED or (dots and byte == 0x2E) else found[0].upper()

    text = re.sub(r"%([0-9A-Fa-f]{2})", one, text)
    return "".join(c if c.isascii() else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def public_host(authority: str) -> str | None:
    """The host with its port, if it can be a public site's; no user info, no control characters."""
    if "@" in authority or re.search(r"[\s\x00-\x1f\x7f]", authority):
        return None
    host, _, port = authority.partition(":")
    host = host.rstrip(".").lower()
    if port and not (port.isascii() and port.isdigit() and 0 < int(port) < 65536):
        return None
    try:
        address = ipaddress.ip_address(host)
    except ValueError:
        try:
            host = host.encode("idna").decode()
        except UnicodeError:
            return None
        labels = host.split(".")
        if len(labels) < 2 or labels[-1] in RESERVED or not all(re.fullmatch(r"[a-z0-9_](?:[a-z0-9_-]*[a-z0-9])?", x) for x in labels):
            return None
    else:
        if not address.is_global:
            return None
    return f"{host}:{port}" if port else host


def canonical(url: str | None) -> str | None:
    """The page that a URL names, or null if it is no public one."""
    found = PARTS.match(url or "")
    if not found:
        return None
    scheme, authority, path, query = found[1].lower(), found[2], found[3], found[4]
    host = public_host(authority)
    if host is None:
        return None
    host = host.removesuffix(":80" if scheme == "http" else ":443")
    names = [p.partition("=")[0].lower() for p in (query or "?")[1:].split("&")]
    if any(n in SENSITIVE or n.startswith(SENSITIVE_PREFIXES) for n in names):
        return f"{scheme}://{host}{path}{query or ''}"
    kept = [p for p, n in zip((query or "?")[1:].split("&"), names, strict=True) if not (n in TRACKING or n.startswith(TRACKING_PREFIX))]
    rest = "?" + _decoded("&".join(kept), True) if query is not None and (kept or len(names) == 0) else ""
    return f"{scheme}://{host}{_decoded(path, False)}{rest}"


@F.pandas_udf(StringType())
def canonical_url(urls: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in urls:
        yield batch.map(canonical)


def query_parts(url: Column) -> Column:
    """array<struct<name, value>> of the raw query, in order; nothing is decoded and empty parts stay."""
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    parts = F.when(query != "", F.split(query, "&", -1)).otherwise(F.array().cast("array<string>"))
    return F.transform(parts, lambda p: F.struct(F.substring_index(p, "=", 1).alias("name"), F.regexp_extract(p, r"^[^=]*=(.*)$", 1).alias("value")))


def query_names(url: Column) -> Column:
    """The parameter names of a URL, lower-cased, in order."""
    return F.transform(query_parts(url), lambda p: F.lower(p["name"]))


def url_privacy(url: Column) -> Column:
    """confirmed, suspected or none: whether a URL carries contact data of a person.

    Confirmed: a contact field with a value, an e-mail address in query, path or fragment, or a profile path.
    Suspected: a bare telephone number elsewhere than in a content id.
    """
    email = r"(?i)[A-Z0-9._%+-]+(?:@|%40)[A-Z0-9.-]+\.[A-Z]{2,}"
    mobile = r"(?:^|[^A-Za-z0-9])(?:\+?86[ -]?)?1[3-9][0-9]{9}(?:[^A-Za-z0-9]|$)"
    rest = F.regexp_replace(url, r"^[A-Za-z]+://[^/?#]*", "")
    ids = r"(?i)([?&/])(?:id|item|item_id|article|article_id|post|post_id|page|page_id|record|record_id|news|news_id|detail)[=/]1[3-9][0-9]{9}(?=[^0-9]|$)"
    contact = F.exists(query_parts(url), lambda p: F.lower(p["name"]).isin(*CONTACT_NAMES) & (p["value"] != ""))
    profile = rest.rlike(rf"(?i)/(?:{'|'.join(PROFILE_MARKS)})/[^/?#]+")
    return F.when(contact | profile | rest.rlike(email), "confirmed").when(F.regexp_replace(rest, ids, "$1").rlike(mobile), "suspected").otherwise("none")


def declared_reasons(url: Column, domain: Column, platform_id: Column, declared: Column) -> Column:
    """Codes of a source's declared domain and platform against its URL."""
    from quillspark.operators.contracts import reasons

    return reasons(
        {
            "source_domain_mismatch": F.lower(F.regexp_replace(F.trim(F.coalesce(domain, F.lit(""))), r"\.$", "")) != host_of(url),
            "platform_identity_conflict": F.coalesce((F.trim(declared) != "") & (F.lower(F.trim(declared)) != platform_id), F.lit(False)),
        }
    )


def redirect_reasons(hops: Column, url: Column, final_url: Column, retrieved_at: Column, most: int = 20) -> Column:
    """Codes of a chain of redirects, array<struct<url, address, at>> in order.

    Addresses must be public (IPv4 ranges of private, loopback, link-local, multicast and reserved use are not),
    no URL may come twice, times must not go back or pass the retrieval, and the ends must be the URLs given.
    """
    from quillspark.operators.contracts import reasons

    private = r"^(?:0|10|127|22[4-9]|23\d|24\d|25\d)\.|^192\.168\.|^169\.254\.|^172\.(?:1[6-9]|2\d|3[01])\.|^100\.(?:6[4-9]|[7-9]\d|1[01]\d|12[0-7])\.|^192\.0\.[02]\.|^198\.(?:1[89]|51)\.|^203\.0\.113\."
    octet = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    n = F.coalesce(F.size(hops), F.lit(0))
    ok = (n > 0) & (n <= most)
    return reasons(
        {
            "network_connection_hops_required": ~ok,
            "network_address_not_public": ok & F.exists(hops, lambda h: ~F.coalesce(h["address"].rlike(rf"^{octet}(?:\.{octet}){{3}}$") & ~h["address"].rlike(private), F.lit(False))),
            "redirect_cycle": ok & (F.size(F.array_distinct(F.transform(hops, lambda h: h["url"]))) < n),
            "network_redirect_time_reversed": ok & F.exists(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda k: F.coalesce(F.get(hops, k)["at"] < F.get(hops, k - 1)["at"], F.lit(False))),
            "network_observation_after_capture": ok & F.exists(hops, lambda h: h["at"] > retrieved_at),
            "network_redirect_identity_mismatch": ok & ~(F.get(hops, F.lit(0))["url"].eqNullSafe(url) & F.get(hops, n - 1)["url"].eqNullSafe(F.coalesce(final_url, url))),
        }
    )


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z]+://([^/?#:]*)", 1))


def registrable(host: Column) -> Column:
    """The last two labels of a host, or three under a suffix of two parts."""
    labels = F.split(host, r"\.")
    two = F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), F.lit(2)), ".")
    three = F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 2), F.lit(3)), ".")
    return F.when(two.isin(*SUFFIXES), three).otherwise(two)


def platform(df: DataFrame, exact: dict[str, str], prefixes: dict[str, str], suffixes: dict[str, str], url: str = "url") -> DataFrame:
    """Add platform: by host, else host and path prefix, else host suffix, else the host without www.

    The alias lists are small constants; they become one expression, so there is no join.
    """
    host, path = host_of(F.col(url)), F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1)
    out = [F.when(host == h, F.lit(p)) for h, p in exact.items()]
    out += [F.when(F.concat(host, path).startswith(h), F.lit(p)) for h, p in sorted(prefixes.items(), key=lambda x: -len(x[0]))]
    out += [F.when((host == h) | host.endswith(f".{h}"), F.lit(p)) for h, p in sorted(suffixes.items(), key=lambda x: -len(x[0]))]
    return df.withColumn("platform", F.coalesce(*out, F.regexp_replace(host, r"^www\.", "")))
