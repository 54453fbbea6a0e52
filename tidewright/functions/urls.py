"""URL columns. Hosts are cut by pattern, so host names with underscores or umlauts and missing schemes behave alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewright.functions import values as v
from tidewright.functions.text import _c, clean, let, strip, val

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://"


def authority(url: Column) -> Column:
    """What stands between ``//`` and the path, "" without a scheme."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def url_candidate(c: Column | str) -> Column:
    """Stripped, without ``.,;:)`` at the end, https:// added where no http scheme is; "" without a dotted host."""
    s = F.regexp_replace(clean(c), r"[.,;:)]+$", "")
    full = F.when(s.rlike(r"(?i)^https?://"), s).otherwise(F.concat(F.lit("https://"), s))
    return F.when((s != "") & F.contains(authority(full), F.lit(".")), full).otherwise("")


def website_domain(c: Column | str) -> Column:
    """Lower-case host without user, port and one ``www.``; "" where there is none."""
    host = F.regexp_replace(F.regexp_replace(F.lower(authority(url_candidate(c))), r"^.*@", ""), r":.*$", "")
    return F.regexp_replace(host, r"^www\.", "")


def bare_host(c: Column | str) -> Column:
    """Lower-case host of a URL with scheme, without port and ``www.``."""
    return F.regexp_replace(F.regexp_replace(F.lower(authority(_c(c))), r":.*$", ""), r"^www\.", "")


def url_key(c: Column | str) -> Column:
    """Grouping key: scheme (https by default) and host in lower case, path without ``/`` at its end and without ``;params``, query kept, fragment dropped."""
    return let(F.regexp_replace(strip(c), r"#.*$", ""), _url_key)


def _url_key(s: Column) -> Column:
    scheme = F.coalesce(F.nullif(F.lower(F.regexp_extract(s, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)), F.lit("")), F.lit("https"))
    rest = F.regexp_replace(s, r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    host = F.lower(F.regexp_extract(rest, r"^//([^/?]*)", 1))
    path = F.regexp_extract(F.regexp_replace(rest, r"^//[^/?]*", ""), r"^([^?]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, r";[^/]*$", ""), r"/+$", "")
    query = F.regexp_extract(rest, r"\?(.+)$", 1)
    return F.concat(scheme, F.lit("://"), host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def probe_variants(c: Column | str) -> Column:
    """https, https www, http and http www of the host alone; empty without a host."""
    s = clean(c)
    full = F.when(s.rlike(r"(?i)^https?://"), s).otherwise(F.concat(F.lit("https://"), s))
    bare = F.regexp_replace(F.lower(authority(full)), r"^www\.", "")
    urls = F.array(*[F.concat(F.lit(p), bare) for p in ("https://", "https://www.", "http://", "http://www.")])
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(urls)


def page_class(path: Column) -> Column:
    """Page type by the words of a path, the first type that fits; null for none."""
    out = F.lit(None).cast("string")
    low = F.lower(path)
    for kind, words in reversed(list(v.PAGE_WORDS.items())):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(low, F.lit(w))
        out = F.when(hit, kind).otherwise(out)
    return out


def url_path(c: Column | str) -> Column:
    return F.regexp_extract(F.regexp_replace(_c(c), _SCHEME + r"[^/?#]*", ""), r"^([^?#]*)", 1)


def skippable(c: Column | str) -> Column:
    """The path ends in a file type that is no page."""
    return F.lower(url_path(c)).rlike(r"\.(?:" + "|".join(v.SKIPPED_ENDINGS) + ")$")


def in_hosts(host: Column, hosts: list[str]) -> Column:
    """The host is one of ``hosts`` or below one."""
    hit = host.isin(hosts)
    for h in hosts:
        hit = hit | F.endswith(host, F.lit("." + h))
    return hit


def is_directory(c: Column | str) -> Column:
    return let(bare_host(c), lambda h: in_hosts(h, v.DIRECTORY_HOSTS))


def is_blocked(c: Column | str) -> Column:
    return let(bare_host(c), lambda h: in_hosts(h, v.BLOCKED_HOSTS))


def effective_website(normalized: str = "Website_Normalized", website: str = "Website") -> Column:
    return F.coalesce(val(normalized), val(website))


def organisation_key(normalized: str = "Website_Normalized", website: str = "Website", domain: str = "Email_Domain") -> Column:
    """First of normalised site, site and e-mail domain that holds a value, lower case, without ``/`` at the end."""
    first = F.coalesce(*[val(c, also_na=False) for c in (normalized, website, domain)])
    return F.regexp_replace(F.lower(first), r"/+$", "")


def cache_digest(c: Column | str) -> Column:
    """First twenty hexadecimal digits of the SHA-256 of the URL key."""
    return F.substring(F.sha2(url_key(c), 256), 1, 20)


def email_on_site(email: Column, site: Column) -> Column:
    """The address's host is the site's host, above it or below it."""
    host = F.regexp_replace(F.lower(F.substring_index(email, "@", -1)), r"^www\.", "")
    own = bare_host(site)
    return (host == own) | F.endswith(host, F.concat(F.lit("."), own)) | F.endswith(own, F.concat(F.lit("."), host))
