"""Column builders for URLs and declared content types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of declared media types and of file extensions.
MIME_FORMATS = {
    "text/html": "html",
    "application/xhtml+xml": "html",
    "text/plain": "plain_text",
    "text/markdown": "markdown",
    "text/x-markdown": "markdown",
    "application/json": "json",
    "application/ld+json": "json",
    "application/xml": "xml",
    "text/xml": "xml",
    "application/csv": "csv",
    "text/csv": "csv",
}
EXTENSION_FORMATS = {"html": "html", "htm": "html", "json": "json", "xml": "xml", "csv": "csv", "md": "markdown", "markdown": "markdown", "txt": "plain_text"}


def lookup(key: Column, table: dict[str, str]) -> Column:
    """The table's value for a key, null where it has none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def normalize_url(url: Column) -> Column:
    """A URL with ``http`` where it has no scheme; null for other schemes and blanks."""
    clean = F.trim(url)
    full = F.when(clean.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), clean).when(clean != "", F.concat(F.lit("http://"), clean))
    return F.when(full.rlike("(?i)^https?://"), full)


def url_host(url: Column) -> Column:
    """The host in lower case, without user and port; null where there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.lower(host), F.lit(""))


def domain_allowed(url: Column, domains: list[str]) -> Column:
    """Whether the host is one of the domains, without case and blanks; an empty list allows none."""
    allowed = [d.strip().lower() for d in domains if d.strip()]
    return F.coalesce(url_host(url).isin(allowed), F.lit(False)) if allowed else F.lit(False)


def private_address(url: Column, domains: list[str] = ()) -> Column:
    """Whether the host is a literal private, loopback, link-local or reserved address not listed."""
    host = url_host(url)
    octet = lambda i: F.try_element_at(F.split(host, r"\."), F.lit(i)).try_cast("int")
    a, b, c = octet(1), octet(2), octet(3)
    literal = host.rlike(r"^\d{1,3}(\.\d{1,3}){3}$")
    special = (
        a.isin(0, 10, 127) | (a >= 224) | ((a == 169) & (b == 254)) | ((a == 172) & b.between(16, 31)) | ((a == 192) & (b == 168))
        | ((a == 192) & (b == 0) & c.isin(0, 2)) | ((a == 198) & b.isin(18, 19)) | ((a == 198) & (b == 51) & (c == 100)) | ((a == 203) & (b == 0) & (c == 113)) | ((a == 100) & b.between(64, 127))
    )
    # Literals of version 6: unspecified, loopback, unique local, link-local, multicast, documentation and mapped ones.
    six = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?\[([0-9A-Fa-f:.]+)\]", 1))
    special_six = six.rlike(r"^(?:[0:]*:[01]?$|f[cd][0-9a-f]{2}:|fe[89ab][0-9a-f]:|ff[0-9a-f]{2}:|2001:0?db8:|[0:]*:ffff:)")
    listed = six.isin([d.strip().lower().strip("[]") for d in domains]) if domains else F.lit(False)
    return F.coalesce(literal & special, F.lit(False)) & ~domain_allowed(url, list(domains)) | F.coalesce(special_six, F.lit(False)) & ~listed


def main_type(content_type: Column) -> Column:
    """The media type without parameters, in lower case."""
    return F.lower(F.trim(F.substring_index(content_type, ";", 1)))


def content_type_allowed(content_type: Column, allowed: list[str]) -> Column:
    """Whether a media type is allowed exactly, by ``type/*`` or by ``*/*``; a missing one only by ``*/*``."""
    if "*/*" in allowed:
        return F.lit(True)
    own = main_type(content_type)
    tests = [own.startswith(a.strip().lower()[:-1]) if a.strip().endswith("/*") else own == a.strip().lower() for a in allowed]
    out = F.lit(False)
    for test in tests:
        out = out | F.coalesce(test, F.lit(False))
    return out


def resource_class(content_type: Column) -> Column:
    """html, json, xml, text, pdf, binary or unknown."""
    own = main_type(content_type)
    return (
        F.when(own.isNull() | (own == ""), "unknown").when(own == "text/html", "html").when(own.isin("application/json", "text/json"), "json")
        .when(own.isin("application/xml", "text/xml"), "xml").when(own.startswith("text/"), "text").when(own == "application/pdf", "pdf").otherwise("binary")
    )


def mime_format(content_type: Column) -> Column:
    own = main_type(F.nullif(content_type, F.lit("")))
    return F.coalesce(lookup(own, MIME_FORMATS), F.when(own.startswith("text/"), "plain_text"))


def extension(url: Column) -> Column:
    """What follows the last dot of a URL without query and fragment, in lower case; null without a dot."""
    path = F.substring_index(F.substring_index(url, "?", 1), "#", 1)
    return F.when(path.contains("."), F.lower(F.substring_index(path, ".", -1)))


def file_extension(url: Column) -> Column:
    """The extension if it has 1 to 10 characters."""
    ext = extension(url)
    return F.when((ext != "") & (F.length(ext) <= 10), ext)


def extension_format(url: Column) -> Column:
    return lookup(extension(url), EXTENSION_FORMATS)
