"""URL and file-name expressions (H1-H5, H17), all native."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c

UNSAFE_NAME_CHARS = r"[^A-Za-z0-9._-]"


def url_hash(url) -> Column:
    """First 16 hex chars of SHA-256 of the URL (cache key / file prefix)."""
    return F.substring(F.sha2(_c(url), 256), 1, 16)


def basename(url) -> Column:
    """Text after the last '/' (``url.rsplit('/', 1)[-1]``)."""
    return F.substring_index(_c(url), "/", -1)


def safe_filename(url) -> Column:
    """``<sha256(url)[:16]>_<basename with unsafe chars replaced by '_'>``."""
    return F.concat(url_hash(url), F.lit("_"),
                    F.regexp_replace(basename(url), UNSAFE_NAME_CHARS, "_"))


def original_from_safe(name) -> Column:
    """Inverse of the hash prefix: ``^[0-9a-f]{16}_(.+)$`` group 1, NULL if absent."""
    g = F.regexp_extract(_c(name), r"^[0-9a-f]{16}_(.+)$", 1)
    return F.when(g != "", g)


def strip_query(href) -> Column:
    """``href.split('?')[0]``."""
    return F.substring_index(_c(href), "?", 1)


def strip_query_fragment(href) -> Column:
    """``href.split('?')[0].split('#')[0]``."""
    return F.substring_index(strip_query(href), "#", 1)


def site_root(url) -> Column:
    """``scheme://host[:port]`` of an absolute URL ('' when not absolute)."""
    return F.regexp_extract(_c(url), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)


def without_dots(path) -> Column:
    """A path without its ``.`` and ``..`` segments: a stack folded over the segments, ``..`` takes the last off."""
    segments = F.split(_c(path), "/")
    stack = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda kept, s: F.when(s == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
        .when(s == ".", kept).otherwise(F.concat(kept, F.array(s))))
    # a directory keeps its slash at the end, and nothing climbs above the root
    last = F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(stack, F.array(F.lit("")))).otherwise(stack)
    return F.concat(F.lit("/"), F.regexp_replace(F.array_join(last, "/"), "^/", ""))


DOTS_RE = r"(?:^|/)\.\.?(?:/|$)"


def resolve(href, base) -> Column:
    """``href`` as an absolute URL, seen from the page ``base`` (H5).

    ``scheme:`` and ``//host`` links keep their path as it is; ``?q`` and ``#f`` replace that part of the base;
    every other path, taken from the base's directory unless it starts with ``/``, loses its dot segments, and
    one from a directory also empty segments.  An empty link is the base itself.
    """
    h, b = _c(href), _c(base)
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    root, page = site_root(b), F.regexp_extract(b, r"^[^?#]*", 0)
    path, tail = F.regexp_extract(h, r"^[^?#]*", 0), F.regexp_extract(h, r"[?#].*$", 0)
    folder = F.regexp_extract(F.substring(page, F.length(root) + 1, F.length(page)), r"^.*/", 0)
    joined = F.regexp_replace(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path), "//+", "/")
    rooted = F.when(path.rlike(DOTS_RE), without_dots(path)).otherwise(path)
    relative = F.when(joined.rlike(DOTS_RE), without_dots(joined)).otherwise(joined)
    return (F.when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
            .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
            .when(h.startswith("/"), F.concat(root, rooted, tail))
            .when(h == "", b)
            .when(h.startswith("?"), F.concat(page, h))
            .when(h.startswith("#"), F.concat(F.substring_index(b, "#", 1), h))
            .otherwise(F.concat(root, relative, tail)))


def host(url) -> Column:
    """Lower-case host of an absolute URL, NULL when there is none."""
    hst = F.lower(F.regexp_extract(_c(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^@/?#]*@)?([^:/?#]*)", 1))
    return F.when(hst != "", hst)


def suffix_keys(host_) -> Column:
    """array of structs (key, labels, exception) of the suffix rules that a host could match.

    For every number of last labels: the labels themselves, the wildcard rule that they match,
    and the exception from it.  ``labels``: how many labels a public suffix by that rule has.
    """
    parts = F.split(_c(host_), r"\.")
    n = F.size(parts)

    def last(k: Column) -> Column:
        return F.array_join(F.slice(parts, n - k + 1, k), ".")

    def of(k: Column) -> Column:
        return F.array(F.struct(last(k).alias("key"), k.alias("labels"), F.lit(False).alias("exception")),
                       F.struct(F.concat(F.lit("*."), last(k - 1)).alias("key"), k.alias("labels"), F.lit(False).alias("exception")),
                       F.struct(F.concat(F.lit("!"), last(k)).alias("key"), (k - 1).alias("labels"), F.lit(True).alias("exception")))

    return F.flatten(F.transform(F.sequence(F.lit(1), n), of))


def last_labels(host_, n) -> Column:
    """The last ``n`` labels of a host."""
    parts = F.split(_c(host_), r"\.")
    return F.array_join(F.slice(parts, F.size(parts) - n + 1, n), ".")


def registered_domain(url) -> Column:
    """Last two labels of the host: the registered domain where every public suffix has one label.
    :func:`quire.operators.crawl.registered_domains` takes a table of suffix rules."""
    return F.regexp_extract(host(url), r"([^.]+\.[^.]+)$", 1)
