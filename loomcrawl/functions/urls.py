"""URL functions, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Second-level public suffixes known here, beside every single last label. Extend with `suffixes=`.
PUBLIC_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp", "or.jp", "com.br", "com.cn", "com.tr", "co.za", "co.in", "co.kr", "com.mx", "com.ar")


def host(url: Column) -> Column:
    """Host of an http(s) URL, without user info and port; null for anything else."""
    found = F.regexp_extract(url, r"^(?i)https?://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.when(found != "", F.lower(found))


def domain(url: Column) -> Column:
    """Host of an http(s) URL; other strings are returned as they are."""
    return F.coalesce(host(url), url)


def registered_domain(url: Column, suffixes: tuple[str, ...] = PUBLIC_SUFFIXES) -> Column:
    """The public suffix and the label before it; null where there is no such label, or for an IP address."""
    name = host(url)
    parts = F.split(name, r"\.")
    n = F.size(parts)
    two = F.array_join(F.slice(parts, F.greatest(n - 1, F.lit(1)), 2), ".")
    take = F.when(two.isin(*suffixes), 3).otherwise(2)
    return F.when((n >= take) & ~name.rlike(r"^[0-9.]+$"), F.array_join(F.slice(parts, n - take + 1, take), "."))


def _normal_path(path: Column) -> Column:
    """Path without "." and ".." segments."""
    step = lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(s == ".", acc).otherwise(F.concat(acc, F.array(s)))
    parts = F.split(F.regexp_replace(path, "^/", ""), "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    slash = F.when(path.rlike(r"/\.{1,2}$") & (F.size(kept) > 0), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), slash)


def resolve(ref: Column, base: Column) -> Column:
    """ref as an absolute URL, relative to base.

    References that start with http are returned as they are. Null for null, empty and fragment-only
    references, for other schemes (mailto:, javascript: …) and where base is not an http(s) URL.
    """
    ref = F.trim(ref)
    scheme = F.regexp_extract(base, r"^(?i)(https?):", 1)
    origin = F.regexp_extract(base, r"^(?i)(https?://[^/?#]+)", 1)
    path = F.regexp_extract(base, r"^(?i)https?://[^/?#]+([^?#]*)", 1)
    folder = F.concat(F.regexp_extract(path, r"^(.*/)", 1))
    ref_path, tail = F.regexp_extract(ref, r"^([^?#]*)", 1), F.regexp_extract(ref, r"^[^?#]*(.*)$", 1)
    whole = F.when(ref_path.startswith("/"), ref_path).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), ref_path))
    return (
        F.when(ref.rlike("^(?i)https?:"), ref)
        .when((origin == "") | (ref == "") | ref.startswith("#") | ref.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), None)
        .when(ref.startswith("//"), F.concat(scheme, F.lit(":"), ref))
        .when(ref.startswith("?"), F.concat(origin, F.when(path == "", "/").otherwise(path), ref))
        .otherwise(F.concat(origin, F.when(whole.contains("./") | whole.endswith("/.") | whole.endswith("/.."), _normal_path(whole)).otherwise(whole), tail))
    )


def path_terms(url: Column) -> Column:
    """Words of a URL's path: split at / _ - and %20, without .htm and .html, empty ones left out."""
    path = F.regexp_replace(F.regexp_extract(url, r"^(?i)https?://[^/?#]+([^?#]*)", 1), r"(?i)\.html?$", "")
    return F.filter(F.split(path, r"/|_|-|%20"), lambda t: t != "")
