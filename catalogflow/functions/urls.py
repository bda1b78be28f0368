"""Links and image addresses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import fixed
from .values import strip


def https_url(c: Column) -> Column:
    out = strip(F.coalesce(c, F.lit("")))
    out = F.when(out.startswith("//"), F.concat(F.lit("https:"), out)).otherwise(out)
    return F.regexp_replace(out, "^http://", "https://")


def strip_query(c: Column, keep_fragment: bool = False) -> Column:
    text = F.coalesce(c, F.lit(""))
    if keep_fragment:
        return F.regexp_replace(text, r"\?[^#]*", "")
    return F.regexp_replace(text, r"(?s)[?#].*$", "")


def _resolve_dots(path: Column) -> Column:
    kept = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda acc, seg: F.when(seg == ".", acc)
        .when(seg == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(seg))),
    )
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.array_join(kept, "/")).otherwise(path)


def absolute_url(origin: Column, c: Column) -> Column:
    """A link joined to the site's origin; absolute and protocol-relative links keep their host."""
    base = F.regexp_replace(origin, "/+$", "")
    relative = _resolve_dots(F.regexp_replace(c, "^/+", ""))
    return (
        F.when(F.coalesce(c, F.lit("")) == "", F.lit(""))
        .when(c.rlike("^https?://"), c)
        .when(c.startswith("//"), F.concat(F.lit("https:"), c))
        .otherwise(F.concat(base, F.lit("/"), relative))
    )


def strip_store_size(c: Column) -> Column:
    return F.regexp_replace(strip_query(c), fixed.SHOPIFY_SUFFIX, ".$1")


def webp_to_jpg(c: Column) -> Column:
    return F.regexp_replace(c, r"(?i)\.webp$", ".jpg")


def image_url(c: Column, origin: Column | None = None, strip_size: bool = False, webp: bool = False) -> Column:
    out = F.coalesce(c, F.lit(""))
    if origin is not None:
        out = F.when(out.rlike("^(https?:)?//") | (out == ""), out).otherwise(absolute_url(origin, out))
    out = strip_query(https_url(out))
    if strip_size:
        out = strip_store_size(out)
    return webp_to_jpg(out) if webp else out


def root_stem(stem: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(stem, fixed.WORDPRESS_SUFFIX, ""), "(?i)-scaled$", "")


def file_stem(url: Column) -> Column:
    """Root stem of the last path part, the key of the full-size map."""
    return root_stem(F.regexp_replace(F.element_at(F.split(strip_query(url), "/"), -1), r"\.[^.]*$", ""))


def full_size_image(c: Column, full_size: Column | None = None, origin: Column | None = None) -> Column:
    """Thumbnail address to the full-size one: the mapped address of its stem, else the size suffix dropped."""
    url = strip_query(c)
    extension = F.regexp_extract(F.element_at(F.split(url, "/"), -1), r"(\.[^.]*)$", 1)
    folder = F.regexp_extract(url, "^(.*/)[^/]*$", 1)
    plain = F.concat(folder, file_stem(c), extension)
    if full_size is None:
        return plain
    mapped = F.try_element_at(full_size, file_stem(c))
    if origin is not None:
        mapped = F.when(mapped.isNotNull(), absolute_url(origin, mapped))
    return F.coalesce(mapped, plain)


def srcset_best(c: Column, last: bool = False) -> Column:
    """Widest candidate of a srcset (first among equals), or simply the last one."""
    parts = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), strip), lambda p: p != "")
    if last:
        return F.coalesce(F.get(F.split(F.try_element_at(parts, F.lit(-1)), r"(?U)\s+"), F.lit(0)), F.lit(""))
    ranked = F.transform(
        parts,
        lambda p, i: F.struct(
            F.coalesce(F.regexp_extract(p, r"^\S+\s+(\d+)w$", 1).try_cast("bigint"), F.lit(0).cast("bigint")).alias("width"),
            (-i).alias("rank"),
            F.get(F.split(p, r"(?U)\s+"), F.lit(0)).alias("url"),
        ),
    )
    return F.coalesce(F.array_max(ranked)["url"], F.lit(""))


def unwrap_proxy(c: Column) -> Column:
    """Undo the path proxy and complete the bare CDN host, as https without query."""
    out = F.regexp_replace(strip(F.coalesce(c, F.lit(""))), "^/remote\\.axd/", "")
    out = F.regexp_replace(out, r"^images\.salsify\.com/", "https://images.salsify.com/")
    return strip_query(F.regexp_replace(out, "^http://", "https://"))


def unwrap_image_handler(c: Column, origin: Column) -> Column:
    """Address behind an image handler that carries the path in its image= parameter."""
    base = F.regexp_replace(origin, "/+$", "")
    text = strip(F.coalesce(c, F.lit("")))
    full = (
        F.when(text.startswith("//"), F.concat(F.lit("https:"), text))
        .when(text.startswith("/"), F.concat(base, text))
        .when(~text.startswith("http"), F.concat(base, F.lit("/"), text))
        .otherwise(text)
    )
    target = F.regexp_replace(F.regexp_extract(full, r"image=([^&]*)", 1), r"[+ ]", "%20")
    behind = F.when(target.startswith("http"), target).otherwise(
        F.concat(base, F.lit("/"), F.regexp_replace(target, "^/", ""))
    )
    handled = full.contains("GetImage.ashx") & full.contains("image=")
    out = F.when(handled, behind).otherwise(strip_query(full))
    return F.when(text == "", F.lit("")).otherwise(F.replace(out, F.lit("http://"), F.lit("https://")))


def dedupe_urls(arr: Column) -> Column:
    """Order-keeping distinct without blanks."""
    return F.array_distinct(F.filter(arr, lambda u: F.coalesce(u, F.lit("")) != ""))


def any_part(c: Column, parts: list[str]) -> Column:
    hit = F.lit(False)
    for part in parts:
        hit = hit | c.contains(part)
    return hit


def image_candidate(c: Column, site: str, alt: Column | None = None, width: Column | None = None, cdn: str = "") -> Column:
    """Whether an image address belongs to the product gallery. Sites: store, catalog, words, cdn."""
    url = F.coalesce(c, F.lit(""))
    if site == "store":
        return any_part(F.lower(url), fixed.STORE_CDN_MARKS)
    if site == "catalog":
        badge = F.lower(strip(F.coalesce(alt, F.lit("")))) if alt is not None else F.lit("")
        small = F.coalesce(width.try_cast("int") <= 200, F.lit(False)) if width is not None else F.lit(False)
        return any_part(url, fixed.CATALOG_PATH_MARKS) & ~badge.isin(fixed.STOCK_BADGES) & ~small
    if site == "words":
        low = F.lower(url)
        return any_part(low, fixed.PRODUCT_IMAGE_WORDS) & ~any_part(low, fixed.NON_PRODUCT_IMAGE_WORDS)
    return url.contains(cdn)


def product_link(c: Column, must: str | None = None) -> Column:
    """Search-result link filter: no blog, account, cart or legal pages; optionally a required pattern."""
    keep = (F.coalesce(c, F.lit("")) != "") & ~any_part(c, fixed.BAD_LINK_PARTS)
    return keep & c.rlike(must) if must else keep
