"""Web pages to rows with native expressions: fields by rules, galleries, variants, page types, indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed
from ..functions.markup import json_ld
from ..functions.rules import DESCRIPTION_BLOCK, OG_IMAGE, PRODUCT_PAGE_MARKS
from ..functions.text import text_only
from ..functions.urls import absolute_url, any_part, dedupe_urls, srcset_best, unwrap_proxy
from ..functions.values import blank_text, strip
from .aggregate import first_wins

_TEXTS = "array<string>"


def first_match(html: Column, patterns: list[str]) -> Column:
    """Text of the first pattern that matches, '' when none does."""
    hits = [F.when(html.rlike(p), text_only(F.regexp_extract(html, p, 1))) for p in patterns]
    return F.coalesce(*hits, F.lit(""))


def all_matches(html: Column, block: str | None, item: str, raw: bool = False) -> Column:
    """Texts of every item (inside the first block, if one is named), blanks and repeats dropped."""
    area = html if block is None else F.regexp_extract(html, block, 1)
    found = F.regexp_extract_all(area, F.lit(item), F.lit(1))
    return dedupe_urls(found if raw else F.transform(found, text_only))


def extract_pages(pages: DataFrame, rules: dict[str, dict], site: Column, html: str = "html") -> DataFrame:
    """Fields of every page by the rules of its site; the html column is dropped.

    Text fields are '' and list fields empty where the site has no rule or nothing matches.
    """
    tagged = pages.withColumn("__site", site)
    fields: dict[str, list[tuple[str, object]]] = {}
    for name, table in rules.items():
        for field, rule in table.items():
            fields.setdefault(field, []).append((name, rule))
    out = {}
    for field, per_site in fields.items():
        value = None
        for name, rule in per_site:
            if isinstance(rule, tuple):
                got = all_matches(F.col(html), *rule, raw=field == "links")
            else:
                got = first_match(F.col(html), rule)
            here = F.col("__site") == name
            value = F.when(here, got) if value is None else value.when(here, got)
        empty = F.array().cast(_TEXTS) if isinstance(per_site[0][1], tuple) else F.lit("")
        out[field] = value.otherwise(empty)
    return tagged.withColumns(out).drop("__site", html)


def nutrition_text(analysis: Column, calories: Column) -> Column:
    """Analysis and caloric content as lines of one text."""
    labelled = F.when(~blank_text(calories), F.concat(F.lit("Caloric Content: "), calories))
    return F.concat_ws("\n", F.when(~blank_text(analysis), analysis), labelled)


def spaced_list(c: Column) -> Column:
    """A blank after every comma that has none."""
    return F.regexp_replace(c, r",(?=\S)", ", ")


def size_info(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(strip(c), r"\.$", ""), r"(?U)\s+", " ")


def media_addresses(html: Column, address: Column, suffix: str) -> Column:
    """Addresses of the media ids in data-media lists ('key:id;key:id'), first-seen order."""
    lists = F.regexp_extract_all(html, F.lit(r'(?is)data-media="([^"]+)"'), F.lit(1))
    parts = F.flatten(F.transform(lists, lambda v: F.split(v, ";")))
    ids = dedupe_urls(F.transform(parts, lambda p: strip(F.regexp_replace(p, r"(?s)^[^:]*:", ""))))
    return F.transform(ids, lambda i: F.concat(address, i, F.lit(suffix)))


def halved(title: Column) -> Column:
    """A title longer than 30 characters that is its own half twice is halved."""
    half = F.floor(F.length(title) / 2).cast("int")
    first = F.substring(title, F.lit(1), half)
    rest = F.substring(title, half + 1, F.length(title))
    return F.when((F.length(title) > 30) & (first == rest), first).otherwise(title)


def brand_of_title(title: Column, default: str) -> Column:
    return F.when(title.contains("®"), strip(F.substring_index(title, "®", 1))).otherwise(F.lit(default))


def description_sections(html: Column) -> tuple[Column, Column]:
    """(description, benefits): detail lines joined, other lines listed; price lines dropped.

    The text comes from the description block, else from the window between the price and the share link.
    """
    block = F.nullif(F.regexp_extract(html, DESCRIPTION_BLOCK, 1), F.lit(""))
    start, end = F.locate("MSRP:", html), F.locate("Share this", html)
    window = F.when(start > 0, F.substring(html, start, F.when(end > 0, end - start).otherwise(F.length(html))))
    lines = F.filter(F.transform(F.split(text_only(F.coalesce(block, window, F.lit(""))), r"\R"), strip), lambda x: x != "")
    lines = F.filter(lines, lambda x: ~x.rlike(fixed.NOISE_LINE))
    details = F.filter(lines, lambda x: x.rlike(fixed.DETAIL_LINE))
    others = F.filter(lines, lambda x: ~x.rlike(fixed.DETAIL_LINE))
    return F.array_join(details, " "), F.array_distinct(others)


def select_variants(pages: DataFrame, page: str, html: str = "html") -> DataFrame:
    """Variants of the size drop-down: '25 LB / Bag - $12.34' -> page, pos, variant_id, size, material, price."""
    block = F.regexp_extract(F.col(html), r'(?is)<select[^>]*name="id"[^>]*>(.*?)</select>', 1)
    options = F.regexp_extract_all(block, F.lit(r"(?is)(<option[^>]*>.*?</option>)"), F.lit(1))
    rows = pages.select(page, F.posexplode(options).alias("pos", "o"))
    text = text_only(F.regexp_extract("o", "(?is)<option[^>]*>(.*?)</option>", 1))
    parsed = rows.select(page, "pos", F.regexp_extract("o", 'value="([^"]*)"', 1).alias("variant_id"), text.alias("t"))
    shape = r"^(.+?)\s*-\s*\$?([\d,.]+)"
    parts = F.transform(F.split(F.regexp_extract("t", shape, 1), "/"), strip)
    return parsed.filter(F.col("t").rlike(shape)).select(
        page,
        "pos",
        "variant_id",
        F.coalesce(F.get(parts, F.lit(0)), F.lit("")).alias("size"),
        F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("material"),
        F.replace(F.regexp_extract("t", shape, 2), F.lit(","), F.lit("")).alias("price"),
    )


_VARIANT_JSON = (
    "struct<variants:array<struct<id:string,sku:string,price:double,option1:string,option2:string,option3:string,"
    "featured_image:struct<position:bigint,src:string,alt:string>>>,"
    "media:array<struct<position:bigint,media_type:string,src:string,alt:string,host:string,external_id:string,"
    "sources:array<struct<url:string>>>>>"
)


def embedded_product(html: Column) -> Column:
    """Product record of the page's script (variants and media), null when absent or broken."""
    scripts = F.regexp_extract_all(html, F.lit(r"(?is)<script\b[^>]*>(.*?)</script>"), F.lit(1))
    blobs = F.transform(scripts, lambda s: F.regexp_extract(s, r"(?s)var\s+\w+\s*=\s*(\{.*?variants.*?\});", 1))
    records = F.transform(F.filter(blobs, lambda b: b != ""), lambda b: F.from_json(b, _VARIANT_JSON))
    return F.get(F.filter(records, lambda r: r["variants"].isNotNull()), F.lit(0))


def embedded_variants(pages: DataFrame, page: str, html: str = "html") -> DataFrame:
    """Variants of the embedded product record; cents become units."""
    rows = pages.select(page, F.posexplode(embedded_product(F.col(html))["variants"]).alias("pos", "v"))
    return rows.select(
        page,
        "pos",
        F.col("v.id").alias("variant_id"),
        "v.sku",
        (F.col("v.price") / 100).alias("price"),
        *[F.coalesce(f"v.option{i}", F.lit("")).alias(f"option{i}") for i in (1, 2, 3)],
        "v.featured_image",
    )


def embedded_media(pages: DataFrame, page: str, html: str = "html") -> DataFrame:
    """Media of the embedded product record with a playable address per kind."""
    rows = pages.select(page, F.posexplode(embedded_product(F.col(html))["media"]).alias("ord", "m"))
    video = F.when(F.col("m.host") == "youtube", F.concat(F.lit("https://www.youtube.com/watch?v="), "m.external_id")).otherwise(
        F.concat(F.lit("https://vimeo.com/"), "m.external_id")
    )
    src = (
        F.when(F.col("m.media_type") == "external_video", video)
        .when(F.col("m.media_type") == "video", F.get("m.sources", F.lit(0))["url"])
        .otherwise(F.col("m.src"))
    )
    return rows.select(page, "ord", "m.position", "m.media_type", src.alias("src"), F.coalesce("m.alt", F.lit("")).alias("alt"))


def first_filled(*arrays: Column) -> Column:
    """First array with content, else an empty one."""
    return F.coalesce(*[F.when(F.size(a) > 0, a) for a in arrays], F.array().cast(_TEXTS))


def json_ld_images(html: Column) -> Column:
    """Image addresses of the product JSON-LD (one text or a list)."""
    image = F.get_json_object(json_ld(html, "Product"), "$.image")
    return F.coalesce(
        F.when(image.startswith("["), F.from_json(image, _TEXTS)),
        F.when(image.isNotNull(), F.array(image)),
        F.array().cast(_TEXTS),
    )


def attribute_values(html: Column, pattern: str) -> Column:
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(1))


def og_image(html: Column) -> Column:
    hit = F.regexp_extract(html, OG_IMAGE, 1)
    return F.when(hit != "", F.array(hit)).otherwise(F.array().cast(_TEXTS))


def gallery_json(html: Column) -> Column:
    """Full-size addresses of the gallery data list in the page's scripts."""
    blob = F.regexp_extract(html, r'(?is)<script[^>]*data-gallery-role="gallery"[^>]*>(.*?)</script>', 1)
    blob = F.when(strip(blob) != "", strip(blob))
    listed = F.when(blob.startswith("["), blob).otherwise(F.get_json_object(blob, "$.data"))
    init = F.regexp_extract(html, r'(?is)"mage/gallery/gallery"\s*:\s*\{.*?"data"\s*:\s*(\[.*?\])', 1)
    items = F.from_json(
        F.coalesce(listed, F.nullif(init, F.lit(""))), "array<struct<mediaType:string,type:string,full:string,img:string,thumb:string>>"
    )

    def address(item: Column) -> Column:
        kind = F.lower(F.coalesce(item["mediaType"], item["type"], F.lit("")))
        named = F.lower(F.concat_ws("", item["thumb"], item["img"])).contains("img")
        best = F.coalesce(*[F.when(item[k] != "", item[k]) for k in ("full", "img", "thumb")])
        return F.when((kind == "image") | ((kind == "") & named), best)

    return F.coalesce(F.array_compact(F.transform(items, address)), F.array().cast(_TEXTS))


def block_images(html: Column, block: str) -> Column:
    """src, data-src and last srcset entry of every image inside the blocks, in page order."""
    blocks = F.regexp_extract_all(html, F.lit(block), F.lit(1))
    tags = F.flatten(F.transform(blocks, lambda b: F.regexp_extract_all(b, F.lit("(?i)(<img[^>]*>)"), F.lit(1))))

    def addresses(tag: Column) -> Column:
        return F.array(
            F.regexp_extract(tag, r'(?i)\bsrc="([^"]+)"', 1),
            F.regexp_extract(tag, r'(?i)\bdata-src="([^"]+)"', 1),
            srcset_best(F.regexp_extract(tag, r'(?i)\bsrcset="([^"]+)"', 1), last=True),
        )

    return F.flatten(F.transform(tags, addresses))


def extract_gallery(*sources: Column, swatches: Column | None = None, clean=unwrap_proxy, join: bool = False) -> Column:
    """Gallery of a page: first filled source (or all in order), cleaned, without swatches, deduped."""
    raw = F.concat(*sources) if join else first_filled(*sources)
    out = dedupe_urls(F.transform(raw, lambda u: clean(u)))
    return F.array_except(out, F.transform(swatches, lambda u: clean(u))) if swatches is not None else out


def classify_page(html: Column, shop_host: str, info_host: str) -> Column:
    """'shop' or 'www': store marks in the text, then the canonical link, then og:url; default shop."""
    canonical = F.regexp_extract(html, r'(?is)<link[^>]*rel="canonical"[^>]*href="([^"]*)"', 1)
    og = F.regexp_extract(html, r'(?is)<meta[^>]*property="og:url"[^>]*content="([^"]*)"', 1)
    out = F.when(any_part(html, ["Shopify", "shopify"]), "shop")
    for link in (canonical, og):
        out = out.when(link.contains(shop_host), "shop").when(link.contains(info_host), "www")
    return out.otherwise("shop")


def is_product_page(html: Column) -> Column:
    return any_part(F.coalesce(html, F.lit("")), PRODUCT_PAGE_MARKS)


def build_index(
    pages: DataFrame, page: str, link: str, id_pattern: str, title_pattern: str, category: Column, html: str = "html"
) -> DataFrame:
    """Product index of category pages: (prodid, title, url, category), the first link of an id wins.

    `link` matches one whole link block; its id and title come from the two patterns inside it.
    """
    blocks = F.regexp_extract_all(F.col(html), F.lit(link), F.lit(1))
    rows = pages.select(page, category.alias("category"), F.posexplode(blocks).alias("pos", "block"))
    parsed = rows.select(
        page,
        "pos",
        F.regexp_extract("block", id_pattern, 1).alias("prodid"),
        text_only(F.regexp_extract("block", title_pattern, 1)).alias("title"),
        F.regexp_extract("block", r'href="([^"]+)"', 1).alias("url"),
        "category",
    )
    good = parsed.filter(~blank_text(F.col("prodid")) & ~blank_text(F.col("title")))
    return first_wins(good, ["prodid"], [page, "pos"]).select("prodid", "title", "url", "category")


def index_document(index: DataFrame, built: Column) -> DataFrame:
    """One-row description of an index: build time and number of products."""
    return index.agg(F.count(F.lit(1)).alias("total_products")).withColumn("last_updated", built)


def build_portal_index(items: DataFrame) -> DataFrame:
    """Index rows of portal items, one per item.

    items: displayname, urlcomponent, internalid, itemid, price, stock, images, category.
    """
    family = F.initcap(F.replace(F.get(F.split(F.regexp_replace("category", "^/+|/+$", ""), "/"), F.lit(1)), F.lit("-"), F.lit(" ")))
    family = F.coalesce(family, F.lit(""))
    name = F.coalesce("displayname", F.lit(""))
    prefixed = (family != "") & ~F.lower(name).startswith(F.lower(family))
    last = F.element_at(F.split(F.regexp_replace("urlcomponent", "^/+|/+$", ""), "/"), -1)
    return items.select(
        F.when(prefixed, F.concat(family, F.lit(" "), name)).otherwise(name).alias("title"),
        F.when(~blank_text(F.col("urlcomponent")), F.concat(F.lit("/"), last))
        .when(~blank_text(F.col("internalid").cast("string")), F.concat(F.lit("/product/"), F.col("internalid").cast("string")))
        .otherwise(F.col("category"))
        .alias("url"),
        "category",
        F.col("itemid").alias("sku"),
        F.when(F.coalesce(F.col("price").cast("double"), F.lit(0.0)) != 0, F.col("price").cast("string")).otherwise(F.lit("")).alias("price"),
        F.coalesce(F.col("stock").cast("bigint"), F.lit(0)).alias("stock"),
        dedupe_blank(F.col("images")).alias("images"),
    )


def dedupe_blank(arr: Column) -> Column:
    return F.filter(F.coalesce(arr, F.array().cast(_TEXTS)), lambda u: F.coalesce(u, F.lit("")) != "")


def page_links(pages: DataFrame, page: str, origin: Column, html: str = "html") -> DataFrame:
    """(page, pos, href, url) of every link."""
    links = F.regexp_extract_all(F.col(html), F.lit(r'href="([^"]+)"'), F.lit(1))
    rows = pages.select(page, origin.alias("__origin"), F.posexplode(links).alias("pos", "href"))
    return rows.select(page, "pos", "href", absolute_url(F.col("__origin"), F.col("href")).alias("url"))
