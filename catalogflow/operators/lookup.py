"""Equi joins that enrich rows: catalog, keys, titles, families, colors, galleries, second sources.

Sides are never broadcast by hint: Spark broadcasts a side whose measured size allows it and otherwise shuffles,
splitting skewed keys at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.codes import effective_upc, upc_candidates, upc_digits
from ..functions.markup import lifestyle_alt, variant_alt
from ..functions.text import bullet_points, fix_description, squeeze_ws, text_only
from ..functions.urls import dedupe_urls, https_url, strip_query
from ..functions.values import blank_array, blank_text, let
from ..session import materialize
from .aggregate import first_wins, last_wins
from .order import group_position


NO_CODE_PARTS = 4096  # keys over which rows without code are dealt


def manufacturer_record(homepage: str, known: bool = True) -> Column:
    """The manufacturer record of a catalog row; with known=False the one of a row without catalog entry."""
    none, empty = F.array().cast("array<string>"), F.lit("")

    def filled(value: Column) -> Column:
        return F.coalesce(value, empty) if known else empty

    def record(name: Column, raw: Column) -> Column:
        media = dedupe_urls(F.transform(F.coalesce("image_urls", none), https_url))
        return F.struct(
            filled(F.trim(F.col("product_url"))).alias("product_url"),
            F.lit(homepage).alias("homepage"),
            filled(name).alias("name"),
            filled(text_only(F.col("brand"))).alias("brand"),
            filled(name).alias("product_name"),
            filled(fix_description(raw)).alias("description"),
            (bullet_points(raw) if known else none).alias("benefits_text"),
            filled(text_only(F.col("ingredients"))).alias("ingredients_text"),
            F.create_map().cast("map<string,string>").alias("nutrition_text"),
            empty.alias("directions_for_use"),
            (media if known else none).alias("media"),
            none.alias("source_urls"),
            empty.alias("platform_guess"),
            none.alias("ui_cues"),
        )

    if not known:
        return record(empty, empty)
    texts = F.struct(text_only(F.col("product_name")).alias("name"), text_only(F.col("description")).alias("raw"))
    return let(texts, lambda t: record(t["name"], t["raw"]))


def enrich_from_catalog(
    inputs: DataFrame, catalog: DataFrame, upc_columns: list[str], catalog_order: list[str] | None, homepage: str = ""
) -> DataFrame:
    """Every input row with the catalog record of its code (the last one of a repeated code).

    Adds manufacturer, shopify.media ('{code}_{i}.jpg' per image, from 0) and an empty distributors_or_retailers.
    catalog: upc, product_url, product_name, brand, description, ingredients, image_urls. Without catalog_order
    its codes must be unique already. Records are built on the catalog side, once per code, not per input row.
    """
    coded = catalog.withColumn("__upc", upc_digits(F.col("upc"))).filter("__upc != ''")
    if catalog_order is not None:
        coded = last_wins(coded, ["__upc"], catalog_order)
    side = coded.select("__upc", manufacturer_record(homepage).alias("manufacturer"))
    code = effective_upc(*[F.col(c) for c in upc_columns])
    # blank codes never match; codes are digits, so these keys match nothing, but unlike nulls they do not all meet in one task
    hashed = [F.col(f.name) for f in inputs.schema if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    lost = F.concat(F.lit("-"), F.pmod(F.xxhash64(*hashed or [F.lit(0)]), F.lit(NO_CODE_PARTS)).cast("string"))
    joined = inputs.withColumn("__upc", F.when(code != "", code).otherwise(lost)).join(side, "__upc", "left")
    names = F.transform(
        F.col("manufacturer.media"),
        lambda _, i: F.concat(F.coalesce(F.col("__upc"), F.lit("")), F.lit("_"), i.cast("string"), F.lit(".jpg")),
    )
    return (
        joined.withColumn("manufacturer", F.coalesce("manufacturer", manufacturer_record(homepage, known=False)))
        .withColumn("shopify", F.struct(names.alias("media")))
        .withColumn("distributors_or_retailers", F.array().cast("array<string>"))
        .drop("__upc")
    )


def lookup_by_url(inputs: DataFrame, catalog: DataFrame, url: str, catalog_url: str, order: list[str]) -> DataFrame:
    """Catalog record (as struct `catalog`) of the trimmed address; last record of an address wins."""
    keyed = catalog.withColumn("__url", F.trim(F.col(catalog_url))).filter("__url != ''")
    side = last_wins(keyed, ["__url"], order).select("__url", F.struct(*catalog.columns).alias("catalog"))
    return inputs.withColumn("__url", F.trim(F.col(url))).join(side, "__url", "left").drop("__url")


def lookup_first_key(
    inputs: DataFrame, row_id: list[str], candidates: Column, index: DataFrame, key: str, value: str, scope: list[str] = ()
) -> DataFrame:
    """Value of the first candidate key the index holds: row_id.., matched_key, value. Rows without hit are absent."""
    tried = inputs.select(*row_id, *[s for s in scope if s not in row_id], F.posexplode(candidates).alias("__pos", "__key"))
    side = index.select(*scope, F.col(key).alias("__key"), F.col(value).alias("__value"))
    hits = tried.join(side, [*scope, "__key"])
    best = hits.groupBy(*row_id).agg(F.min_by(F.struct("__key", "__value"), "__pos").alias("__b"))
    return best.select(*row_id, F.col("__b.__key").alias("matched_key"), F.col("__b.__value").alias(value))


def lookup_multi_key(inputs: DataFrame, row_id: list[str], upc: str, catalog: DataFrame, key: str, value: str) -> DataFrame:
    """Every input row with the first of its code forms found in the catalog (unique on its key)."""
    hits = lookup_first_key(inputs, row_id, upc_candidates(F.col(upc)), catalog, key, value)
    return inputs.join(hits, row_id, "left")


def apply_overrides(df: DataFrame, overrides: DataFrame, key: str, override: str, found: str) -> DataFrame:
    """A hand-kept map beats whatever the search found."""
    side = overrides.select(F.col(key), F.col(override).alias("__override"))
    return df.join(side, key, "left").withColumn(found, F.coalesce("__override", found)).drop("__override")


def lookup_title(
    inputs: DataFrame, index: DataFrame, title: Column, index_order: list[str], origin: str = ""
) -> DataFrame:
    """Exact, case-sensitive title lookup; the first index row of a title wins; relative links get the origin.

    For color pages pass `color_title(title, color)`.
    """
    side = first_wins(index, ["title"], index_order).select(F.col("title").alias("__title"), F.col("url").alias("matched_url"))
    joined = inputs.withColumn("__title", title).join(side, "__title", "left").drop("__title")
    full = F.when(F.col("matched_url").startswith("/"), F.concat(F.lit(origin), F.col("matched_url"))).otherwise(F.col("matched_url"))
    return joined.withColumn("matched_url", full)


def color_title(title: Column, color: Column) -> Column:
    return F.trim(F.concat(title, F.lit(" "), F.coalesce(color, F.lit(""))))


def family_key(df: DataFrame, column: str, item: str) -> Column:
    """A number of an item or a parent in the type of item: '36962.0' is 36962; blank, broken or unreadable is null."""
    kind = df.schema[column].dataType
    raw = F.col(column)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        raw = F.when(raw == F.floor(raw), raw.try_cast("decimal(38,0)"))
    plain = F.nullif(F.regexp_replace(F.trim(raw.cast("string")), r"^(-?[0-9]+)\.0*$", "$1"), F.lit(""))
    return plain if isinstance(df.schema[item].dataType, T.StringType) else plain.try_cast(df.schema[item].dataType)


def family_join(
    df: DataFrame, item: str, parent: str, order: str, parts: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(families, orphans). Families: every row with family, is_child and family_pos (parent first, then input order).

    A blank parent makes a family of one; children whose parent is not in the input are orphans.
    """
    own, up = family_key(df, item, item), family_key(df, parent, item)
    parents = df.filter(up.isNull() | (up == own)).select(own.alias("__p")).distinct()
    tagged = df.withColumns({"family": F.coalesce(up, own), "is_child": (up.isNotNull() & (up != own)).cast("int")})
    child = F.col("is_child") == 1
    orphans = tagged.filter(child).join(parents, F.col("family") == F.col("__p"), "left_anti")
    kept = tagged.join(parents, F.col("family") == F.col("__p"), "left_semi")
    placed = group_position(kept, ["family"], ["is_child", order], "family_pos", parts)
    return placed, orphans.drop("family", "is_child")


def _color_forms(c: Column) -> list[Column]:
    name = F.lower(squeeze_ws(c))
    return [name, F.replace(name, F.lit(" "), F.lit("/")), F.replace(name, F.lit("/"), F.lit(" "))]


def color_category(colors: DataFrame, categories: DataFrame, color: str, order: list[str]) -> DataFrame:
    """Category of each color: by its name, else with blanks as slashes, else with slashes as blanks."""
    side = last_wins(categories.withColumn("__k", F.lower(squeeze_ws(F.col("color")))), ["__k"], order).select("__k", "category")
    out = colors
    for i, form in enumerate(_color_forms(F.col(color))):
        out = out.withColumn("__form", form).join(
            side.select(F.col("__k").alias("__form"), F.col("category").alias(f"__c{i}")), "__form", "left"
        )
    return out.withColumn("category", F.coalesce("__c0", "__c1", "__c2")).drop("__form", "__c0", "__c1", "__c2")


# Product type -> vendor type.
VENDOR_TYPES = {"paving_stone": "Paving Stones", "wall_stone": "Wall Stones"}


def map_color_category(
    products: DataFrame, categories: DataFrame, order: list[str], category_order: dict[str, int], colors: str = "colors"
) -> DataFrame:
    """Product colors with their category, unmapped ones dropped: vendor_type, order_index, rank, color, ..

    Sort by (vendor_type, order_index, category_rank, color) for the listing order.
    """
    exploded = products.withColumn("color", F.explode(colors)).drop(colors)
    mapped = color_category(exploded, categories, "color", order).filter(F.col("category").isNotNull())
    vendor, rank = F.lit("Unknown"), F.lit(999)
    for kind, name in VENDOR_TYPES.items():
        vendor = F.when(F.col("product_type") == kind, name).otherwise(vendor)
    for name, position in category_order.items():
        rank = F.when(F.col("category") == name, position).otherwise(rank)
    return mapped.withColumns({"vendor_type": vendor, "category_rank": rank})


def unmapped_colors(products: DataFrame, categories: DataFrame, order: list[str], colors: str = "colors") -> DataFrame:
    distinct = products.select(F.explode(colors).alias("color")).distinct()
    return color_category(distinct, categories, "color", order).filter(F.col("category").isNull()).select("color")


def gallery_by_color(
    variants: DataFrame, portal_images: DataFrame, public_images: DataFrame, product: str, title: str,
    parts: int | None = None,
) -> DataFrame:
    """Gallery of a product by color: own portal images, then hero and lifestyle images, numbered through.

    variants: product, title, ord, color, unit. portal_images: product, color, ord, url.
    public_images: product, kind (hero or lifestyle), ord, url. Output: product, position, src, alt.
    """
    has_unit = F.col("unit").isNotNull()
    colors = variants.filter(~blank_text(F.col("color"))).groupBy(product, "color").agg(
        F.min("ord").alias("color_ord"), F.max_by("unit", F.when(has_unit, F.col("ord"))).alias("unit"), F.min_by(title, "ord").alias("__title")
    )
    colors = colors.filter(F.col("unit").isNotNull())  # a color's place is its first row of any kind
    own = first_wins(
        portal_images.withColumn("url", strip_query(F.col("url"), keep_fragment=True)).filter("url != ''").withColumn("__low", F.lower("url")),
        [product, "color", "__low"],
        ["ord"],
    )
    own = group_position(own, [product, "color"], ["ord", "__low"], "counter", parts)
    shared = public_images.withColumn("url", strip_query(F.col("url"), keep_fragment=True)).filter("url != ''").withColumns(
        {"__low": F.lower("url"), "__kind": F.when(F.col("kind") == "hero", 1).otherwise(2)}
    )
    shared = first_wins(shared, [product, "__low"], ["__kind", "ord"]).join(
        own.select(product, "__low").distinct(), [product, "__low"], "left_anti"
    )
    shared = group_position(shared, [product, "__kind"], ["ord", "__low"], "counter", parts)
    of_color = own.select(product, "color", "url", F.lit(0).alias("__kind"), "counter").join(colors, [product, "color"])
    for_all = shared.select(product, "url", "__kind", "counter").join(colors, product)
    every = of_color.unionByName(for_all)
    number = F.col("counter").cast("string")
    base = (
        F.when(F.col("__kind") == 0, lifestyle_alt(F.col("__title"), F.concat(F.lit("Product Image "), number)))
        .when(F.col("__kind") == 1, lifestyle_alt(F.col("__title"), F.lit("Hero")))
        .otherwise(lifestyle_alt(F.col("__title"), F.concat(F.lit("Lifestyle "), number)))
    )
    placed = group_position(every, [product], ["color_ord", "__kind", "counter"], "position", parts)
    return placed.select(
        product,
        "position",
        F.col("url").alias("src"),
        F.concat(base, F.lit(" "), variant_alt(F.col("color"), F.col("unit"))).alias("alt"),
    )


def image_keys(option1: Column, option2: Column, option3: Column) -> Column:
    """Lower-case keys under which a variant may be known to the image map, in order of preference."""
    o1, o2, o3 = [F.coalesce(o.cast("string"), F.lit("")) for o in (option1, option2, option3)]
    joined = F.regexp_replace(F.concat_ws("|", o1, o2, o3), r"^\|+|\|+$", "")
    alone = (o1 != "") & (o2 == "")
    extra = F.when(
        alone, F.array(*[F.concat(o1, F.lit(s)) for s in ("|EA|None", "|EA|", "|EA")])
    ).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.transform(F.concat(F.array(joined, o1), extra), F.lower))


def variant_image_lookup(variants: DataFrame, image_map: DataFrame, product: str, row_id: list[str], position: str) -> DataFrame:
    """image_id per variant: position of the first known key, else the variant's own position.

    image_map: product, key, image_position (last entry of a key in any case wins; give it unique keys).
    """
    index = image_map.select(product, F.lower("key").alias("key"), F.col("image_position").alias("image_id"))
    keys = image_keys(F.col("option1"), F.col("option2"), F.col("option3"))
    hits = lookup_first_key(variants, row_id, keys, index, "key", "image_id", scope=[product])
    return variants.join(hits.select(*row_id, "image_id"), row_id, "left").withColumn(
        "image_id", F.coalesce("image_id", position)
    )


# Widget name that holds a page's variant configuration.
SWATCH_WIDGET = "Magento_Swatches/js/swatch-renderer"
_ATTRIBUTES = "map<string,struct<code:string,options:array<struct<id:string,label:string,products:array<string>>>>>"


def swatch_config(blob: Column, depth: int = 3) -> Column:
    """JSON text of the widget's configuration, at the top or up to two levels down."""

    def search(level: Column, left: int) -> Column:
        here = F.transform(level, lambda j: F.get_json_object(j, f"$['{SWATCH_WIDGET}']"))
        first = F.get(F.filter(here, lambda v: v.isNotNull()), F.lit(0))
        if left == 1:
            return first
        below = F.flatten(
            F.transform(level, lambda j: F.coalesce(F.map_values(F.from_json(j, "map<string,string>")), F.array().cast("array<string>")))
        )
        return F.coalesce(first, let(below, lambda deeper: search(deeper, left - 1)))

    return search(F.array(blob), depth)


def swatch_options(pages: DataFrame, page: str, blob: str) -> DataFrame:
    """Rows (page, attribute_id, is_style, option_id, option_pos, label, child, child_pos) of the configuration."""
    config = pages.select(page, swatch_config(F.col(blob)).alias("cfg"))
    return _option_rows(config.select(page, F.from_json(F.get_json_object("cfg", "$.jsonConfig.attributes"), _ATTRIBUTES).alias("attributes")), page)


def _option_rows(parsed: DataFrame, page: str) -> DataFrame:
    return (
        parsed.select(page, F.explode("attributes").alias("attribute_id", "a"))
        .select(page, "attribute_id", (F.lower("a.code") == "style").alias("is_style"), F.posexplode("a.options").alias("option_pos", "o"))
        .select(page, "attribute_id", "is_style", "option_pos", F.col("o.id").alias("option_id"), F.col("o.label").alias("label"), F.posexplode_outer("o.products").alias("child_pos", "child"))
    )


def swatch_labels(pages: DataFrame, page: str, blob: str) -> DataFrame:
    """Distinct (page, child, label): from the index first, then from the options' product lists.

    Each blob is read once; its attributes and index are kept in the shared folder for the steps that follow.
    """
    config = pages.select(page, swatch_config(F.col(blob)).alias("cfg"))
    parsed = materialize(
        config.select(
            page,
            F.from_json(F.get_json_object("cfg", "$.jsonConfig.attributes"), _ATTRIBUTES).alias("attributes"),
            F.from_json(F.get_json_object("cfg", "$.jsonConfig.index"), "map<string,map<string,string>>").alias("index"),
        )
    )
    pairs = (
        parsed.select(page, F.explode("index").alias("child", "combo"))
        .select(page, "child", F.explode("combo").alias("attribute_id", "option_id"))
    )
    options = _option_rows(parsed, page)
    named = options.select(page, "attribute_id", "option_id", "label").distinct()
    by_index = pairs.join(named, [page, "attribute_id", "option_id"]).select(page, "child", "label")
    by_option = options.filter(F.col("child").isNotNull()).select(page, "child", "label")
    return by_index.unionByName(by_option).filter(~blank_text(F.col("label"))).distinct()


def swatch_media(pages: DataFrame, page: str, blob: str) -> DataFrame:
    """Media per child (page, child, pos, item as JSON text); the gallery source beats the images source."""
    config = pages.select(page, swatch_config(F.col(blob)).alias("cfg"))
    kind = "map<string,array<string>>"
    sources = [("$.mediaGallery", 0), ("$.gallery", 1), ("$.jsonConfig.images", 2)]
    none = F.array().cast("array<struct<rank:int,child:string,items:array<string>>>")

    def entries(path: str, rank: int) -> Column:
        found = F.map_entries(F.from_json(F.get_json_object("cfg", path), kind))
        ranked = F.transform(found, lambda e: F.struct(F.lit(rank).alias("rank"), e["key"].alias("child"), e["value"].alias("items")))
        return F.coalesce(ranked, none)

    every = config.select(page, F.explode(F.concat(*[entries(*s) for s in sources])).alias("e")).select(page, "e.*").filter(~blank_array(F.col("items")))
    best = every.groupBy(page, "child").agg(F.min_by("items", "rank").alias("items"))
    return best.select(page, "child", F.posexplode("items").alias("pos", "item"))


def merge_second_source(products: DataFrame, extra: DataFrame, key: list[str]) -> DataFrame:
    """Documents of the second source appended; its images used only where the product has none.

    products: key, title, documents, images (array of struct position, src, alt). extra: key, documents, gallery_images.
    """
    side = extra.select(*key, F.col("documents").alias("__docs"), F.col("gallery_images").alias("__gallery"))
    joined = products.join(side, key, "left")
    given = F.transform(
        F.col("__gallery"),
        lambda u, i: F.struct((i + 1).cast("bigint").alias("position"), u.alias("src"), F.coalesce(F.col("title"), F.lit("Product")).alias("alt")),
    )
    return joined.withColumns(
        {
            "documents": F.when(F.col("__docs").isNull(), F.col("documents")).otherwise(
                F.concat(F.coalesce("documents", F.slice("__docs", 1, 0)), "__docs")
            ),
            "images": F.when(blank_array(F.col("images")) & ~blank_array(F.col("__gallery")), given).otherwise(F.col("images")),
        }
    ).drop("__docs", "__gallery")


def listed_urls(c: Column) -> Column:
    """Addresses of a text that holds a list literal or JSON array; empty when it cannot be read as a list."""
    text = F.trim(F.coalesce(c, F.lit("")))
    quoted = F.regexp_extract_all(text, F.lit("""(?:'([^']*)'|"[^"]*")"""), F.lit(0))
    items = F.transform(quoted, lambda q: F.substring(q, F.lit(2), F.length(q) - 2))
    return F.when(text.rlike(r"(?s)^\[.*\]$"), items).otherwise(F.array().cast("array<string>"))


def fallback_route(status: Column, n_images: Column, has_good_image: Column) -> Column:
    """struct(route, reason) of a row no site matched.

    'Match found' falls back to the lookup's data if an image passes the quality test; other rows are unmatched.
    """
    found = status == "Match found"
    no_images, no_good = F.coalesce(n_images, F.lit(0)) == 0, ~F.coalesce(has_good_image, F.lit(False))
    found = F.coalesce(found, F.lit(False))
    route = F.when(~found, "unmatched").when(no_images | no_good, "error").otherwise("fallback")
    reason = (
        F.when(~found, "No manufacturer match and no lookup data")
        .when(no_images, "No lookup images available")
        .when(no_good, "No suitable lookup images (failed quality check)")
    )
    return F.struct(route.alias("route"), reason.alias("reason"))


def fallback_parsed(rows: DataFrame, best: DataFrame, key: str, vendor: str) -> DataFrame:
    """Page record of the rows routed to the fallback, made of their lookup fields and their best image.

    rows: key, description_1, upcitemdb_description. best: key, url. Output has the fields of a parsed page.
    """
    none = F.lit(None).cast("string")
    return rows.join(best.select(key, "url"), key).select(
        key,
        F.coalesce("description_1", F.lit("")).alias("title"),
        F.lit(vendor).alias("brand_hint"),
        F.coalesce("upcitemdb_description", F.lit("")).alias("description"),
        F.array("url").alias("gallery_images"),
        none.alias("features_benefits"),
        none.alias("nutrients"),
        none.alias("feeding_directions"),
        none.alias("documents"),
        none.alias("model_number"),
        F.lit("lookup").alias("site_source"),
    )


def dedupe_across_sources(first: DataFrame, second: DataFrame, key: list[str]) -> DataFrame:
    """Matches of the first source plus those of the second for rows the first left open."""
    rest = second.join(first.select(*key), key, "left_anti")
    return first.withColumn("source_rank", F.lit(1)).unionByName(rest.withColumn("source_rank", F.lit(2)))
