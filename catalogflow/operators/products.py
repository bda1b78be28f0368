"""Nested store products from families, pages and lookups.

Variants, options and images stay long until the last step; `nest` then packs them into arrays of bounded size, so
a product with very many variants goes on in further parts instead of filling one task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed
from ..functions.markup import body_html, clean_html, filter_alt, specification_html
from ..functions.sizes import portal_weight, product_weight, unit_weight
from ..functions.text import normalize_size
from ..functions.values import blank_array, blank_text, strip
from ..session import materialize
from .aggregate import default_options, option_title, option_values
from .checks import variant_unit
from .lookup import gallery_by_color, variant_image_lookup
from .order import allocate_skus, group_position, nest

OPTIONS = ["option_1", "option_2", "option_3", "option_4"]


def metafield(key: str, value: Column, kind: str, when: Column) -> Column:
    entry = F.struct(
        F.lit("custom").alias("namespace"), F.lit(key).alias("key"), value.cast("string").alias("value"), F.lit(kind).alias("type")
    )
    return F.when(when, entry)


def money_text(*cols: Column, default: str | None = None) -> Column:
    """First given amount as plain text without '$' and thousands marks."""
    texts = [F.when(~blank_text(c.cast("string")), c.cast("string")) for c in cols]
    out = F.regexp_replace(F.coalesce(*texts), r"[$,]", "")
    return F.coalesce(out, F.lit(default)) if default is not None else out


def option_value(df: DataFrame, named: Column, data_columns: list[str]) -> Column:
    """Value of the column an option names; sizes in their normal form."""
    out = F.lit(None).cast("string")
    for name in data_columns:
        value = normalize_size(F.col(name).cast("string")) if name == "size" else F.col(name).cast("string")
        out = F.when(F.lower(F.trim(named)) == name, value).otherwise(out)
    return F.when(~blank_text(out), out)


def family_variants(families: DataFrame, data_columns: list[str], parsed: DataFrame, image_map: DataFrame) -> DataFrame:
    """Variant rows of every family: options, price, cost, codes, stock, weight, image, metafields.

    families: output of family_join. The parent row names the options of its family. parsed: family, model_number.
    image_map: family, key, image_position.
    """
    parent = default_options(families.filter("is_child = 0"), OPTIONS).groupBy("family").agg(
        *[F.min_by(F.trim(F.coalesce(o, F.lit(""))), "family_pos").alias(f"__{o}") for o in OPTIONS]
    )
    joined = families.join(parent, "family").join(
        parsed.select("family", "model_number"), "family", "left"
    )
    values = {f"option{i + 1}": option_value(joined, F.col(f"__{o}"), data_columns) for i, o in enumerate(OPTIONS)}
    weight = product_weight(F.col("size"), F.col("upcitemdb_size"), F.col("upcitemdb_title"))
    rows = joined.withColumns(
        {
            **values,
            "sku": F.col("item_no").cast("string"),
            "price": money_text(F.col("sold_ext_price_adj"), F.col("avg_price_per_unit"), default="0"),
            "cost_text": money_text(F.col("sold_ext_cost_adj")),
            "barcode": F.coalesce(*[F.when(~blank_text(F.col(c)), F.col(c)) for c in ("sku", "upc", "upc_updated") if c in joined.columns], F.lit("")),
            "inventory_quantity": F.coalesce(F.col("inventory_qty").cast("int"), F.lit(0)),
            "w": weight,
        }
    )
    size_info = F.to_json(F.struct(F.col("option1").alias("label"), F.col("option1").alias("weight")))
    sized = F.col("option1").isNotNull() & (F.lower(F.trim("__option_1")) == "size")
    rows = rows.withColumn(
        "metafields",
        F.array_compact(
            F.array(
                metafield("model_number", F.col("model_number"), "single_line_text_field", ~blank_text(F.col("model_number"))),
                metafield("size_info", size_info, "json", sized),
            )
        ),
    )
    kept = rows.select(
        "family", F.col("family_pos").alias("position"), "sku", "price", F.col("cost_text").alias("cost"), "barcode",
        "inventory_quantity", F.col("w.weight").alias("weight"), F.col("w.unit").alias("weight_unit"),
        F.when(F.col("w.weight").isNotNull(), F.col("w.grams")).alias("grams"),
        *values, *[F.col(f"__{o}").alias(o) for o in OPTIONS], "metafields",
    )
    return variant_image_lookup(kept, image_map, "family", ["family", "position"], "position")


def variant_struct() -> Column:
    """Store form of a variant row; the constants are the store's defaults."""
    return F.struct(
        "sku", "price", "cost", "barcode", "inventory_quantity", "position", "option1", "option2", "option3", "option4",
        F.lit("deny").alias("inventory_policy"), F.lit(None).cast("string").alias("compare_at_price"),
        F.lit("manual").alias("fulfillment_service"), F.lit("shopify").alias("inventory_management"),
        F.lit(True).alias("taxable"), "grams", "weight", "weight_unit", F.lit(True).alias("requires_shipping"),
        "image_id", "metafields",
    )


def variant_options(variants: DataFrame) -> DataFrame:
    """(family, slot, name, value, value_pos) of the used options."""
    slots = [(i + 1, option_title(F.col(o)), F.col(f"option{i + 1}")) for i, o in enumerate(OPTIONS)]
    return option_values(variants, "family", "position", slots)


def product_images(variants: DataFrame, media: DataFrame, titles: DataFrame) -> DataFrame:
    """Image rows (family, position, sub, src, alt): an image of certain variants once, a shared one per variant.

    media: family, position, src, media_type, variant_keys, part (from variant_image_map), videos left out.
    """
    pictures = media.filter(F.col("media_type") == "image")
    named = pictures.join(titles.select("family", "title"), "family")
    keys = F.split(F.get("variant_keys", F.lit(0)), r"\|")
    own = named.filter(~blank_array(F.col("variant_keys")) & (F.col("part") == 0)).select(
        "family", "position", F.lit(0).cast("bigint").alias("sub"), "src",
        filter_alt(F.col("title"), *[F.get(keys, F.lit(i)) for i in range(3)]).alias("alt"),
    )
    shared = named.filter(blank_array(F.col("variant_keys"))).select("family", "position", "src", "title")
    per_variant = shared.join(variants.select("family", F.col("position").alias("sub"), "option1", "option2", "option3"), "family").select(
        "family", "position", "sub", "src", filter_alt(F.col("title"), *[F.col(f"option{i}") for i in (1, 2, 3)]).alias("alt")
    )
    return own.unionByName(per_variant)


def product_videos(variants: DataFrame, media: DataFrame) -> DataFrame:
    """Video rows per variant they belong to: (family, position, kind, src, alt, option1..3)."""
    videos = media.filter(F.col("media_type").isin("external_video", "video"))
    return videos.join(variants.select("family", F.col("position").alias("sub"), "option1", "option2", "option3"), "family").select(
        "family", "position", "sub", F.upper("media_type").alias("media_content_type"), F.col("src").alias("original_source"), "alt",
        "option1", "option2", "option3",
    )


@dataclass
class FamilyProducts:
    """Store products of item families; each table is planned when first asked for.

    families: output of family_join. parsed: family, title, brand_hint, description, features_benefits, nutrients,
    feeding_directions, documents (JSON text), model_number. media and image_map as in variant_image_map.
    """

    families: DataFrame
    parsed: DataFrame
    media: DataFrame
    image_map: DataFrame
    data_columns: list[str]
    vendor: str
    max_items: int = 1000
    parts: int | None = None

    @cached_property
    def variants(self) -> DataFrame:
        return family_variants(self.families, self.data_columns, self.parsed, self.image_map)

    @cached_property
    def head(self) -> DataFrame:
        """One row per family: title, description, vendor, status, metafields."""
        parents = self.families.filter("is_child = 0").groupBy("family").agg(
            F.min_by("description_1", "family_pos").alias("__name")
        )
        fields = [
            ("features", clean_html(F.col("features_benefits")), "rich_text_field", F.col("features_benefits")),
            ("nutritional_information", clean_html(F.col("nutrients")), "rich_text_field", F.col("nutrients")),
            ("directions", clean_html(F.col("feeding_directions")), "rich_text_field", F.col("feeding_directions")),
            ("documentation", F.col("documents"), "json", F.col("documents")),
        ]
        return parents.join(self.parsed, "family", "left").select(
            "family",
            F.coalesce(F.col("title"), F.col("__name"), F.lit("Unknown Product")).alias("title"),
            body_html(F.col("description")).alias("descriptionHtml"),
            F.coalesce("brand_hint", F.lit(self.vendor)).alias("vendor"),
            F.lit("ACTIVE").alias("status"),
            F.array_compact(F.array(*[metafield(k, v, t, ~blank_text(c)) for k, v, t, c in fields])).alias("metafields"),
        )

    @cached_property
    def options(self) -> DataFrame:
        return variant_options(self.variants)

    @cached_property
    def images(self) -> DataFrame:
        return product_images(self.variants, self.media, self.head)

    @cached_property
    def videos(self) -> DataFrame:
        return product_videos(self.variants, self.media)

    @cached_property
    def nested(self) -> DataFrame:
        """(family, part, product as JSON text)."""
        self.__dict__["variants"] = materialize(self.variants)
        return pack_products(
            self.head, self.variants, self.options, self.images, self.videos, self.max_items, self.parts
        )


def pack_products(
    head: DataFrame, variants: DataFrame, options: DataFrame, images: DataFrame, videos: DataFrame | None,
    max_items: int = 1000, parts: int | None = None,
) -> DataFrame:
    """(family, part, product as JSON text). Part 0 carries the head; lists longer than max_items go on in further parts.

    Variants are numbered by position within their family, options by value_pos within their slot, both from 1.
    """
    v = nest(variants, ["family"], ["position"], variant_struct(), "variants", max_items, numbered=True)
    values = nest(options, ["family", "slot", "name"], ["value_pos"], F.col("value"), "values", max_items, numbered=True)
    # at most four slots per family and part
    o = values.groupBy("family", "part").agg(
        F.array_sort(F.collect_list(F.struct(F.col("slot").alias("position"), "name", "values"))).alias("options")
    )
    i = nest(images, ["family"], ["position", "sub"], F.struct("position", "src", "alt"), "images", max_items, parts)
    out = v.join(o, ["family", "part"], "full").join(i, ["family", "part"], "full")
    if videos is not None:
        item = F.struct("alt", "media_content_type", "original_source", F.struct("option1", "option2", "option3").alias("variant_options"))
        m = nest(videos, ["family"], ["position", "sub"], item, "media", max_items, parts)
        out = out.join(m, ["family", "part"], "full")
    first = out.join(head, "family")
    body = [
        F.col(c) if c not in ("descriptionHtml", "metafields") else F.when(F.col("part") == 0, F.col(c)).alias(c)
        for c in ("title", "descriptionHtml", "vendor", "status", "metafields")
    ]
    lists = ["options", "variants", "images", *(["media"] if videos is not None else [])]
    return first.select("family", "part", F.to_json(F.struct(F.struct(*body, *lists).alias("product"))).alias("product"))


def unit_prices(prefix: str = "") -> dict[str, tuple[Column, Column]]:
    """Columns of the paver input: unit -> (cost, price)."""
    return {
        "Piece": (F.col(f"{prefix}cost_per_piece"), F.col(f"{prefix}price_per_piece")),
        "Kit": (F.col(f"{prefix}cost_per_kit"), F.col(f"{prefix}price_per_kit")),
        "Sq Ft": (F.col(f"{prefix}sq_ft_cost"), F.col(f"{prefix}sq_ft_price")),
    }


def priced_rows(inputs: DataFrame) -> DataFrame:
    """Paver input rows with family (trimmed title), color, unit, and the unit's cost and price."""
    prices = unit_prices()
    unit = variant_unit(prices)
    cost, price = F.lit(None).cast("double"), F.lit(None).cast("double")
    for name, (c, p) in prices.items():
        cost, price = F.when(F.col("unit") == name, c).otherwise(cost), F.when(F.col("unit") == name, p).otherwise(price)
    rows = inputs.withColumns({"family": strip(F.coalesce("portal_title", F.lit(""))), "color": strip(F.coalesce("color", F.lit("")))})
    return rows.filter("family != ''").withColumn("unit", unit).withColumns({"unit_cost": cost, "unit_price": price})


@dataclass
class PaverProducts:
    """Store products of title families sold by piece, kit or area; each table is planned when first asked for.

    rows: output of priced_rows with ord. public: family, description, specifications. portal: family, color, weight,
    model_number, swatch. Rows whose conversion factor is zero are in `errors`, and fail their whole family.
    """

    rows: DataFrame
    public: DataFrame
    portal: DataFrame
    portal_images: DataFrame
    public_images: DataFrame
    registry: DataFrame
    vendor: str
    start_sku: int = fixed.FIRST_AUTO_SKU
    inventory: int = 5
    max_items: int = 1000
    parts: int | None = None

    @cached_property
    def weighed(self) -> DataFrame:
        priced = self.rows.filter(F.col("unit").isNotNull())
        side = self.portal.select("family", "color", "weight", "model_number", "swatch")
        joined = priced.join(side, ["family", "color"], "left").withColumn("__cube", portal_weight(F.col("weight")))
        weight = unit_weight(
            F.col("__cube.value"), F.col("__cube.unit"), F.col("unit"), F.col("pieces_per_cube"), F.col("sq_ft_per_cube")
        )
        return joined.withColumn("w", weight)

    @cached_property
    def errors(self) -> DataFrame:
        return self.weighed.filter(F.col("w.error").isNotNull()).select("family", "ord", "color", F.col("w.error").alias("error"))

    @cached_property
    def good(self) -> DataFrame:
        """Rows with a unit of the families without error, once and with no more columns than variants have."""
        kept = self.weighed.join(self.errors.select("family").distinct(), "family", "left_anti").select(
            "family", "ord", "color", "unit", "unit_price", "unit_cost", "item_no", "swatch", "model_number",
            F.col("__cube.unit").alias("__cube_unit"), F.col("w.weight").alias("weight"), F.col("w.grams").alias("grams"),
        )
        return materialize(kept)

    @cached_property
    def variants(self) -> DataFrame:
        numbered = allocate_skus(self.good, self.registry, ["ord"], self.start_sku, self.parts)
        placed = group_position(numbered, ["family"], ["ord"], "position", self.parts)
        none = F.lit(None).cast("string")
        return placed.select(
            "family", "position", "sku", F.col("unit_price").cast("string").alias("price"),
            F.col("unit_cost").cast("string").alias("cost"), F.coalesce(F.col("item_no").cast("string"), F.lit("")).alias("barcode"),
            F.lit(self.inventory).alias("inventory_quantity"), "weight",
            F.when(F.col("__cube_unit") != "", F.regexp_replace("__cube_unit", "s$", "")).otherwise(F.lit("lb")).alias("weight_unit"),
            "grams", F.col("color").alias("option1"), F.col("unit").alias("option2"),
            none.alias("option3"), none.alias("option4"), F.lit(None).cast("bigint").alias("image_id"),
            F.array_compact(
                F.array(
                    metafield("color_swatch_image", F.col("swatch"), "single_line_text_field", ~blank_text(F.col("swatch"))),
                    metafield("model_number", F.col("model_number"), "single_line_text_field", ~blank_text(F.col("model_number"))),
                    metafield("unit_of_sale", F.col("unit"), "single_line_text_field", F.lit(True)),
                )
            ).alias("metafields"),
        )

    @cached_property
    def options(self) -> DataFrame:
        rank = F.when(F.col("unit") == "Piece", 0).when(F.col("unit") == "Kit", 1).otherwise(2)
        every = self.rows.join(self.good.select("family").distinct(), "family", "left_semi")  # colors without a unit, too
        colors = option_values(every, "family", "ord", [(1, F.lit("Color"), F.trim("color"))])
        ranked = self.good.withColumn("__rank", rank)
        return colors.unionByName(option_values(ranked, "family", "__rank", [(2, F.lit("Unit of Sale"), F.col("unit"))]))

    @cached_property
    def images(self) -> DataFrame:
        titled = self.rows.withColumn("title", F.col("family"))  # a color's place may be that of a row without a unit
        gallery = gallery_by_color(titled, self.portal_images, self.public_images, "family", "title", self.parts)
        return gallery.withColumn("sub", F.lit(0))

    @cached_property
    def head(self) -> DataFrame:
        hide = F.array(metafield("hide_online_price", F.lit("true"), "boolean", F.lit(True)))
        return self.good.select("family").distinct().join(self.public, "family", "left").select(
            "family", F.col("family").alias("title"),
            specification_html(F.col("description"), F.col("specifications")).alias("descriptionHtml"),
            F.lit(self.vendor).alias("vendor"), F.lit("ACTIVE").alias("status"), hide.alias("metafields"),
        )

    @cached_property
    def nested(self) -> DataFrame:
        """(family, part, product as JSON text)."""
        self.__dict__["variants"] = materialize(self.variants)
        return pack_products(self.head, self.variants, self.options, self.images, None, self.max_items, self.parts)
