"""A whole run as one plan: slice, families, skip, lookups, checks, build order, upsert, summary."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed
from ..functions.values import blank_array, blank_text, strip
from ..operators.checks import variant_complete
from ..operators.lookup import color_title, lookup_title
from ..operators.merge import mark_skipped, merge_variants, upsert
from ..operators.order import allocate_skus, record_range
from ..operators.products import priced_rows
from ..session import materialize


@dataclass
class CatalogRun:
    """Status of every family, merged variants, updated product list and summary of one run.

    A failing family never stops the others: failures are statuses with a reason (skipped, failed, ok,
    ok_portal_only). Each table is planned when first asked for.

    inputs: ord, portal_title, public_title, color, item_no and the unit price columns, or the output of priced_rows. Indexes: title, url, ord.
    public_pages: url, title, description, hero_image, gallery_images. existing: family, ord, color, unit, sku, price,
    cost. mode: 'skip' keeps complete old variants, 'overwrite' builds all anew.
    """

    inputs: DataFrame
    public_index: DataFrame
    public_pages: DataFrame
    portal_index: DataFrame
    existing: DataFrame
    registry: DataFrame
    mode: str = "skip"
    start: int | None = None
    end: int | None = None
    start_sku: int = fixed.FIRST_AUTO_SKU
    parts: int | None = None

    @cached_property
    def old_variants(self) -> DataFrame:
        return self.existing.withColumn("complete", variant_complete(F.col("sku"), F.col("price"), F.col("cost")))

    @cached_property
    def rows(self) -> DataFrame:
        """Input rows of the slice with family, unit and skip; used by every later step."""
        sliced = self.inputs
        if self.start or self.end:
            sliced = record_range(sliced, ["ord"], self.start, self.end, self.parts)
        priced = sliced if "unit_price" in sliced.columns else priced_rows(sliced)
        if self.mode == "skip":
            return materialize(mark_skipped(priced, self.old_variants, "family"))
        return materialize(priced.withColumn("skip", F.lit(False)))

    @cached_property
    def families(self) -> DataFrame:
        families = self.rows.groupBy("family").agg(
            F.min("ord").alias("ord"),
            F.min_by(strip(F.coalesce("public_title", F.lit(""))), "ord").alias("public_title"),
            F.bool_and("skip").alias("family_skipped"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if("skip").alias("n_skipped"),
        )
        title = F.when(F.col("public_title") != "", F.col("public_title"))
        found = lookup_title(families, self.public_index, title, ["ord"]).withColumnRenamed("matched_url", "public_url")
        thin = blank_text(F.col("description")) & blank_text(F.col("hero_image")) & blank_array(F.col("gallery_images"))
        pages = self.public_pages.select(F.col("url").alias("public_url"), F.col("title").alias("__page_title"), thin.alias("__thin"))
        found = found.join(pages, "public_url", "left")
        colors = self.rows.filter(~F.col("skip") & ~blank_text(F.col("color"))).select("family", "color").distinct()
        portal = lookup_title(colors, self.portal_index, color_title(F.col("family"), F.col("color")), ["ord"])
        portal_hits = portal.groupBy("family").agg(F.count("matched_url").alias("n_portal"), F.count(F.lit(1)).alias("n_colors"))
        state = found.join(portal_hits, "family", "left")
        n_portal = F.coalesce("n_portal", F.lit(0))
        no_public = F.col("public_url").isNull()
        bad_page = ~no_public & blank_text(F.coalesce("__page_title", F.lit("")))
        nowhere = no_public & (n_portal == 0)
        status = (
            F.when(F.col("family_skipped"), "skipped").when(bad_page | nowhere, "failed").when(no_public, "ok_portal_only").otherwise("ok")
        )
        reason = F.when(bad_page, "Public data validation failed").when(nowhere, "Product not found on public site or portal")
        warned = F.coalesce("__thin", F.lit(False)) | (n_portal < F.coalesce("n_colors", F.lit(0)))
        return state.withColumn("status", status).select(
            "family", "ord", "n_rows", "n_skipped", "status",
            F.when(F.col("status") == "failed", reason).alias("reason"),
            F.when(F.col("status").startswith("ok") & warned, 1).otherwise(0).alias("warnings"),
        )

    @cached_property
    def variants(self) -> DataFrame:
        built = self.families.filter(F.col("status").startswith("ok")).select("family")
        todo = materialize(self.rows.join(built, "family", "left_semi"))
        fresh = allocate_skus(
            todo.filter(~F.col("skip") & F.col("unit").isNotNull()), self.registry, ["ord"], self.start_sku, self.parts
        )
        generated = fresh.select("family", "ord", "color", "unit", "sku")
        inputs = todo.select("family", "ord", "color", "unit", "skip")
        return merge_variants(inputs, self.old_variants, generated, "family", self.parts)

    @cached_property
    def products(self) -> DataFrame:
        """Old and new products after the run: family, ord, n_variants, is_new."""
        new = self.variants.groupBy("family").agg(F.count(F.lit(1)).alias("n_variants")).join(self.families.select("family", "ord"), "family")
        old = self.old_variants.groupBy("family").agg(F.min("ord").alias("ord"), F.count(F.lit(1)).alias("n_variants"))
        return upsert(old, new, ["family"], "ord")

    @cached_property
    def summary(self) -> DataFrame:
        ok = F.col("status").startswith("ok")
        return self.families.agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(ok).alias("successful"),
            F.count_if(F.col("status") == "skipped").alias("skipped"),
            F.count_if(F.col("status") == "failed").alias("failed"),
            F.count_if(ok & (F.col("warnings") > 0)).alias("with_warnings"),
            F.sum("n_skipped").alias("variants_skipped"),
        )
