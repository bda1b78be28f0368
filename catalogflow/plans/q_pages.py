"""Page extraction over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rules import PAGE_RULES
from ..functions.urls import strip_query
from ..operators import dom as D
from ..operators import pages as P
from ..operators.skew import spread
from .q_scalars import WS, re
from .registry import big, query, text


def sql_text(value: str) -> str:
    """text_only in DuckDB for the entities the pages use."""
    bare = re(re(value, r"(?i)<\s*br\s*/?>", "chr(10)"), "<[^>]+>")
    return f"trim(replace(replace(replace(replace({bare}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&'), {WS})"


def sql_items(pattern: str, html: str = "html") -> str:
    """Distinct non-blank texts of all matches, first-seen order, joined."""
    items = f"list_filter(list_transform(regexp_extract_all({html}, '{pattern}', 1), lambda x: {sql_text('x')}), lambda x: x <> '')"
    return f"array_to_string(list_filter({items}, lambda x, i: list_position({items}, x) = i), '|')"


@query(
    "I4_extract_pages",
    f"""SELECT page_id, url, {sql_text("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")} AS title, {sql_text("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} AS heading,
    {sql_text("regexp_extract(html, '(?is)<p>(.*?)</p>', 1)")} AS description, {sql_items('(?is)<li>(.*?)</li>')} AS benefits FROM pages""",
)
def i4(t):
    out = P.extract_pages(t.pages, {"article": PAGE_RULES["article"]}, F.lit("article"))
    return out.select("page_id", "url", "title", "heading", "description", F.array_join("benefits", "|").alias("benefits"))


def product_html(t):
    """Parts as product pages in the shapes the per-site rules expect, the shape chosen by part type."""
    name, kind, key, brand = F.col("p_name"), F.col("p_type"), text("p_partkey"), F.col("p_brand")
    details = F.concat(
        F.lit('<h4 class="x product-details__product-name">'), name, F.lit('</h4><a href="/products/search/?brand=b">'), brand,
        F.lit("</a><h3> Description </h3> <p>No "), key, F.lit('</p><ul><li class="key-benefits a">Fits '), brand, F.lit("</li></ul>"),
    )
    bullets = F.concat(F.lit("<h1>"), name, F.lit("</h1> <p>No "), key, F.lit("</p><ul><li>Fits "), brand, F.lit("</li></ul>"))
    lead = F.concat(F.lit("<h1>"), name, F.lit('</h1><div class="lead"> <p>No '), key, F.lit("</p></div><h3>Ingredients</h3>a,b</div>"))
    blog = F.concat(F.lit('<h1 class="entry-title">'), name, F.lit('</h1><meta name="description" content="No '), key, F.lit('">'))
    html = F.when(kind == "SMALL", details).when(kind == "LARGE", bullets).when(kind == "PROMO", lead).otherwise(blog)
    site = F.when(kind == "SMALL", "details").when(kind == "LARGE", "bullets").when(kind == "PROMO", "lead").otherwise("blog")
    return t.part.select("p_partkey", html.alias("html"), site.alias("site"))


@query(
    "I4_extract_pages_by_site",
    """SELECT p_partkey, p_name AS title, 'No ' || p_partkey AS description, CASE p_type WHEN 'SMALL' THEN p_brand ELSE '' END AS brand,
    CASE WHEN p_type IN ('SMALL', 'LARGE') THEN 'Fits ' || p_brand ELSE '' END AS benefits, CASE p_type WHEN 'PROMO' THEN 'a,b' ELSE '' END AS ingredients FROM part""",
)
def i4_sites(t):
    out = P.extract_pages(product_html(t), PAGE_RULES, F.col("site"))
    return out.select("p_partkey", "title", "description", "brand", F.array_join("benefits", "|").alias("benefits"), "ingredients")


@query(
    "I5_extract_dom",
    """SELECT page_id, tag, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)[ >/]', 1)) AS tag FROM pages) GROUP BY 1, 2""",
)
def i5(t):
    nodes = D.dom_nodes(t.pages, "page_id", inner_of=[])
    return nodes.groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n"))


@query(
    "I5_nav_links",
    f"""WITH n AS (SELECT page_id, unnest(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '(<a href="[^"]*">[^<]*</a>)', 1)) AS a FROM pages)
    SELECT page_id, regexp_extract(a, 'href="([^"]*)"', 1) AS href, {sql_text("regexp_extract(a, '>([^<]*)<', 1)")} AS label FROM n""",
)
def i5_nav(t):
    nodes = D.dom_nodes(t.pages, "page_id", inner_of=["a"])
    links = D.within(nodes.filter("tag = 'a'"), nodes.filter("tag = 'nav'"), "page_id")
    return links.select("page_id", F.col("attrs")["href"].alias("href"), D.node_text().alias("label"))


def tree_html(t):
    key, name, brand = text("p_partkey"), F.col("p_name"), F.col("p_brand")
    html = F.concat(
        F.lit('<html><body><button data-bs-target="#t2"> Features </button><div id="t1"><ul><li>no</li></ul></div><div id="t2"><p>x</p><ul><li>'), name,
        F.lit("</li><li> </li><li>Fits "), brand, F.lit('</li></ul></div><ul class="pd accordion"><li class="accordion-item"><a class="accordion-title">Other</a>'),
        F.lit('<div class="accordion-content"><a href="/o.pdf">o</a></div></li><li class="accordion-item"><a class="accordion-title">Additional Materials</a>'),
        F.lit('<div class="accordion-content"><p><a href="/getmedia/'), key, F.lit('"></a><a href="/'), key, F.lit('.PDF">Sheet</a><a href="/no">n</a></p></div></li></ul>'),
        F.lit("<h3>Care</h3><p>wash</p><h3>Materials</h3><div><p>made of "), brand, F.lit('</p></div><h4>Features</h4><ol><li>Big '), name,
        F.lit('</li></ol><span id="lblB">'), name, F.lit('</span><span id="lblA"> </span><div class="swatch-attribute style"><i class="swatch-option" data-option-label="'),
        brand, F.lit('"></i><i class="swatch-option">'), name, F.lit('</i></div><div class="product-tabs"><section>Feeding directions<ul id="x"><li>'), key,
        F.lit('</li></ul></section><section>Guaranteed Analysis<table class="t"><tr><td>'), name, F.lit('</td></tr></table></section></div><span class="price-lead" data-rate="'),
        text("p_size"), F.lit('">x</span></body></html>'),
    )
    # pages are built and parsed by all cores, however few files and row groups the short rows come from
    return spread(t.part.select("p_partkey", "p_name", "p_brand", "p_size"), "p_partkey").select("p_partkey", html.alias("html"))


@query(
    "I5_selectors",
    """SELECT p_partkey, 'tab' AS rule, p_name AS value FROM part UNION ALL SELECT p_partkey, 'tab', 'Fits ' || p_brand FROM part
    UNION ALL SELECT p_partkey, 'document', 'Document|/getmedia/' || p_partkey FROM part UNION ALL SELECT p_partkey, 'pdf', 'Sheet|/' || p_partkey || '.PDF' FROM part
    UNION ALL SELECT p_partkey, 'material', 'made of ' || p_brand FROM part UNION ALL SELECT p_partkey, 'list', 'Big ' || p_name FROM part
    UNION ALL SELECT p_partkey, 'label', p_name FROM part UNION ALL SELECT p_partkey, 'swatch', p_brand FROM part UNION ALL SELECT p_partkey, 'swatch', p_name FROM part
    UNION ALL SELECT p_partkey, 'directions', '<ul><li>' || p_partkey || '</li></ul>' FROM part UNION ALL SELECT p_partkey, 'price', '$' || p_size || '.00' FROM part
    UNION ALL SELECT p_partkey, 'analysis', '<table><tr><td>' || p_name || '</td></tr></table>' FROM part""",
)
def i5_selectors(t):
    from ..session import materialize

    k = "p_partkey"
    # pages are parsed once for all selectors
    nodes = materialize(D.dom_nodes(tree_html(t), k))
    parts = [
        D.tab_list(nodes, k, "features").select(k, F.lit("tab").alias("rule"), F.col("text").alias("value")),
        D.accordion_documents(nodes, k).select(k, "type", F.concat_ws("|", "title", "url")),
        D.text_after_heading(nodes, k, "material").select(k, F.lit("material"), "text"),
        D.list_after_heading(nodes, k, "features").select(k, F.lit("list"), "text"),
        D.text_by_id(nodes, k, ["lblA", "lblB"]).select(k, F.lit("label"), "text"),
        D.swatch_labels_of_page(nodes, k).select(k, F.lit("swatch"), "label"),
        D.tab_section(nodes, k, ["feeding direction", "directions for use"], "ul").select(k, F.lit("directions"), "html"),
        D.tab_section(nodes, k, ["guaranteed analysis", "nutrient"], "table").select(k, F.lit("analysis"), "html"),
        D.priced_element(nodes, k, "price-lead").select(k, F.lit("price"), "price"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def variant_html(t):
    key, name = text("p_partkey"), F.col("p_name")
    html = F.concat(
        F.lit('<select name="id"><option value="'), key, F.lit('">'), text("p_size"), F.lit(" LB / "), name, F.lit(" - $1,0"), text("p_size"),
        F.lit('.5</option><option>none</option></select><script>var product = {"variants":[{"id":'), key, F.lit(',"sku":"s","price":'), text("p_size"),
        F.lit('00,"option1":"'), name, F.lit('","featured_image":{"position":1,"src":"/i.png","alt":"a"}}],"media":[{"position":2,"media_type":"external_video","host":"youtube","external_id":"'),
        key, F.lit('","alt":"v"}]};</script>'),
    )
    return t.part.select("p_partkey", html.alias("html"))


@query(
    "I6_extract_variants",
    """SELECT p_partkey, 'select' AS source, CAST(p_partkey AS VARCHAR) AS variant_id, p_size || ' LB' AS option1, p_name AS option2, '10' || p_size || '.5' AS price FROM part
    UNION ALL SELECT p_partkey, 'json', CAST(p_partkey AS VARCHAR), p_name, '', CAST(CAST(p_size AS DOUBLE) AS VARCHAR) FROM part
    UNION ALL SELECT p_partkey, 'media', '2', 'https://www.youtube.com/watch?v=' || p_partkey, 'v', '' FROM part""",
)
def i6(t):
    pages, k = variant_html(t), "p_partkey"
    chosen = P.select_variants(pages, k).select(k, F.lit("select").alias("source"), "variant_id", F.col("size").alias("option1"), F.col("material").alias("option2"), "price")
    embedded = P.embedded_variants(pages, k).select(k, F.lit("json"), "variant_id", "option1", "option2", F.col("price").cast("string"))
    media = P.embedded_media(pages, k).select(k, F.lit("media"), text("position"), "src", "alt", F.lit(""))
    return chosen.union(embedded).union(media)


@query(
    "I7_extract_gallery",
    """WITH h AS (SELECT page_id, list_filter(list_transform(regexp_extract_all(html, 'href="(/[A-Z][^"]*)"', 1), lambda u: regexp_replace(u, '[?#].*$', '')), lambda u: u <> '') AS a,
      list_transform(regexp_extract_all(html, 'href="([^"]+)"', 1), lambda u: regexp_replace(u, '[?#].*$', '')) AS b FROM pages),
    g AS (SELECT page_id, CASE WHEN len(a) > 0 THEN a ELSE b END AS l, len(a) > 0 AS first_chain FROM h)
    SELECT page_id, array_to_string(list_filter(l, lambda u, i: list_position(l, u) = i AND u <> '/The'), ' ') AS images FROM g""",
)
def i7(t):
    html = F.col("html")
    upper = P.attribute_values(html, 'href="(/[A-Z][^"]*)"')
    every = P.attribute_values(html, 'href="([^"]+)"')
    images = P.extract_gallery(P.json_ld_images(html), P.gallery_json(html), upper, every, P.og_image(html), swatches=F.array(F.lit("/The")), clean=strip_query)
    return t.pages.select("page_id", F.array_join(images, " ").alias("images"))


@query(
    "I7_gallery_sources",
    """SELECT p_partkey, 'https://x/' || p_partkey || '.png https://x/b.png' AS ld, '/full/' || p_partkey || '.jpg' AS data, '/og/' || p_partkey AS og,
    'https://x/s.png /d.png /big' || p_partkey || '.png' AS block FROM part""",
)
def i7_sources(t):
    rows, h = gallery_html(t), F.col("html")
    block = r'(?is)<div[^>]+class="[^"]*product-details__preview-images[^"]*"[^>]*>(.*?)</div>'
    return rows.select(
        "p_partkey", F.array_join(P.extract_gallery(P.json_ld_images(h)), " ").alias("ld"), F.array_join(P.extract_gallery(P.gallery_json(h)), " ").alias("data"),
        F.array_join(P.og_image(h), " ").alias("og"), F.array_join(P.extract_gallery(P.block_images(h, block)), " ").alias("block"),
    )


def gallery_html(t):
    """Parts as pages with images in every place the gallery is read from, dealt over all tasks before they are parsed."""
    key = text("p_partkey")
    html = F.concat(
        F.lit('<script type="application/ld+json">{"@type":"Product","image":["http://x/'), key, F.lit('.png?v=1","http://x/b.png"]}</script>'),
        F.lit('<script data-gallery-role="gallery">{"data":[{"type":"image","full":"/full/'), key, F.lit('.jpg"},{"type":"video","full":"/v"}]}</script>'),
        F.lit('<meta property="og:image" content="/og/'), key, F.lit('"><div class="a product-details__preview-images"><img src="http://x/s.png" data-src="/d.png" srcset="/small 1x, /big'),
        key, F.lit('.png 2x"></div>'),
    )
    return spread(t.part.select("p_partkey"), "p_partkey").select("p_partkey", html.alias("html"))


@query(
    "I8_classify_page",
    """SELECT page_id, CASE WHEN url LIKE '%/fr/%' THEN 'shop' WHEN url LIKE '%example.com%' THEN 'shop' WHEN url LIKE '%example.net%' THEN 'www' WHEN url LIKE '%/de/%' THEN 'www' ELSE 'shop' END AS site,
    url LIKE '%/en/%' AS is_product FROM pages""",
)
def i8(t):
    url = F.col("url")
    og = F.when(url.contains("/de/"), "https://info.site/x").otherwise("https://else.site")
    link = F.when(url.contains("example.com"), "https://buy.site/p").when(url.contains("example.net"), "https://info.site/p").otherwise("/p")
    html = F.concat(
        "html", F.lit('<link rel="canonical" href="'), link, F.lit('"><meta property="og:url" content="'), og, F.lit('">'),
        F.when(url.contains("/fr/"), " Shopify ").otherwise(""), F.when(url.contains("/en/"), '<div class="product-info-main">').otherwise(""),
    )
    rows = t.pages.select("page_id", html.alias("html"))
    return rows.select("page_id", P.classify_page(F.col("html"), "buy.site", "info.site").alias("site"), P.is_product_page(F.col("html")).alias("is_product"))


@query(
    "I9_build_index",
    f"""WITH b AS (SELECT page_id, regexp_extract(url, '/(en|fr|de|es)/', 1) AS category, unnest(regexp_extract_all(html, '(?s)(<a href="/[^"]*">.*?</a>)', 1)) AS a,
      unnest(range(len(regexp_extract_all(html, '(?s)(<a href="/[^"]*">.*?</a>)', 1)))) AS pos FROM pages),
    p AS (SELECT page_id, pos, regexp_extract(a, 'href="/([^"]*)"', 1) AS prodid, {sql_text("regexp_extract(a, '(?s)>(.*)</a>', 1)")} AS title, regexp_extract(a, 'href="([^"]*)"', 1) AS url, category FROM b)
    SELECT prodid, first(title ORDER BY page_id, pos) AS title, first(url ORDER BY page_id, pos) AS url, first(category ORDER BY page_id, pos) AS category FROM p WHERE prodid <> '' AND title <> '' GROUP BY 1""",
)
def i9(t):
    category = F.regexp_extract("url", "/(en|fr|de|es)/", 1)
    return P.build_index(t.pages, "page_id", r'(?s)(<a href="/[^"]*">.*?</a>)', 'href="/([^"]*)"', "(?s)>(.*)</a>", category)


@query(
    "I10_build_portal_index",
    """SELECT p_partkey AS sku, CASE WHEN p_name LIKE 'red%' THEN p_name ELSE 'Red Stone ' || p_name END AS title,
    CASE WHEN p_size > 30 THEN '/item-' || p_partkey WHEN p_size > 15 THEN '/product/' || p_partkey ELSE '/pavers/red-stone' END AS url, '/pavers/red-stone' AS category,
    CAST(p_retailprice AS VARCHAR) AS price, CAST(p_size AS BIGINT) AS stock, '/a/' || p_partkey AS images FROM part WHERE p_name NOT LIKE 'red%'
    UNION ALL SELECT p_partkey, 'Red Stone ' || p_name, CASE WHEN p_size > 30 THEN '/item-' || p_partkey WHEN p_size > 15 THEN '/product/' || p_partkey ELSE '/pavers/red-stone' END,
    '/pavers/red-stone', CAST(p_retailprice AS VARCHAR), p_size, '/a/' || p_partkey FROM part WHERE p_name LIKE 'red%'""",
)
def i10(t):
    size, key = F.col("p_size"), text("p_partkey")
    named = F.when(F.col("p_name").startswith("red"), F.concat(F.lit("Red Stone "), "p_name")).otherwise(F.col("p_name"))
    items = t.part.select(
        named.alias("displayname"), F.when(size > 30, F.concat(F.lit("/accessories/x/item-"), key)).otherwise("").alias("urlcomponent"),
        F.when(size > 15, F.col("p_partkey")).alias("internalid"), F.col("p_partkey").alias("itemid"), F.col("p_retailprice").alias("price"),
        size.alias("stock"), F.array(F.concat(F.lit("/a/"), key), F.lit("")).alias("images"), F.lit("/pavers/red-stone").alias("category"),
    )
    out = P.build_portal_index(items)
    return out.withColumn("images", F.array_join("images", " "))


@query(
    "I11_description_sections",
    """SELECT p_partkey, 'Material: ' || p_name || ' Made in ' || p_brand AS description, 'Size ' || p_size || '|' || lower(p_type) AS benefits FROM part""",
)
def i11(t):
    lines = F.concat(
        F.lit("Price 3<br>Size "), text("p_size"), F.lit("<br/>Material: "), "p_name", F.lit("<br><b>"), F.lower("p_type"), F.lit("</b><BR />Size "), text("p_size"),
        F.lit("<br>Made in "), "p_brand",
    )
    block = F.concat(F.lit('<div class="product-description">'), lines, F.lit("</div>"))
    window = F.concat(F.lit("<p>x</p>MSRP: 5<br>"), lines, F.lit("<br>Share this y"))
    rows = t.part.select("p_partkey", F.when(F.col("p_size") > 20, block).otherwise(window).alias("html"))
    description, benefits = P.description_sections(F.col("html"))
    return rows.select("p_partkey", description.alias("description"), F.array_join(benefits, "|").alias("benefits"))
