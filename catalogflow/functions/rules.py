"""Page rules: per site, ordered patterns for each field. Fixed values; the engine is in operators/pages.py."""

from __future__ import annotations

H1 = r"(?is)<h1[^>]*>(.*?)</h1>"
AFTER_H1 = r"(?is)</h1>\s*<p[^>]*>(.*?)</p>"
OG_IMAGE = r"""(?i)<meta[^>]+(?:property|name)=["']og:image["'][^>]*content=["']([^"']+)["']"""

# Text fields -> ordered patterns (first hit wins); list fields -> (block pattern or None, item pattern).
PAGE_RULES = {
    "details": {
        "title": [r'(?is)<h4[^>]*class="[^"]*product-details__product-name[^"]*"[^>]*>(.*?)</h4>'],
        "brand": [r'(?is)/products/search/\?[^"]*brand=[^"&]+"[^>]*>(.*?)</a>'],
        "description": [
            r"(?is)<h3[^>]*>\s*Description\s*</h3>\s*<p[^>]*>(.*?)</p>",
            r'(?is)<div[^>]+id="description"[^>]*>.*?<p[^>]*>(.*?)</p>',
        ],
        "benefits": (None, r'(?is)<li[^>]*class="[^"]*key-benefits[^"]*"[^>]*>(.*?)</li>'),
    },
    "bullets": {
        "title": [H1],
        "description": [AFTER_H1],
        "benefits": (r"(?is)</p>\s*<ul>(.*?)</ul>", r"(?is)<li[^>]*>(.*?)</li>"),
    },
    "lead": {
        "title": [H1],
        "description": [r'(?is)<div class="lead">\s*<p>(.*?)</p>', AFTER_H1],
        "ingredients": [r"(?is)<h3>Ingredients</h3>(.*?)</div>"],
        "analysis": [r"(?is)<h3>Guaranteed Analysis</h3>(.*?)</ul>"],
        "calories": [r"(?is)<h3>Caloric Content</h3>(.*?)</section>"],
        "sizes": [r"(?i)<h3>Available Sizes</h3>\s*<p>(.*?)</p>"],
        "breadcrumbs": (r'(?is)<p class="breadcrumbs.*?">\s*(.*?)</p>', r">([^<]+)</a>"),
    },
    "blog": {
        "title": [
            r'(?is)<div[^>]+class="summary[^"]*"[^>]*>.*?<h4[^>]*>(.*?)</h4>',
            r'(?is)<h1[^>]*class="product_title[^"]*"[^>]*>(.*?)</h1>',
            r'(?is)<h1[^>]*class="entry-title[^"]*"[^>]*>(.*?)</h1>',
            r'(?i)<meta[^>]+itemprop="name"[^>]+content="([^"]+)"',
            r'(?i)<meta[^>]+property="og:title"[^>]+content="([^"]+)"',
        ],
        "description": [
            r'(?is)<div[^>]+class="woocommerce-product-details__short-description"[^>]*>(.*?)</div>',
            r'(?is)<div[^>]+class="description"[^>]*>.*?<p[^>]*>(.*?)</p>',
            r'(?i)<meta[^>]+name="description"[^>]+content="([^"]+)"',
        ],
    },
    "article": {
        "title": [r"(?is)<title>(.*?)</title>"],
        "heading": [H1],
        "description": [r"(?is)<p>(.*?)</p>"],
        "benefits": (None, r"(?is)<li>(.*?)</li>"),
        "links": (None, r'href="([^"]+)"'),
    },
}

# Product-page marks and site marks.
PRODUCT_PAGE_MARKS = [
    'class="product-info-main"', 'data-gallery-role="gallery"', '"@type":"Product"', "'@type':'Product'",
]
DESCRIPTION_BLOCK = (
    r'(?is)(<div[^>]+class="[^"]*(?:product[^"]*description|description[^"]*product)[^"]*"[^>]*>.*?</div>)'
)
