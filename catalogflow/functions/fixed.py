"""Word lists, unit tables and patterns whose values decide the results."""

from __future__ import annotations

# Unit of a size word -> (unit family, factor to the family's base unit).
SIZE_UNITS = {
    "IN": ("IN", 1.0), "INCH": ("IN", 1.0), "INCHES": ("IN", 1.0), '"': ("IN", 1.0),
    "OZ": ("OZ", 1.0), "OUNCE": ("OZ", 1.0), "OUNCES": ("OZ", 1.0),
    "LB": ("OZ", 16.0), "LBS": ("OZ", 16.0), "POUND": ("OZ", 16.0), "POUNDS": ("OZ", 16.0),
    "G": ("G", 1.0), "GRAM": ("G", 1.0), "GRAMS": ("G", 1.0), "KG": ("G", 1000.0),
    "ML": ("ML", 1.0), "MLS": ("ML", 1.0), "L": ("ML", 1000.0), "LITER": ("ML", 1000.0), "LITERS": ("ML", 1000.0),
    "QT": ("QT", 1.0), "QTS": ("QT", 1.0), "QUART": ("QT", 1.0), "QUARTS": ("QT", 1.0),
    "GAL": ("QT", 4.0), "GALS": ("QT", 4.0), "GALLON": ("QT", 4.0), "GALLONS": ("QT", 4.0),
}
SIZE_FAMILIES = ["IN", "OZ", "G", "ML", "QT"]
SIZE_TOLERANCE = 0.08

# Weight words -> (store unit, factor); volumes use feed densities.
WEIGHT_UNITS = {
    "LB": ("lb", 1.0), "LBS": ("lb", 1.0), "POUND": ("lb", 1.0), "POUNDS": ("lb", 1.0),
    "OZ": ("oz", 1.0), "OUNCE": ("oz", 1.0), "OUNCES": ("oz", 1.0),
    "KG": ("kg", 1.0), "KILOGRAM": ("kg", 1.0), "KILOGRAMS": ("kg", 1.0),
    "G": ("g", 1.0), "GRAM": ("g", 1.0), "GRAMS": ("g", 1.0),
    "GAL": ("lb", 7.5), "GALLON": ("lb", 7.5), "GALLONS": ("lb", 7.5),
    "L": ("lb", 1.65), "LITER": ("lb", 1.65), "LITERS": ("lb", 1.65),
    "ML": ("g", 0.75), "MILLILITER": ("g", 0.75), "MILLILITERS": ("g", 0.75),
    "QT": ("lb", 1.875), "QUART": ("lb", 1.875), "QUARTS": ("lb", 1.875),
    "PT": ("lb", 0.9375), "PINT": ("lb", 0.9375), "PINTS": ("lb", 0.9375),
    "FL": ("oz", 1.0), "FLOZ": ("oz", 1.0),
}
GRAMS_PER_UNIT = {"lb": 453.592, "oz": 28.3495, "kg": 1000.0, "g": 1.0}

# Size words that stay in capitals.
UPPERCASE_UNITS = [
    "LB", "LBS", "OZ", "KG", "G", "MG", "ML", "L", "GAL", "QT", "PT", "FL", "CT", "EA", "PK", "BX", "CS",
]

# Keyword matching.
KEYWORD_STOP = [
    "purina", "mills", "feed", "food", "formula", "complete", "original", "with", "and", "for", "high", "fat",
    "balanced", "supplement", "horse", "equine", "active", "senior", "animal", "nutrition",
]
KEYWORD_SYNONYMS = {"equine": "horse", "hen": "poultry", "chicken": "poultry"}
KEYWORD_THRESHOLD = 0.3

# Words dropped from product names before matching.
MAKER_WORDS = r"(?i)\b(?:ETHICAL(?:\s+PRODUCTS?)?|SPOT)\b"
QUANTITY_WORDS = r"(?i)\b(?:COUNT|CT|PACK|PK|BULK|ASSTD|ASST|ASSORTED|EACH|EA|SET|BX|BOX|PDQ|DISPLAY|CASE)\b"
SIZE_WORDS = (
    r"(?i)\b(?:OZ|OUNCES?|LB|LBS?|POUNDS?|G|GRAMS?|KG|MLS?|ML|L|LITERS?|QT|QTS?|QUARTS?|GALS?|GAL|IN|INCH(?:ES)?)\b"
)
FILLER_WORDS = r"(?i)\b(?:WITH|W/|W|AND|&|THE|FOR|OF|TO|PLUS|EXTRA|NEW|OR)\b"
NAME_PUNCTUATION = r'[/"()+,]'

# Canonical flavors, product lines and forms.
FLAVORS = {
    "PEANUT BUTTER": ["PEANUT", "PEANUTBUTTER", "PB", "PEANUT-BUTTER", "PEANUT_BUTTER"],
    "BACON": ["BACON"],
    "APPLE": ["APPLE"],
    "GINGERBREAD": ["GINGERBREAD"],
}
PRODUCT_LINES = {
    "PLAY STRONG": ["PLAYSTRONG", "PLAY-STRONG", "FOAMZ", "SCENT-SATION", "SCENTSATION"],
    "BARRETT": ["BARRETT"],
    "BAMBONE": ["BAMBONE", "BAM-BONE", "BAM BONE"],
    "SKINNEEEZ": ["SKINNEEEZ", "SKINEEZ", "SKINNEEZ"],
}
FORMS = [
    "BALL", "BONE", "TRIPOD", "X-BONE", "XBONE", "WISHBONE", "DINO", "RING", "DISH", "BOWL", "FEEDER", "BRIDGE",
    "CHEW", "TUG", "STICK",
]
# Taxonomy hints, first hit wins.
TAXONOMY_HINTS = [
    ("dish", r"(?i)\b(?:BOWL|DISH|FEEDER|STONEWARE|CERAMIC)\b"),
    ("cat", r"(?i)\b(?:CAT|KITTY|KITTEN|LITTER)\b"),
    ("dog", r"(?i)\b(?:DOG|PUP|PUPPY|CANINE)\b"),
    ("cat", r"(?i)\bSKINNEEEZ|SKINEEZ|SILVER\s*VINE|KITTY|CATNIP|TEASER|LITTER|FEATHER|FELT\b"),
    ("dog", r"(?i)\bPLAY\s*STRONG|BAMBONE|BARRETT\b"),
]

# Label expansions (all words present -> extra label).
LABEL_EXPANSIONS = [(["cow"], "highland cow"), (["black", "bear"], "black bear"), (["cow", "print"], "cow print")]

# Spelling variants of search texts.
TWO_IN_ONE_PATTERNS = [r"(?i)\b2\s*[-x×]?\s*in\s*[-x×]?\s*1\b", r"(?i)\b2in1\b"]
TWO_IN_ONE_FORMS = ["2IN1", "2 IN 1", "2-IN-1", "2in1", "2-in-1", "2 in 1", "2×1", "2 x 1"]
SIZE_PAIR = r"\b(\d+)\s*[xX×/]\s*(\d+)\b"
QUERY_VARIANT_CAP = 12

# HTML cleaning.
DROPPED_ELEMENTS = ["script", "noscript", "svg", "button", "deferred-media", "template", "iframe"]
DROPPED_ATTRIBUTES = [
    "role", "aria-[a-z-]+", "data-[a-z-]+", "style", "class", "id", "(?:sizes|srcset|loading|width|height|alt)",
]
ALT_SKIPPED = ["ea", "each", "none", "", "null"]

# Image and link filters.
SHOPIFY_SUFFIX = (
    r"(?i)_(?:pico|icon|thumb|small|compact|medium|large|grande|[0-9]+x[0-9]+|[0-9]+x)"
    r"(?:_[a-z0-9-]+)*\.(jpe?g|png|gif|webp)$"
)
WORDPRESS_SUFFIX = r"(?i)-\d+x\d+$"
STORE_CDN_MARKS = ["/cdn/shop/", "cdn.shopify.com"]
CATALOG_PATH_MARKS = ["Single%20Item%20Images", "Shared%20Images"]
STOCK_BADGES = ["in stock", "on backorder"]
PRODUCT_IMAGE_WORDS = ["product", "feed", "bag", "amplify", "equine", "horse"]
NON_PRODUCT_IMAGE_WORDS = ["logo", "icon", "favicon", "banner", "mic-w"]
BAD_LINK_PARTS = ["/blog", "/catalogsearch", "/customer", "/account", "/cart", "/privacy", "/terms"]

# Color categories, their order, and vendor types.
COLOR_CATEGORY_ORDER = {"STANDARD COLORS": 0, "COLOR PLUS": 1, "PREMIER COLORS": 2}
COLOR_LIST_TYPO = ("Salmon Toffee/Onyx", "Salmon, Toffee/Onyx")

# List detection in descriptions.
BULLET_MAX_CHARS = 140
DETAIL_LINE = (
    r"(?i)^(Materials?:|Color:|Approx(?:\.|) Measurements?:|Strap|Designed in|Made in|Colors may|Lining patterns)"
)
NOISE_LINE = r"(?i)^(Default Title\b|MSRP\b|Price\b)"
SPEC_LINE = r"(?i)^\s*(Product No\.|UPC Code|Box Qty|Case Qty|Weight)\b"

# First automatic stock number.
FIRST_AUTO_SKU = 50000

# Image quality limits.
MIN_SHARPNESS = 100.0
MAX_HAMMING = 10

# Age in days after which an index is rebuilt.
INDEX_MAX_AGE_DAYS = 7
