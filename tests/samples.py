"""Fixed samples and paths that several test modules use."""

from __future__ import annotations

# Lines of the grocery product catalogue used by the unit tests, chosen by product.
PRODUCTS = {"butter", "butter milk", "chocolate", "citrus fruit", "coffee", "cream", "domestic eggs", "flower (seeds)", "ham",
            "hamburger meat", "instant coffee", "liquor (appetizer)", "margarine", "ready soups", "semi-finished bread",
            "whipped/sour cream"}


def _catalog_lines():
    from grocery_catalog import GROCERY_CATALOG
    lines = [x if isinstance(x, str) else ", ".join(x) for x in GROCERY_CATALOG]
    return sorted(x for x in lines if x.split(",")[0] in PRODUCTS)


CATALOG_LINES = _catalog_lines()

# The incoming example basket (customer 5) and its 12 categories.
EXAMPLE_LINE = "citrus fruit,semi-finished bread,margarine,ready soups"
EXAMPLE_CATEGORIES = [
    "Baguettes-Loaves", "Bakery-Bread", "Bread-Bakery", "Butter-Sour-Cream", "Canned-Goods-Soups", "Citrus",
    "Dairy-Eggs-Cheese", "Fresh-Fruits", "Fruits-Vegetables", "Margarine-Spreads", "Ready-to-Serve-Soup",
    "Soup-Broth-Bouillon",
]

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"
