"""Where each store's pages hold each field.

A field is (selector, attribute): the attribute's values, or the elements' texts if None. An
empty selector means the record root. A group lists parts of repeated elements, one text per
element, so that a label and its content stay side by side.
"""

from __future__ import annotations

from shelfwise.schemas import SOURCE_A, SOURCE_B, SOURCE_C

# --------------------------------------------------------------------------
# Selectors of the stores' markup.
# --------------------------------------------------------------------------
LISTINGS = {
    SOURCE_A: {
        "root": "#search_resultsRows > a",
        "fields": {
            "href": ("", "href"),
            "title": (".title", None),
            "released": (".search_released", None),
            "discount": (".discount_block .discount_pct", None),
            "original": (".discount_block .discount_original_price", None),
            "final": (".discount_block .discount_final_price", None),
            "label": (".search_price", None),
            "review": (".search_review_summary", "data-tooltip-html"),
            "win": (".platform_img.win", "class"),
            "mac": (".platform_img.mac", "class"),
            "linux": (".platform_img.linux", "class"),
        },
    },
    SOURCE_B: {
        "root": "article.item",
        "fields": {
            "href": ("a.cover, a.picture, a[href*='/en/']", "href"),
            "title_attr": (".name .title, .title, h3", "title"),
            "title": (".name .title, .title, h3", None),
        },
    },
    SOURCE_C: {
        "root": "[class*='product-tile'], [class*='game-card'], a[href*='/game/']",
        "fields": {
            "href": ("", "href"),
            "badge": ("[class*='badge'], [class*='label'], [class*='tag']", None),
            "title": (".product-title, [class*='title'], h3, h2", None),
            "aria": ("", "aria-label"),
            "price": ("[class*='price'], .price-value", None),
        },
    },
}

DETAILS = {
    SOURCE_A: {
        "companies": ("#appHeaderGridContainer .grid_content", None),
        "genres": (".details_block a[href*='genre']", None),
        "categories": (".game_area_features_list_ctn a", None),
        "requirements": (".game_area_sys_req_leftCol, .sysreq_contents", None),
        "header": (".game_header_image_full", "src"),
        "shots": (".highlight_screenshot img, .screenshot_holder img", "src"),
        "embedded": ("video source[src*='.webm'], video source[src*='.mp4']", "src"),
        "carousel_1": (".gamehighlight_desktopcarousel[data-props]", "data-props"),
        "carousel_2": ("[data-featuretarget='gamehighlight-desktopcarousel'][data-props]", "data-props"),
        "carousel_3": ("div[data-props*='trailers']", "data-props"),
        "carousel_4": ("[class*='gamehighlight'][data-props]", "data-props"),
    },
    SOURCE_B: {
        "total": (".amount .total", None),
        "retail": (".amount .discounts .retail", None),
        "discounted": (".amount .discounted", None),
        "stock": (".stock span", None),
        "author": ("meta[itemprop='author']", "content"),
        "publisher": ("meta[itemprop='publisher']", "content"),
        "platform": ("meta[itemprop='gamePlatform']", "content"),
        "genre": ("tr.genres a.tag", None),
        "released": ("tr.release-date th:nth-child(2)", None),
        "description": ("span[itemprop='description']", None),
        "product_text": (".product-text .text", None),
        "rating": (".ig-search-reviews-avg", None),
        "based": (".based .link", None),
        "tags": (".users-tags a.searchtag", None),
        "features": (".features-listing a.feature .feature-text", None),
        "minimal": (".minimal ul.specs li", None),
        "recommended": (".recommended ul.specs li", None),
        "header": ("meta[itemprop='image']", "content"),
        "video": ("#ig-vimeo-player", "src"),
        "shots": (".screenshots a[itemprop='screenshot']", "href"),
    },
    SOURCE_C: {
        "score": (".productcard-rating__score--version-a, .productcard-rating__score--version-b", None),
        "inline_score": (".productcard-rating--inline .rating", None),
        "reviews_a": (".productcard-rating__details-reviews--version-a", None),
        "reviews_b": (".productcard-rating__details-reviews--version-b", None),
        "reviews": (".productcard-rating__details", None),
        "summary": (".content-summary-item__description", None),
        "meta": ("meta[property='og:description'], meta[name='description']", "content"),
        "genre_links": ("a[href*='/games?genres=']", None),
        "icons": (".productcard-os-support__system", "class"),
        "header": ("meta[property='og:image']", "content"),
        "cover": ("img[src*='cover'], .productcard-cover img, [class*='hero-image'] img", "src"),
        "shots_1": ("img[src*='screenshots']", "src"),
        "shots_2": ("img[src*='/gallery/']", "src"),
        "shots_3": (".media-gallery img", "src"),
        "shots_4": ("[class*='screenshot'] img", "src"),
        "videos_1": ("video source[src]", "src"),
        "videos_2": ("video[src]", "src"),
        "videos_3": ("source[src*='.mp4']", "src"),
        "videos_4": ("source[src*='.webm']", "src"),
    },
}
GROUPS = {
    SOURCE_A: {},
    SOURCE_B: {
        "row": (
            "tr",
            {
                "text": ("", None),
                "second": ("th:nth-child(2)", None),
                "span": ("th:nth-child(2) span", None),
                "span_second": ("th:nth-child(2) span:nth-child(2)", None),
            },
        ),
        "edition": (".editions .item", {"name": (".name h3", None), "price": (".amount .total", None)}),
    },
    SOURCE_C: {
        "row": (
            ".table__row.details__row, .details__row",
            {
                "text": ("", None),
                "label": (".details__category, .table__row-label", None),
                "content": (".details__content, .table__row-content", None),
                "links": (".details__link, a", None),
                "content_links": (".details__content a, .table__row-content a", None),
            },
        ),
        "genre_row": (".table__row.details__row", {"text": ("", None), "links": (".details__link, a", None)}),
    },
}
# How much of a detail page the published extraction keeps, per source.
PUBLISHED_CUTS = {
    SOURCE_A: {"screenshots": 10, "categories": 10, "requirements": 300, "videos": 3},
    SOURCE_B: {"description": 1000, "editions": 5, "screenshots": 10, "tags": 20},
    SOURCE_C: {"genres": 10, "description": 1000, "screenshots": 10, "videos": 5},
}
HOSTS = {
    SOURCE_A: "https://store.steampowered.com",
    SOURCE_B: "https://www.instant-gaming.com",
    SOURCE_C: "https://www.gog.com",
}
