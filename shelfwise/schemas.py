"""Declared schemas, source mappings and sentinel tokens."""

from __future__ import annotations

# --------------------------------------------------------------------------
# These must equal the values the catalogue data uses.
# --------------------------------------------------------------------------

# The three sources and the scale of their rating column.
SOURCE_A = "Steam"
SOURCE_B = "instant_gaming"
SOURCE_C = "GOG"
SOURCES = (SOURCE_A, SOURCE_B, SOURCE_C)
RATING_SCALE = {SOURCE_A: 100, SOURCE_B: 10, SOURCE_C: 5}

# Text tokens a CSV reader turns into missing values.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
TEXT_NA_TOKENS = ("N/A", "", "n/a", "NA")
RATING_NA_TOKENS = ("N/A", "--", "", "No user reviews")
PLATFORM_NA_TOKENS = ("", "n/a", "none", "null")

# Source column -> standard column, where the two differ.
COLUMN_MAPPINGS = {
    SOURCE_A: {
        "title": "game_title",
        "url": "game_url",
        "rating_score": "rating_raw",
        "price": "current_price_raw",
        "original_price": "original_price_raw",
    },
    SOURCE_B: {
        "title": "game_title",
        "url": "game_url",
        "ig_rating": "rating_raw",
        "genre": "genres",
        "current_price": "current_price_raw",
        "original_price": "original_price_raw",
    },
    SOURCE_C: {
        "title": "game_title",
        "url": "game_url",
        "rating": "rating_raw",
        "rating_count": "review_count",
        "price": "current_price_raw",
        "original_price": "original_price_raw",
        "status_tag": "release_status",
    },
}

# The unified record, in output order.
UNIFIED = {
    "data_source": "string",
    "game_title": "string",
    "release_date": "date",
    "rating": "double",
    "review_count": "string",
    "discounted_price": "double",
    "original_price": "double",
    "discount_percentage": "double",
    "genres": "string",
    "platform": "string",
    "developer": "string",
    "publisher": "string",
    "description": "string",
    "release_status": "string",
    "game_url": "string",
}

# Columns of the three landing files, all text.
SOURCE_COLUMNS = {
    SOURCE_A: (
        "title", "release_date", "original_price", "price", "discount_percentage", "review_summary",
        "rating_score", "rating_percentage", "url", "platforms", "genres", "developer", "publisher",
        "categories", "multiplayer", "singleplayer", "system_requirements_windows", "header_image",
        "screenshots", "videos", "downloaded_images", "downloaded_videos",
    ),
    SOURCE_B: (
        "title", "url", "developer", "publisher", "platforms", "genre", "release_date", "description",
        "current_price", "original_price", "discount_percentage", "currency", "stock_status", "ig_rating",
        "review_count", "steam_recent_reviews", "steam_all_reviews", "steam_review_count", "video_url",
        "header_image", "screenshots", "user_tags", "game_features", "system_requirements_min",
        "system_requirements_rec", "product_id", "editions", "scrape_timestamp",
    ),
    SOURCE_C: (
        "title", "url", "price", "original_price", "discount_percentage", "rating", "rating_count",
        "release_date", "genres", "platforms", "developer", "publisher", "description", "status_tag",
        "screenshots", "videos", "header_image", "downloaded_images", "downloaded_videos",
    ),
}

# Relational model. Prices are exact decimals so that averages do not depend on row order.
MODEL = {
    "games": {
        "id": "bigint",
        "data_source": "string",
        "game_title": "string",
        "release_date": "date",
        "rating": "int",
        "review_count": "bigint",
        "discounted_price": "decimal(12,2)",
        "original_price": "decimal(12,2)",
        "discount_percentage": "double",
        "platform": "string",
        "developer": "string",
        "publisher": "string",
        "description": "string",
        "release_status": "string",
        "game_url": "string",
        "created_at": "timestamp",
    },
    "media_files": {
        "id": "bigint",
        "game_id": "bigint",
        "media_type": "string",
        "file_name": "string",
        "file_path": "string",
        "file_size": "bigint",
        "uploaded_at": "timestamp",
    },
    "genres": {"id": "bigint", "genre_name": "string", "description": "string"},
    "game_genres": {"id": "bigint", "game_id": "bigint", "genre_id": "bigint"},
    "user_reviews": {
        "id": "bigint",
        "game_id": "bigint",
        "user_name": "string",
        "rating": "int",
        "review_text": "string",
        "helpful_count": "bigint",
        "review_date": "timestamp",
    },
}

# Test tables: explicit schemas avoid a schema-inference job per read.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


def text_schema(source: str) -> str:
    """All-text landing schema of one source."""
    return ddl({name: "string" for name in SOURCE_COLUMNS[source]})
