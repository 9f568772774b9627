"""URLs, identifiers in URLs, media links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.arrays import distinct_items, first_items

# --------------------------------------------------------------------------
# File names, patterns and link forms of the stores.
# --------------------------------------------------------------------------
DIRECT_VIDEO_NAMES = (
    "movie_max_vp9.webm",
    "movie480_vp9.webm",
    "movie_max.webm",
    "movie480.webm",
    "movie_max.mp4",
    "movie480.mp4",
)
EMBEDDED_VIDEO_PATTERN = (
    r"""(https://shared\.fastly\.steamstatic\.com/store_item_assets/steam/apps/\d+/extras/[^"'<>\s]+\.webm)"""
)
TRAILER_PATTERNS = (
    r"""(https://video\.[^"'<>\s]+/store_trailers/[^"'<>\s]+/movie480_vp9\.webm)""",
    r"""(https://video\.[^"'<>\s]+/store_trailers/[^"'<>\s]+/movie_max_vp9\.webm)""",
    r"""(https://video\.[^"'<>\s]+/store_trailers/[^"'<>\s]+/movie480\.webm)""",
    r"""(https://cdn\.[^"'<>\s]+/steam/apps/\d+/movie480\.webm)""",
)
EXCLUDED_VIDEO_WORDS = ("steamdeck", "hardware")
CONSTRUCTED_VIDEO = ("https://cdn.akamai.steamstatic.com/steam/apps/", "/movie480.webm")
TRAILERS_SCHEMA = "trailers array<struct<hlsManifest string, dashManifests array<string>>>"


def product_id(url: Column) -> Column:
    """Digits between a slash and a dash."""
    return F.nullif(F.regexp_extract(url, r"/(\d+)-", 1), F.lit(""))


def app_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"/app/(\d+)/", 1), F.lit(""))


def count_in_brackets(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"\((\d+)\)", 1), F.lit(""))


def first_decimal(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"([\d.]+)", 1), F.lit(""))


def review_number(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(\d+)\s*Review", 1), F.lit(""))


def absolute_url(url: Column, host: str) -> Column:
    """``//x`` gets a scheme, ``/x`` gets the host, other links stay."""
    return (
        F.when(F.startswith(url, F.lit("//")), F.concat(F.lit("https:"), url))
        .when(F.startswith(url, F.lit("/")), F.concat(F.lit(host), url))
        .otherwise(url)
    )


def full_size_screenshot(url: Column) -> Column:
    """Thumbnail link -> full-size link by the dimension in its name."""
    wide = F.replace(url, F.lit("116x65"), F.lit("1920x1080"))
    return F.replace(wide, F.lit(".116x65"), F.lit(""))


def large_image(url: Column) -> Column:
    """``_256.``, ``-512.`` and ``_thumb.`` variants -> the 1024 variant."""
    return F.regexp_replace(url, r"([_-])(256|512|thumb)\.", "$11024.")


def direct_video_urls(manifest: Column) -> Column:
    """Candidate direct files next to a streaming manifest, best first."""
    base = F.concat(F.substring_index(manifest, "/hls_", 1), F.lit("/"))
    return F.array(*[F.concat(base, F.lit(name)) for name in DIRECT_VIDEO_NAMES])


def unescaped_json(attribute: Column) -> Column:
    """JSON text of an escaped HTML attribute."""
    text = F.replace(attribute, F.lit("&quot;"), F.lit('"'))
    text = F.replace(text, F.lit("&amp;"), F.lit("&"))
    return F.replace(text, F.lit("\\/"), F.lit("/"))


def trailer_urls(attribute: Column, most: int | None = None) -> Column:
    """One link per trailer (of the first ``most``): direct file from its HLS manifest, else DASH."""
    trailers = first_items(F.from_json(unescaped_json(attribute), TRAILERS_SCHEMA)["trailers"], most)

    def link(trailer: Column) -> Column:
        hls = F.nullif(trailer["hlsManifest"], F.lit(""))
        dash = F.get(trailer["dashManifests"], 0)
        return F.when(hls.isNotNull(), F.get(direct_video_urls(hls), 0)).otherwise(dash)

    links = F.transform(trailers, link)
    return F.coalesce(F.array_compact(links), F.array().cast("array<string>"))


def page_video_urls(html: Column, most: int | None = None) -> Column:
    """Links found in the page source, embedded files (the first ``most``) before trailers, excluded words dropped."""
    embedded = first_items(F.regexp_extract_all(html, F.lit(EMBEDDED_VIDEO_PATTERN), 1), most)
    trailers = F.concat(*[F.regexp_extract_all(html, F.lit(p), 1) for p in TRAILER_PATTERNS])
    allowed = F.filter(trailers, lambda u: ~F.lower(u).rlike("|".join(EXCLUDED_VIDEO_WORDS)))
    return F.array_distinct(F.concat(embedded, allowed))


def video_urls(
    embedded: Column, attribute: Column, source_links: Column, page_url: Column, most: int | None = None
) -> Column:
    """Distinct video links: embedded, JSON trailers, page source, constructed.

    ``source_links`` are the page's own links as found by ``page_video_urls``. With ``most``, so many links
    are kept, and a later step only adds links while fewer are known. The constructed link is
    used when nothing else was found.
    """
    lacking = lambda links: F.lit(True) if most is None else F.size(links) < most
    none = F.array().cast("array<string>")
    own = first_items(F.filter(F.coalesce(embedded, none), lambda u: u.contains("store_item_assets")), most)
    with_trailers = F.when(lacking(own), F.concat(own, trailer_urls(attribute, most))).otherwise(own)
    found = F.when(lacking(with_trailers), F.concat(with_trailers, source_links)).otherwise(with_trailers)
    number = app_id(page_url)
    constructed = F.when(
        number.isNotNull(), F.array(F.concat(F.lit(CONSTRUCTED_VIDEO[0]), number, F.lit(CONSTRUCTED_VIDEO[1])))
    ).otherwise(none)
    return distinct_items(F.when(F.size(found) > 0, found).otherwise(constructed), most)


def video_extension(url: Column) -> Column:
    """Streaming manifests are kept as text notes, the rest by file type."""
    return (
        F.when(url.contains(".m3u8") | url.contains(".mpd"), F.lit(".txt"))
        .when(url.contains(".mp4"), F.lit(".mp4"))
        .otherwise(F.lit(".webm"))
    )


def plain_video_extension(url: Column) -> Column:
    return F.when(F.lower(url).contains(".mp4"), F.lit(".mp4")).otherwise(F.lit(".webm"))


def image_extension(url: Column) -> Column:
    lowered = F.lower(url)
    return (
        F.when(lowered.contains(".png"), F.lit("png"))
        .when(lowered.contains(".webp"), F.lit("webp"))
        .otherwise(F.lit("jpg"))
    )
