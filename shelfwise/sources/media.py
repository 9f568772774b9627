"""Media manifests of records, and registration of stored media files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import urls
from shelfwise.functions.arrays import first_items
from shelfwise.schemas import SOURCE_A, SOURCE_B, SOURCE_C

# --------------------------------------------------------------------------
# Per source, the header's file name, whether images keep their own extension, and
# whether streams become notes; then how many screenshots and videos the published rule lists.
# --------------------------------------------------------------------------
MANIFEST_RULES = {
    SOURCE_A: {"header": "header.jpg", "typed_images": False, "stream_notes": True},
    SOURCE_B: {"header": "cover.jpg", "typed_images": True, "stream_notes": False},
    SOURCE_C: {"header": "header.jpg", "typed_images": False, "stream_notes": False},
}
PUBLISHED_COUNTS = {
    SOURCE_A: {"screenshots": 5, "videos": 3},
    SOURCE_B: {"screenshots": 10, "videos": 0},
    SOURCE_C: {"screenshots": 10, "videos": 5},
}
STORED_NAME = r"game_(\d+)_(.+)$"


def _items(kind: str, links: Column, name) -> Column:
    """Array of (media_type, idx, file_name, media_url) structs."""
    return F.transform(
        links,
        lambda link, i: F.struct(
            F.lit(kind).alias("media_type"),
            (i + 1).cast("int").alias("idx"),
            name(link, (i + 1).cast("string")).alias("file_name"),
            link.alias("media_url"),
        ),
    )


def media_manifest(
    records: DataFrame, source: str, key: str = "url", screenshots: int | None = None, videos: int | None = None
) -> DataFrame:
    """One row per file to fetch: header, screenshots and videos (the first so many, if given), by the source's rule.

    ``records`` has the key, ``header_image`` (text), ``screenshots`` and ``videos`` (arrays).
    The lists are built per record, so nothing is shuffled.
    """
    rule = MANIFEST_RULES[source]
    none = F.array().cast("array<string>")
    header = F.when(
        F.col("header_image").isNotNull() & (F.col("header_image") != "N/A"), F.array("header_image")
    ).otherwise(none)
    shots = first_items(F.coalesce("screenshots", none), screenshots)
    clips = first_items(F.coalesce("videos", none), videos)
    image = urls.image_extension if rule["typed_images"] else lambda link: F.lit("jpg")
    video = urls.video_extension if rule["stream_notes"] else urls.plain_video_extension
    everything = F.concat(
        _items("header", header, lambda link, i: F.lit(rule["header"])),
        _items("image", shots, lambda link, i: F.concat(F.lit("screenshot_"), i, F.lit("."), image(link))),
        _items("video", clips, lambda link, i: F.concat(F.lit("video_"), i, video(link))),
    )
    return records.select(key, F.inline(everything))


def media_files(spark: SparkSession, folder: str, games: DataFrame) -> DataFrame:
    """Rows for stored files named ``game_<id>_<name>`` below ``images`` or ``videos``.

    Only path and length are read, never the bytes. Files of unknown games are left out.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return register_media(files.select("path", "length"), games)


def register_media(files: DataFrame, games: DataFrame) -> DataFrame:
    """Media rows from ``(path, length)`` listings."""
    name = F.element_at(F.split("path", "/"), -1)
    rows = files.select(
        F.nullif(F.regexp_extract(name, STORED_NAME, 1), F.lit("")).try_cast("bigint").alias("game_id"),
        F.when(F.col("path").contains("/videos/"), F.lit("video")).otherwise(F.lit("image")).alias("media_type"),
        F.regexp_extract(name, STORED_NAME, 2).alias("file_name"),
        F.col("path").alias("file_path"),
        F.col("length").alias("file_size"),
    )
    return rows.join(games.select(F.col("id").alias("game_id")), "game_id", "left_semi")
