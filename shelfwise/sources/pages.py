"""Store pages -> records.

Python only parses pages inside tasks and returns the values found at each selector, one
Arrow batch in and one out; every rule applied to these values is a Spark expression.
Pages are ``(page_id, url, html)`` rows, so the pages' partitions are the parallelism.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import arrays, numbers, text, urls
from shelfwise.schemas import SOURCE_A, SOURCE_B, SOURCE_C
from shelfwise.sources import html as html_helper
from shelfwise.operators.dedup import first_seen, keep_first
from shelfwise.session import ensure_checkpoint_dir
from shelfwise.sources.html import LIST_SEPARATOR, compile_selector, read_page
from shelfwise.sources.profiles import DETAILS, GROUPS, HOSTS, LISTINGS

# Workers get the page helper with the task, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(html_helper)

NA = "N/A"
Cuts = dict[str, int]
PAGES_AT_ONCE = 64

# Badges and title words of add-ons, words of titles that are not games.
ADD_ON_BADGES = ("DLC", "MICROTRANSACTION", "MICRO TRANSACTION", "ADD-ON", "EXPANSION")
ADD_ON_TITLES = (
    "DLC", " - DLC", "EXPANSION PACK", "SEASON PASS", "MICRO TRANSACTION", "MICROTRANSACTION",
    "ADD-ON", "CONTENT PACK", "BONUS CONTENT", "DELUXE UPGRADE",
)
NON_GAME_TITLES = ("gift card", "points", "gems", "credits", "wallet", "season pass")


def selected_values(
    pages: DataFrame,
    fields: dict,
    root: str = "",
    groups: dict | None = None,
    carry: dict[str, str] | None = None,
) -> DataFrame:
    """One row per record: page_id, position, carried page columns, ``array<string>`` per field.

    ``carry`` maps page columns to their types; they ride along, so no join back is needed.
    """
    groups, carry = groups or {}, carry or {}
    spec = {
        "root": compile_selector(root) if root else None,
        "fields": {n: (compile_selector(css) if css else None, attr) for n, (css, attr) in fields.items()},
        "groups": {
            g: (
                compile_selector(css),
                {n: (compile_selector(part) if part else None, attr) for n, (part, attr) in parts.items()},
            )
            for g, (css, parts) in groups.items()
        },
    }
    names = [*fields, *(f"{g}_{n}" for g, (_, parts) in groups.items() for n in parts)]

    def sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """A few pages at a time, so that values of large pages do not pile up."""
        for start in range(0, batch.num_rows, PAGES_AT_ONCE):
            yield batch.slice(start, PAGES_AT_ONCE)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in sliced(whole)):
            rows, positions, columns = [], [], {name: [] for name in names}
            for row, html in enumerate(batch.column("html").to_pylist()):
                for position, record in enumerate(read_page(html or "", spec)):
                    rows.append(row)
                    positions.append(position)
                    for name in names:
                        columns[name].append(record[name])
            source_rows = pa.array(rows, pa.int64())
            out = [batch.column("page_id").take(source_rows), pa.array(positions, pa.int32())]
            out += [batch.column(name).take(source_rows) for name in carry]
            out += [pa.array(columns[name], pa.list_(pa.string())) for name in names]
            yield pa.RecordBatch.from_arrays(out, names=["page_id", "position", *carry, *names])

    schema = ", ".join(
        ["page_id bigint", "position int", *(f"{n} {t}" for n, t in carry.items()), *(f"`{n}` array<string>" for n in names)]
    )
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "html", *carry).mapInArrow(parse, schema)


def _first(name: str) -> Column:
    """First non-empty value or null."""
    return F.nullif(F.get(F.col(name), 0), F.lit(""))


def _or_na(c: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(NA))


def _contains_any(c: Column, words: tuple[str, ...]) -> Column:
    return c.rlike("|".join(words))


def has_url(df: DataFrame) -> DataFrame:
    """Records with a link."""
    return df.filter(F.col("url") != NA)


def product_links(df: DataFrame, column: str = "url") -> DataFrame:
    """Links of the product shape: a number followed by a dash."""
    return df.filter(F.col(column).rlike(r"/\d+-"))


def game_titles(df: DataFrame, column: str = "title") -> DataFrame:
    """Titles without the words of vouchers and currency packs, ignoring case."""
    return df.filter(~_contains_any(F.lower(F.col(column)), NON_GAME_TITLES))


def without_add_on_badges(df: DataFrame, column: str = "badge") -> DataFrame:
    badge = F.upper(F.coalesce(F.col(column), F.lit("")))
    return df.filter(~_contains_any(badge, ADD_ON_BADGES))


def without_add_on_titles(df: DataFrame, column: str = "title") -> DataFrame:
    return df.filter(~_contains_any(F.upper(F.col(column)), ADD_ON_TITLES))


def with_media(df: DataFrame) -> DataFrame:
    """Records with at least one screenshot or video."""
    return df.filter((F.size("screenshots") > 0) | (F.size("videos") > 0))


def listing_a(pages: DataFrame) -> DataFrame:
    raw = selected_values(pages, LISTINGS[SOURCE_A]["fields"], LISTINGS[SOURCE_A]["root"])
    review = F.get(F.col("review"), 0)
    summary = _or_na(review)
    names = F.array_compact(
        F.array(*[F.when(F.size(c) > 0, F.lit(n)) for c, n in (("win", "Windows"), ("mac", "Mac"), ("linux", "Linux"))])
    )
    return has_url(
        raw.filter(F.size("title") > 0).select(
            "page_id",
            "position",
            F.get(F.col("title"), 0).alias("title"),
            _or_na(_first("released")).alias("release_date"),
            _or_na(_first("original")).alias("original_price"),
            numbers.price_display(_first("final"), _first("label")).alias("price"),
            _or_na(_first("discount")).alias("discount_percentage"),
            summary.alias("review_summary"),
            numbers.text_score(F.nullif(summary, F.lit(NA))).alias("rating_score"),
            numbers.review_percentage(F.nullif(summary, F.lit(NA))).alias("rating_percentage"),
            _or_na(_first("href")).alias("url"),
            arrays.delimited(names, ", ").alias("platforms"),
        )
    )


def details_a(pages: DataFrame, cuts: Cuts) -> DataFrame:
    linked = pages.withColumn("source_videos", urls.page_video_urls(F.col("html"), cuts.get("videos")))
    raw = selected_values(linked, DETAILS[SOURCE_A], carry={"url": "string", "source_videos": "array<string>"})
    shots = F.filter(arrays.first_items(F.col("shots"), cuts.get("screenshots")), lambda u: u.contains("steam"))
    genres = F.filter(F.transform("genres", text.strip), lambda g: g != "")
    carousel = F.coalesce(*[_first(f"carousel_{i}") for i in range(1, 5)])  # the first selector that hits
    categories = F.filter(F.col("categories"), lambda c: c != "")
    return raw.select(
        "page_id",
        "url",
        arrays.delimited(genres, ", ").alias("genres"),
        _or_na(F.get(F.col("companies"), 0)).alias("developer"),
        _or_na(F.get(F.col("companies"), 1)).alias("publisher"),
        arrays.delimited(arrays.distinct_items(categories, cuts.get("categories")), ", ").alias("categories"),
        arrays.yes_no(categories, "multi").alias("multiplayer"),
        arrays.yes_no(categories, "single").alias("singleplayer"),
        _or_na(text.requirements_text(_first("requirements"), cuts.get("requirements"))).alias("system_requirements_windows"),
        _or_na(_first("header")).alias("header_image"),
        F.transform(shots, urls.full_size_screenshot).alias("screenshots"),
        urls.video_urls(F.col("embedded"), carousel, F.col("source_videos"), F.col("url"), cuts.get("videos")).alias("videos"),
    )


def listing_b(pages: DataFrame) -> DataFrame:
    raw = selected_values(pages, LISTINGS[SOURCE_B]["fields"], LISTINGS[SOURCE_B]["root"])
    titled = raw.select(
        "page_id",
        "position",
        urls.absolute_url(_first("href"), HOSTS[SOURCE_B]).alias("url"),
        F.coalesce(_first("title_attr"), F.get(F.col("title"), 0), F.lit("Unknown")).alias("title"),
    )
    return game_titles(product_links(titled))


def details_b(pages: DataFrame, cuts: Cuts) -> DataFrame:
    raw = selected_values(pages, DETAILS[SOURCE_B], groups=GROUPS[SOURCE_B], carry={"url": "string"})
    flat = lambda name: text.flat_text(_first(name))
    rows = F.arrays_zip("row_text", "row_second", "row_span", "row_span_second")

    def cell(phrase: str, part: str) -> Column:
        hits = F.filter(rows, lambda r: F.lower(r["row_text"]).contains(phrase) & (r[part] != ""))
        return F.substring_index(F.get(hits, 0)[part], LIST_SEPARATOR, 1)

    def described(name: str) -> Column:
        limit = cuts.get("description")
        whole = _first(name) if limit is None else F.left(_first(name), F.lit(limit))
        return F.nullif(text.flat_text(whole), F.lit(NA))

    total = flat("total")
    return raw.select(
        "page_id",
        "url",
        flat("author").alias("developer"),
        flat("publisher").alias("publisher"),
        flat("platform").alias("platforms"),
        flat("genre").alias("genre"),
        flat("released").alias("release_date"),
        F.coalesce(described("description"), described("product_text"), F.lit(NA)).alias("description"),
        total.alias("current_price"),
        flat("retail").alias("original_price"),
        flat("discounted").alias("discount_percentage"),
        _or_na(numbers.currency(total)).alias("currency"),
        flat("stock").alias("stock_status"),
        flat("rating").alias("ig_rating"),
        flat("based").alias("review_count"),
        text.flat_text(cell("recent steam reviews", "row_second")).alias("steam_recent_reviews"),
        text.flat_text(cell("all steam reviews", "row_span")).alias("steam_all_reviews"),
        _or_na(urls.count_in_brackets(cell("all steam reviews", "row_span_second"))).alias("steam_review_count"),
        _or_na(_first("video")).alias("video_url"),
        _or_na(_first("header")).alias("header_image"),
        arrays.first_items(F.col("shots"), cuts.get("screenshots")).alias("screenshots"),
        arrays.user_tags(F.col("tags"), cuts.get("tags")).alias("user_tags"),
        F.filter(F.col("features"), lambda f: f != "").alias("game_features"),
        text.requirements_list(F.col("minimal")).alias("system_requirements_min"),
        text.requirements_list(F.col("recommended")).alias("system_requirements_rec"),
        _or_na(urls.product_id(F.col("url"))).alias("product_id"),
        arrays.editions(F.col("edition_name"), F.col("edition_price"), cuts.get("editions")).alias("editions"),
        F.current_timestamp().alias("scrape_timestamp"),
    )


def listing_c(pages: DataFrame) -> DataFrame:
    raw = selected_values(pages, LISTINGS[SOURCE_C]["fields"], LISTINGS[SOURCE_C]["root"])
    href = _first("href")
    absolute = F.when(F.startswith(href, F.lit("http")), href).otherwise(F.concat(F.lit(HOSTS[SOURCE_C]), href))
    # A page's first entry of a link stands for it: if that is an add-on, later ones are not looked at.
    first = keep_first(
        raw.filter(href.contains("/game/")).withColumn("url", absolute), ["page_id", "url"], [F.col("position")]
    )
    linked = without_add_on_badges(first.withColumn("badge", F.get(F.col("badge"), 0)), "badge")
    named = linked.select(
        "page_id",
        "position",
        "url",
        text.status_tag(F.coalesce("badge", F.lit(""))).alias("status_tag"),
        F.coalesce(_first("title"), _first("aria")).alias("title"),
        numbers.price_text(_first("price")).alias("amount"),
    ).withColumn("title", F.coalesce("title", text.slug_title(F.col("url"))))
    na = F.lit(NA)
    return without_add_on_titles(named).select(
        "page_id",
        "position",
        "url",
        text.with_status_prefix(F.col("title"), F.col("status_tag")).alias("title"),
        F.coalesce(F.col("amount.price"), na).alias("price"),
        F.coalesce(F.col("amount.original_price"), na).alias("original_price"),
        F.coalesce(F.col("amount.discount_percentage"), na).alias("discount_percentage"),
        "status_tag",
    )


def details_c(pages: DataFrame, cuts: Cuts) -> DataFrame:
    raw = selected_values(pages, DETAILS[SOURCE_C], groups=GROUPS[SOURCE_C], carry={"url": "string"})
    rows = F.arrays_zip("row_text", "row_label", "row_content", "row_links", "row_content_links")
    label_kind = lambda r: (  # noqa: E731  a row has the first kind its label names
        F.when(F.lower(r["row_label"]).contains("release"), F.lit("release"))
        .when(F.lower(r["row_label"]).rlike("company|developer"), F.lit("company"))
        .when(F.lower(r["row_label"]).contains("publisher"), F.lit("publisher"))
        .when(F.lower(r["row_label"]).rlike("works on|system"), F.lit("systems"))
    )

    def of_kind(kind: str) -> Column:
        return F.filter(rows, lambda r: label_kind(r) == kind)

    def links_of(row: Column, part: str) -> Column:
        return F.split(row[part], LIST_SEPARATOR)

    release = F.try_element_at(F.filter(of_kind("release"), lambda r: r["row_content"] != ""), F.lit(-1))
    company = F.try_element_at(F.filter(of_kind("company"), lambda r: r["row_content_links"] != ""), F.lit(-1))
    lone_publisher = F.get(F.filter(of_kind("publisher"), lambda r: r["row_content_links"] != ""), 0)
    systems = arrays.platforms_in(F.try_element_at(of_kind("systems"), F.lit(-1))["row_text"])
    genre_rows = F.arrays_zip("genre_row_text", "genre_row_links")
    first_row = F.get(F.filter(genre_rows, lambda r: F.lower(r["genre_row_text"]).contains("genre:")), 0)
    row_genres = arrays.delimited(arrays.short_genres(links_of(first_row, "genre_row_links"), cuts.get("genres")), ", ")
    link_genres = arrays.delimited(
        F.filter(F.transform(arrays.first_items(F.col("genre_links"), cuts.get("genres")), text.strip),
                 lambda g: (g != "") & (F.length(g) < 30)), ", "
    )
    score = F.coalesce(urls.first_decimal(_first("score")), urls.first_decimal(_first("inline_score")))
    count = F.coalesce(*[urls.review_number(_first(c)) for c in ("reviews_a", "reviews_b", "reviews")])
    host = HOSTS[SOURCE_C]

    def first_filled(prefix: str, fix) -> Column:
        """Values of the first selector that yields any."""
        lists = [fix(F.transform(F.col(f"{prefix}_{i}"), lambda u: urls.absolute_url(u, host))) for i in range(1, 5)]
        chosen = lists[-1]
        for values in reversed(lists[:-1]):
            chosen = F.when(F.size(values) > 0, values).otherwise(chosen)
        return chosen

    def shots(values: Column) -> Column:
        large = F.transform(values, urls.large_image)
        return arrays.distinct_items(F.filter(large, lambda u: F.startswith(u, F.lit("http"))), cuts.get("screenshots"))

    def videos(values: Column) -> Column:
        return arrays.distinct_items(F.filter(values, lambda u: F.lower(u).rlike(r"\.mp4|\.webm")), cuts.get("videos"))

    header = F.when(F.startswith(_first("header"), F.lit("http")), _first("header"))
    cover = F.when(F.size("header") == 0, F.when(
        F.startswith(_first("cover"), F.lit("http")), _first("cover")
    ).when(F.startswith(_first("cover"), F.lit("//")), F.concat(F.lit("https:"), _first("cover")))
     .otherwise(F.concat(F.lit(host), _first("cover"))))
    developer = F.nullif(F.trim(F.get(links_of(company, "row_content_links"), 0)), F.lit(""))
    publisher = F.nullif(F.trim(F.get(links_of(company, "row_content_links"), 1)), F.lit(""))
    alone = F.nullif(F.trim(F.get(links_of(lone_publisher, "row_content_links"), 0)), F.lit(""))
    icons = arrays.platforms_of_classes(F.col("icons"))
    return raw.select(
        "page_id",
        "url",
        _or_na(score).alias("rating"),
        _or_na(count).alias("rating_count"),
        _or_na(F.substring_index(release["row_content"], LIST_SEPARATOR, 1)).alias("release_date"),
        F.coalesce(F.nullif(row_genres, F.lit(NA)), link_genres).alias("genres"),
        F.coalesce(F.nullif(systems, F.lit(NA)), icons).alias("platforms"),
        _or_na(developer).alias("developer"),
        _or_na(F.coalesce(publisher, alone)).alias("publisher"),
        text.description(_first("summary"), _first("meta"), cuts.get("description")).alias("description"),
        first_filled("shots", shots).alias("screenshots"),
        first_filled("videos", videos).alias("videos"),
        _or_na(F.coalesce(header, cover)).alias("header_image"),
    )


EXTRACTORS = {SOURCE_A: (listing_a, details_a), SOURCE_B: (listing_b, details_b), SOURCE_C: (listing_c, details_c)}


def _default(name: str, kind: str) -> Column:
    """Value of a field that was not found."""
    if kind.startswith("array"):
        return F.array().cast(kind)
    if kind == "timestamp":
        return F.current_timestamp()
    return F.lit("No" if name in ("multiplayer", "singleplayer") else NA)


def store_records(
    listing_pages: DataFrame, detail_pages: DataFrame, source: str, cuts: Cuts | None = None
) -> DataFrame:
    """Listing entries with the fields of their detail page, in the source's column names.

    Entries are reduced to one per link in arrival order, pages to the first of a link; only pages that
    an entry links to are parsed. An entry whose page is missing gets the defaults of a field that was not
    found. Source A keeps only records that have media. ``cuts`` limits parts of a detail page
    (``profiles.PUBLISHED_CUTS`` has the published numbers); nothing is cut by default.
    """
    listing, read_details = EXTRACTORS[source]
    ensure_checkpoint_dir(listing_pages.sparkSession)
    entries = first_seen(listing(listing_pages), "url").checkpoint()  # read twice below, parsed once
    wanted = detail_pages.join(entries.select("url"), "url", "left_semi")
    details = read_details(keep_first(wanted, ["url"], [F.col("page_id")]), cuts or {}).drop("page_id")
    records = entries.join(details, "url", "left").withColumns(
        {name: F.coalesce(F.col(name), _default(name, kind)) for name, kind in details.dtypes if name != "url"}
    )
    return with_media(records) if source == SOURCE_A else records


def as_text_columns(records: DataFrame, source: str) -> DataFrame:
    """Landing form: lists joined (pipe for source B, comma otherwise), declared column order."""
    from shelfwise.schemas import SOURCE_COLUMNS

    separator = "|" if source == SOURCE_B else ", "
    kinds = dict(records.dtypes)
    columns = []
    for name in SOURCE_COLUMNS[source]:
        if name in kinds:
            value = arrays.delimited(F.col(name), separator) if kinds[name].startswith("array") else F.col(name)
            columns.append(value.cast("string").alias(name))
    return records.select(*columns)


# --------------------------------------------------------------------------
# Generic pages: flat patterns, no Python.
# --------------------------------------------------------------------------

def page_fields(pages: DataFrame) -> DataFrame:
    """Title, heading, charset, host, path and paragraph text of any page, by pattern."""
    html = F.col("html")
    paragraphs = F.regexp_extract_all(html, F.lit(r"(?s)<p>(.*?)(?:</p>|<br>)"), 1)
    body = F.array_join(F.transform(paragraphs, lambda p: F.regexp_replace(p, "<[^>]*>", "")), " ")
    return pages.select(
        "page_id",
        "url",
        F.regexp_extract(html, "(?s)<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract(html, "(?s)<h1>(.*?)</h1>", 1).alias("h1"),
        F.regexp_extract(html, '<meta charset="([^"]*)"', 1).alias("charset"),
        F.regexp_extract(F.col("url"), r"^https?://([^/?#]+)", 1).alias("host"),
        F.regexp_extract(F.col("url"), r"^https?://[^/?#]+([^?#]*)", 1).alias("path"),
        text.clean_text(body).alias("body"),
    )


def page_links(pages: DataFrame) -> DataFrame:
    """One row per link in document order, absolute against the page's own host."""
    scheme_host = F.regexp_extract(F.col("url"), r"^(https?://[^/?#]+)", 1)
    hrefs = F.regexp_extract_all(F.col("html"), F.lit(r'<a [^>]*?href="([^"]*)"'), 1)
    exploded = pages.select("page_id", scheme_host.alias("base"), F.posexplode(hrefs).alias("position", "href"))
    absolute = (
        F.when(F.startswith("href", F.lit("//")), F.concat(F.lit("https:"), "href"))
        .when(F.startswith("href", F.lit("/")), F.concat("base", "href"))
        .otherwise(F.col("href"))
    )
    return exploded.select("page_id", "position", "href", absolute.alias("link"))
