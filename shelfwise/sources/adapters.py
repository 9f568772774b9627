"""Catalogue-shaped inputs derived from the test tables.

The SQL constants run unchanged in Spark, with ``{table}`` standing for a DataFrame, and in
the SQL engine that checks the results, with ``{table}`` standing for a view.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.text import null_if_token
from shelfwise.operators.model import genre_pairs
from shelfwise.schemas import COLUMN_MAPPINGS, SOURCE_A, SOURCE_B, SOURCE_C
from shelfwise.sources.profiles import HOSTS
from shelfwise.sources.tables import table

GAMES_SQL = """
SELECT p.p_partkey AS id,
 CASE p.p_partkey % 3 WHEN 0 THEN 'Steam' WHEN 1 THEN 'instant_gaming' ELSE 'GOG' END AS data_source,
 p.p_name AS game_title, l.d AS release_date,
 CASE WHEN p.p_partkey % 11 = 0 THEN NULL ELSE CAST((p.p_partkey * 37) % 101 AS INT) END AS rating,
 CASE WHEN p.p_partkey % 7 = 0 THEN p.p_partkey % 40 ELSE l.q * (1 + p.p_partkey % 3) END AS review_count,
 CASE WHEN p.p_partkey % 13 = 0 THEN NULL
  ELSE CAST(CAST(ROUND(p.p_retailprice * 100) AS BIGINT) * (10 - p.p_partkey % 10) / 10 AS BIGINT) END AS disc_cents,
 CAST(ROUND(p.p_retailprice * 100) AS BIGINT) AS orig_cents,
 CAST((p.p_partkey % 10) * 10 AS INT) AS discount_percentage,
 p.p_type AS platform, s.s_name AS developer, p.p_brand AS publisher
FROM {part} p
JOIN (SELECT l_partkey, CAST(SUM(l_quantity) AS BIGINT) AS q, MIN(l_suppkey) AS sk,
             CAST(MIN(l_shipdate) AS DATE) AS d
      FROM {lineitem} GROUP BY l_partkey) l ON l.l_partkey = p.p_partkey
JOIN {supplier} s ON s.s_suppkey = l.sk
"""

LISTINGS_SQL = """
SELECT p_partkey AS id,
 CASE p_partkey % 3 WHEN 0 THEN 'Steam' WHEN 1 THEN 'instant_gaming' ELSE 'GOG' END AS data_source,
 CASE WHEN p_partkey % 17 = 0 THEN ' N/A ' WHEN p_partkey % 5 = 0 THEN CONCAT('  ', UPPER(p_name), '!  ')
  ELSE CONCAT(p_name, ' ', CAST(p_partkey % 40 AS STRING)) END AS title_raw,
 CASE p_partkey % 6 WHEN 0 THEN 'Free To Play'
  WHEN 1 THEN CONCAT('€', CAST(p_size AS STRING), ',99') WHEN 2 THEN CONCAT('$', CAST(p_size AS STRING), '.50')
  WHEN 3 THEN CONCAT('1.', CAST(100 + p_size AS STRING), ',25€') WHEN 4 THEN CONCAT('1,', CAST(100 + p_size AS STRING), '.25')
  ELSE 'N/A' END AS price_raw,
 CASE WHEN p_partkey % 8 = 0 THEN 'N/A' ELSE CONCAT('$', CAST(p_size + 20 AS STRING), '.40') END AS original_raw,
 CASE WHEN p_partkey % 4 = 0 THEN CONCAT('-', CAST(p_size AS STRING), '%') WHEN p_partkey % 4 = 1 THEN 'N/A'
  ELSE CAST(p_size AS STRING) END AS discount_raw,
 CASE WHEN p_partkey % 11 = 0 THEN '--' WHEN p_partkey % 3 = 0 THEN CAST((p_partkey * 41) % 111 AS STRING)
  WHEN p_partkey % 3 = 1 THEN CONCAT(CAST(p_partkey % 12 AS STRING), '.5')
  ELSE CONCAT(CAST(p_partkey % 6 AS STRING), '.2') END AS rating_raw,
 CASE p_partkey % 4 WHEN 0 THEN CONCAT('1,', CAST(100 + p_size AS STRING), ' reviews')
  WHEN 1 THEN CAST(p_partkey AS STRING) WHEN 2 THEN 'No user reviews' ELSE NULL END AS review_count_raw,
 CASE p_partkey % 10 WHEN 0 THEN 'Overwhelmingly Positive<br>96% of reviews' WHEN 1 THEN 'Very Positive<br>84%'
  WHEN 2 THEN 'Mostly Positive<br>72%' WHEN 3 THEN 'Positive' WHEN 4 THEN 'Mixed<br>50%'
  WHEN 5 THEN 'Mostly Negative<br>30%' WHEN 6 THEN 'Negative' WHEN 7 THEN 'Very Negative<br>12%'
  WHEN 8 THEN 'Overwhelmingly Negative<br>5%' ELSE 'N/A' END AS review_text,
 REPLACE(p_name, ' ', CASE p_partkey % 3 WHEN 0 THEN ', ' WHEN 1 THEN '-' ELSE '|x;' END) AS genres_raw,
 CASE p_partkey % 6 WHEN 0 THEN 'Windows' WHEN 1 THEN 'Windows, Mac' WHEN 2 THEN 'Windows, Mac, Linux'
  WHEN 3 THEN 'none' WHEN 4 THEN ' Linux ' ELSE 'N/A' END AS platforms_raw,
 CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_brand END AS developer_raw,
 CASE WHEN p_partkey % 18 = 0 THEN 'N/A' ELSE p_type END AS publisher_raw,
 CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CONCAT(p_name, '&nbsp;by', '&amp;', p_brand, '  of ', p_type) END AS description_raw,
 CASE WHEN p_partkey % 12 = 2 THEN 'SOON' ELSE NULL END AS status_raw,
 CASE WHEN p_partkey % 19 = 0 THEN NULL WHEN p_partkey % 10 = 7
  THEN CONCAT('/en/', CAST(p_partkey - p_partkey % 60 + p_partkey % 3 AS STRING), '-item')
  ELSE CONCAT('/en/', CAST(p_partkey AS STRING), '-item') END AS url_raw
FROM {part}
"""

DATES_SQL = """
SELECT o_orderkey AS id, CASE o_orderkey % 7
 WHEN 0 THEN CONCAT(dd, '-', mon, '-', yy) WHEN 1 THEN CONCAT(mname, ' ', dd, ', ', yyyy)
 WHEN 2 THEN CONCAT(dd, '-', mon, '-', yyyy) WHEN 3 THEN CONCAT(yyyy, '-', mm, '-', d2)
 WHEN 4 THEN CONCAT(dd, ' ', mon, ', ', yyyy) WHEN 5 THEN yyyy ELSE 'Coming soon' END AS date_raw
FROM (SELECT o_orderkey, CAST(y AS STRING) AS yyyy, SUBSTR(CAST(y AS STRING), 3, 2) AS yy, CAST(d AS STRING) AS dd,
  LPAD(CAST(d AS STRING), 2, '0') AS d2, LPAD(CAST(m AS STRING), 2, '0') AS mm, mname, SUBSTR(mname, 1, 3) AS mon
 FROM (SELECT o_orderkey, EXTRACT(YEAR FROM o_orderdate) AS y, EXTRACT(MONTH FROM o_orderdate) AS m,
  EXTRACT(DAY FROM o_orderdate) AS d,
  CASE EXTRACT(MONTH FROM o_orderdate) WHEN 1 THEN 'January' WHEN 2 THEN 'February' WHEN 3 THEN 'March'
   WHEN 4 THEN 'April' WHEN 5 THEN 'May' WHEN 6 THEN 'June' WHEN 7 THEN 'July' WHEN 8 THEN 'August'
   WHEN 9 THEN 'September' WHEN 10 THEN 'October' WHEN 11 THEN 'November' ELSE 'December' END AS mname
  FROM {orders}) a) b
"""

# One row per dialogue turn as a user review; some ratings are out of range, some games unknown.
REVIEWS_SQL = """
SELECT conv_id * 1000 + turn AS id, conv_id * 19 AS game_id,
 CASE WHEN conv_id % 13 = 0 THEN NULL ELSE role END AS user_name,
 CAST((conv_id * 17 + turn * 5) % 120 - 5 AS INT) AS rating, text AS review_text,
 CASE WHEN turn % 4 = 3 THEN NULL ELSE turn % 3 END AS helpful_count,
 CAST(CONCAT('2024-01-', LPAD(CAST(1 + (conv_id + turn) % 28 AS STRING), 2, '0')) AS DATE) AS review_date
FROM {conversations}
"""

MEDIA_SQL = """
SELECT CONCAT('/media/', CASE WHEN page_id % 4 = 0 THEN 'videos' ELSE 'images' END, '/game_',
  CAST(page_id * 11 AS STRING), '_file_', CAST(page_id AS STRING), '.bin') AS path,
 CAST(LENGTH(html) AS BIGINT) AS length
FROM {pages}
"""


def from_sql(spark: SparkSession, folder: str, sql: str, *names: str) -> DataFrame:
    return spark.sql(sql, **{name: table(spark, folder, name) for name in names})


def games(spark: SparkSession, folder: str) -> DataFrame:
    rows = from_sql(spark, folder, GAMES_SQL, "part", "lineitem", "supplier")
    return rows.select(
        "id", "data_source", "game_title", "release_date", "rating", "review_count",
        (F.col("disc_cents") / 100).cast("decimal(12,2)").alias("discounted_price"),
        (F.col("orig_cents") / 100).cast("decimal(12,2)").alias("original_price"),
        F.col("discount_percentage").cast("double").alias("discount_percentage"),
        "platform", "developer", "publisher",
    )


def game_genre_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """(game_id, genre_name) from the words of the titles."""
    titled = games(spark, folder).select("id", F.split("game_title", " ").alias("genre_list"))
    return genre_pairs(titled)


def genres(pairs: DataFrame) -> DataFrame:
    """Genre table with sparse ids, and one genre that no game has."""
    named = pairs.groupBy("genre_name").agg(F.xxhash64("genre_name").alias("id"))
    unused = pairs.sparkSession.sql("SELECT 'unassigned' AS genre_name, CAST(0 AS BIGINT) AS id")
    return named.unionByName(unused)


def genre_model(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(games, game_genres, genres)."""
    pairs = game_genre_pairs(spark, folder)
    links = pairs.select("game_id", F.xxhash64("genre_name").alias("genre_id"))
    return games(spark, folder), links, genres(pairs)


def listings(spark: SparkSession, folder: str) -> DataFrame:
    return from_sql(spark, folder, LISTINGS_SQL, "part")


def raw_dates(spark: SparkSession, folder: str) -> DataFrame:
    return from_sql(spark, folder, DATES_SQL, "orders")


def user_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return from_sql(spark, folder, REVIEWS_SQL, "conversations")


def media_listing(spark: SparkSession, folder: str) -> DataFrame:
    return from_sql(spark, folder, MEDIA_SQL, "pages")


def store_named_files(lines: DataFrame, path: str) -> None:
    """Text files below ``path``: column ``file`` names one, with its folder, and holds its ``value`` lines.

    Spark names its files itself, so each name's rows are written to a folder and that folder's file is renamed.
    """
    spark = lines.sparkSession
    lines.repartition("file").write.partitionBy("file").text(f"{path}/_written")
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path
    fs = folder(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(folder(f"{path}/_written")):
        name = unquote(status.getPath().getName().removeprefix("file="))
        if status.isDirectory():
            target = folder(f"{path}/{name}")
            fs.mkdirs(target.getParent())
            fs.rename(fs.listStatus(status.getPath())[0].getPath(), target)
    fs.delete(folder(f"{path}/_written"), True)


# Source column -> listing column, as the three landing files would carry them.
_LANDING = {
    SOURCE_A: {
        "title": "title_raw", "release_date": "date_raw", "original_price": "original_raw", "price": "price_raw",
        "discount_percentage": "discount_raw", "review_summary": "review_text", "rating_score": "rating_raw",
        "url": "url_raw", "platforms": "platforms_raw", "genres": "genres_raw", "developer": "developer_raw",
        "publisher": "publisher_raw",
    },
    SOURCE_B: {
        "title": "title_raw", "url": "url_raw", "developer": "developer_raw", "publisher": "publisher_raw",
        "platforms": "platforms_raw", "genre": "genres_raw", "release_date": "date_raw",
        "description": "description_raw", "current_price": "price_raw", "original_price": "original_raw",
        "discount_percentage": "discount_raw", "ig_rating": "rating_raw", "review_count": "review_count_raw",
    },
    SOURCE_C: {
        "title": "title_raw", "url": "url_raw", "price": "price_raw", "original_price": "original_raw",
        "discount_percentage": "discount_raw", "rating": "rating_raw", "rating_count": "review_count_raw",
        "release_date": "date_raw", "genres": "genres_raw", "platforms": "platforms_raw",
        "developer": "developer_raw", "publisher": "publisher_raw", "description": "description_raw",
        "status_tag": "status_raw",
    },
}


def landing_records(spark: SparkSession, folder: str) -> DataFrame:
    """All landing rows in one frame, in standard names with their source: each table is read and joined once."""
    rows = listings(spark, folder).join(raw_dates(spark, folder), "id", "left")
    carriers: dict[str, dict[str, list[str]]] = {}  # standard name -> listing column -> sources
    for source, columns in _LANDING.items():
        for name, raw in columns.items():
            carriers.setdefault(COLUMN_MAPPINGS[source].get(name, name), {}).setdefault(raw, []).append(source)

    def standard(raws: dict[str, list[str]]) -> Column:
        picked = [
            F.col(raw) if len(sources) == len(_LANDING) else F.when(F.col("data_source").isin(sources), F.col(raw))
            for raw, sources in raws.items()
        ]
        return null_if_token(F.coalesce(*picked) if len(picked) > 1 else picked[0])

    return rows.select(
        "data_source", *[standard(raws).alias(name) for name, raws in carriers.items()], F.col("id").alias("ingest_ord")
    )


def landing_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The three landing tables as a CSV scan would give them, arrival order in ``ingest_ord``."""
    rows = listings(spark, folder).join(raw_dates(spark, folder), "id", "left")
    frames = {}
    for source, columns in _LANDING.items():
        picked = [null_if_token(F.col(raw)).alias(name) for name, raw in columns.items()]
        frames[source] = rows.filter(F.col("data_source") == source).select(*picked, F.col("id").alias("ingest_ord"))
    return frames


# --------------------------------------------------------------------------
# Store pages: HTML rendered from the listings.
# --------------------------------------------------------------------------
PER_PAGE = 25


def _html(template: str, **values: Column) -> Column:
    """Concatenate a template with ``{name}`` slots."""
    parts, rest = [], template
    while rest:
        head, _, tail = rest.partition("{")
        if head:
            parts.append(F.lit(head))
        if not tail:
            break
        name, _, rest = tail.partition("}")
        parts.append(F.coalesce(values[name].cast("string"), F.lit("")))
    return F.concat(*parts)


def escaped(c: Column) -> Column:
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(sign), F.lit(entity))
    return c


def listing_pages(spark: SparkSession, folder: str, source: str) -> DataFrame:
    """Listing pages of a source; every tenth entry shows an item of the same block again."""
    rows = listings(spark, folder).filter(F.col("data_source") == source)
    again = F.col("id") - F.col("id") % 60 + F.col("id") % 3
    rows = rows.withColumn("app", F.when(F.col("id") % 10 == 7, again).otherwise(F.col("id")))
    rows = rows.withColumn("title", escaped(F.trim("title_raw")))
    if source == SOURCE_A:
        entry = _html(
            '<a class="search_result_row" href="https://store.steampowered.com/app/{app}/x/">'
            '<span class="title">{title}</span>{icons}'
            '<div class="search_released"> {released} </div>{review}{block}<div class="search_price">{label}</div></a>',
            app=F.col("app"), title=F.col("title"), released=F.concat(F.col("id") % 28 + 1, F.lit(" Oct, 2025")),
            icons=F.concat(
                F.when(F.col("id") % 2 == 0, F.lit('<span class="platform_img win"></span>')).otherwise(F.lit("")),
                F.when(F.col("id") % 4 == 0, F.lit('<span class="platform_img linux"></span>')).otherwise(F.lit("")),
            ),
            review=F.when(
                F.col("review_text") != "N/A",
                _html('<span class="search_review_summary" data-tooltip-html="{t}"></span>', t=escaped(F.col("review_text"))),
            ),
            block=F.when(
                F.col("id") % 5 == 0,
                _html('<div class="discount_block"><div class="discount_pct">-{d}%</div><div class="discount_prices">'
                      '<div class="discount_original_price">{o}</div><div class="discount_final_price">{p}</div></div></div>',
                      d=F.col("id") % 90, o=F.col("original_raw"), p=F.concat(F.lit("$"), F.col("id"), F.lit(".99"))),
            ),
            label=F.col("price_raw"),
        )
        shell = ('<html><body><div id="search_resultsRows">', "</div></body></html>")
    elif source == SOURCE_B:
        entry = _html(
            '<article class="item force-badge"><a class="cover" href="{href}"><img src="c.jpg"></a>'
            '<div class="name"><span class="title">{title}</span></div></article>',
            href=F.concat(F.when(F.col("id") % 2 == 0, F.lit("/en/")).otherwise(F.lit(HOSTS[SOURCE_B] + "/en/")),
                          F.col("app"), F.when(F.col("id") % 31 == 0, F.lit("item")).otherwise(F.lit("-item/"))),
            title=F.when(F.col("id") % 37 == 0, F.concat("title", F.lit(" Gift Card"))).otherwise(F.col("title")),
        )
        shell = ('<html><body><div class="search">', "</div></body></html>")
    else:
        entry = _html(
            '<a class="product-tile" href="{href}"><span class="badge-text">{badge}</span>'
            '<div class="product-title">{title}</div><span class="price-text">{price}</span></a>',
            href=F.concat(F.when(F.col("id") % 2 == 0, F.lit("/en/game/")).otherwise(F.lit(HOSTS[SOURCE_C] + "/en/game/")),
                          F.lit("item_"), F.col("app")),
            badge=F.when(F.col("id") % 23 == 0, F.lit("dlc")).when(F.col("id") % 12 == 2, F.lit(" soon ")),
            title=F.when(F.col("id") % 29 == 0, F.concat("title", F.lit(" Season Pass")))
            .when(F.col("id") % 10 == 1, F.lit("")).otherwise(F.col("title")),
            price=F.when(F.col("id") % 7 == 0, F.lit("Free"))
            .when(F.col("id") % 2 == 0, F.concat(F.lit("-50% $"), F.col("id"), F.lit(".99 $9.99")))
            .otherwise(F.concat(F.lit("$ "), F.col("id"), F.lit(".49"))),
        )
        shell = ('<html><body><div class="list">', "</div></body></html>")
    entries = rows.select(F.floor(F.col("id") / PER_PAGE).cast("bigint").alias("page_id"), "id", entry.alias("entry"))
    bodies = entries.groupBy("page_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "entry"))), lambda e: e["entry"]), "\n").alias("b")
    )
    return bodies.select(
        "page_id", F.concat(F.lit(HOSTS[source] + "/list?page="), "page_id").alias("url"),
        F.concat(F.lit(shell[0]), "b", F.lit(shell[1])).alias("html"),
    )


def detail_pages(spark: SparkSession, folder: str, source: str) -> DataFrame:
    """One detail page per item of a source; items without a known developer have none.

    Spread over all cores, as a stored page table would be by its many files.
    """
    rows = listings(spark, folder).filter((F.col("data_source") == source) & F.col("developer_raw").isNotNull())
    rows = rows.repartition(spark.sparkContext.defaultParallelism, "id")
    app = F.col("id")
    if source == SOURCE_A:
        url = F.concat(F.lit("https://store.steampowered.com/app/"), app, F.lit("/x/"))
        html = _html(
            '<html><body><div id="appHeaderGridContainer"><div class="grid_label">Developer</div>'
            '<div class="grid_content"><a href="/d">{dev}</a></div><div class="grid_label">Publisher</div>'
            '<div class="grid_content"><a href="/p"> {pub} </a></div></div>'
            '<div class="details_block"><b>Genre:</b> <a href="/genre/a">Action</a>, <a href="/genre/b">Type &amp; {app}</a>'
            '<a href="/other">no</a></div><div class="game_area_features_list_ctn"><a>Single-player</a>{multi}<a>Cloud</a>'
            '<a>Cloud</a></div><div class="sysreq_contents"><ul><li>OS: <b>{app}</b></li><li>RAM</li></ul></div>'
            '<img class="game_header_image_full" src="https://cdn.steam/{app}/header.jpg">{shots}{video}</body></html>',
            dev=F.col("developer_raw"), pub=F.col("publisher_raw"), app=app,
            multi=F.when(app % 2 == 0, F.lit("<a>Online Multi-player</a>")),
            shots=F.when(
                app % 5 != 0,
                _html('<div class="highlight_screenshot"><img src="https://steam.cdn/{a}/ss1.116x65.jpg"></div>'
                      '<div class="screenshot_holder"><img src="https://other.cdn/{a}/x.jpg">'
                      '<img src="https://steam.cdn/{a}/ss2.jpg"></div>', a=app),
            ),
            video=F.when(
                app % 4 == 1,
                _html('<div class="gamehighlight_desktopcarousel" data-props="{json}"></div>',
                      json=escaped(F.concat(
                          F.lit('{"trailers":[{"hlsManifest":"https:\\/\\/video.cdn\\/store_trailers\\/'), app,
                          F.lit('\\/hls_264_master.m3u8?t=1"},{"hlsManifest":"","dashManifests":["https:\\/\\/video.cdn\\/'),
                          app, F.lit('\\/dash.mpd"]}]}')))),
            ),
        )
    elif source == SOURCE_B:
        url = F.concat(F.lit(HOSTS[SOURCE_B] + "/en/"), app, F.lit("-item/"))
        html = _html(
            '<html><head><meta itemprop="author" content="{dev}"><meta itemprop="publisher" content="{pub}">'
            '<meta itemprop="gamePlatform" content="PC"><meta itemprop="image" content="https://img/{app}.jpg"></head><body>'
            '<div class="amount"><div class="discounts"><span class="retail">{orig}</span><span class="discounted">-{disc}%</span>'
            '</div><div class="total">{app}.99€</div></div><div class="stock"><span>In stock</span></div>'
            '<table><tr class="genres"><th>Genre</th><th><a class="tag">Action</a><a class="tag">RPG</a></th></tr>'
            '<tr class="release-date"><th>Date:</th><th>30 October 2025</th></tr>'
            '<tr><th>Recent Steam reviews:</th><th><span>Mixed</span> <span>(12)</span></th></tr>'
            '<tr><th>All Steam reviews:</th><th><span>Very Positive</span> <span>({app})</span></th></tr></table>'
            '{desc}<div class="product-text"><div class="text">Fallback text {app}</div></div>'
            '<div class="ig-search-reviews-avg">{stars}</div><div class="based">Based on <a class="link">{app} reviews</a></div>'
            '<div class="users-tags"><a class="searchtag">RPG</a><a class="searchtag">...</a><a class="searchtag"> Tag {app} </a></div>'
            '<div class="features-listing"><a class="feature"><span class="feature-text">Co-op</span></a>'
            '<a class="feature"><span class="feature-text"></span></a></div>'
            '<div class="minimal"><ul class="specs"><li>OS:\n 10</li><li>RAM: {app}</li></ul></div>'
            '<div class="editions"><div class="item"><div class="name"><h3>Standard</h3></div><div class="amount">'
            '<span class="total">{app}€</span></div></div><div class="item"><div class="name"><h3>None</h3></div></div></div>'
            '<div class="screenshots"><a itemprop="screenshot" href="https://img/{app}/1.png"></a>'
            '<a itemprop="screenshot" href="https://img/{app}/2.webp"></a></div></body></html>',
            dev=F.col("developer_raw"), pub=F.col("publisher_raw"), app=app, orig=F.col("original_raw"), disc=app % 90,
            stars=F.concat(app % 10, F.lit(".5")),
            desc=F.when(app % 2 == 0, F.concat(F.lit('<span itemprop="description">Line one\n\tof '), app, F.lit("</span>"))),
        )
    else:
        url = F.concat(F.lit(HOSTS[SOURCE_C] + "/en/game/item_"), app)
        html = _html(
            '<html><head><meta property="og:image" content="{img}"><meta name="description" '
            'content="A long enough description of item number {app} from the page head."></head><body>'
            '{score}<div class="productcard-rating__details">({app} Reviews)</div>'
            '<div class="content-summary-item__description">{summary}</div>'
            '<div class="table__row details__row"><div class="details__category">Genre:</div><div class="details__content">'
            '<a class="details__link">Action</a> - <a class="details__link">Item {app}</a></div></div>'
            '<div class="table__row details__row"><div class="details__category">Works on:</div>'
            '<div class="details__content">{systems}</div></div>'
            '<div class="table__row details__row"><div class="details__category">Release date:</div>'
            '<div class="details__content"> October 30, 2025 </div></div>'
            '<div class="table__row details__row"><div class="details__category">Company:</div>'
            '<div class="details__content"><a>{dev}</a> / <a>{pub}</a></div></div>'
            '<img src="//img.cdn/{app}/screenshots/a_256.jpg"><img src="/img/{app}/screenshots/b-thumb.png">'
            '<img src="/img/{app}/screenshots/b-thumb.png"><video><source src="//v.cdn/{app}.mp4"></video></body></html>',
            img=F.concat(F.lit("https://img.cdn/"), app, F.lit(".jpg")), app=app,
            score=F.when(app % 2 == 0, _html('<div class="productcard-rating__score--version-a">{a}.6/5</div>', a=app % 5))
            .otherwise(_html('<div class="productcard-rating--inline"><span class="rating">{a}.1</span></div>', a=app % 5)),
            summary=F.when(app % 3 == 1, F.lit("short")).otherwise(
                F.concat(F.lit("The long summary of the item with the number "), app,
                         F.lit(" which goes on.  Originally released in 1999. More text..."))),
            systems=F.when(app % 2 == 0, F.lit("Windows (10, 11), Linux")).otherwise(F.lit("Windows, Mac OS X")),
            dev=F.col("developer_raw"), pub=F.col("publisher_raw"),
        )
    return rows.select(app.alias("page_id"), url.alias("url"), html.alias("html"))


def media_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records with a header, screenshots and videos made from each page's own links."""
    pages = table(spark, folder, "pages")
    hrefs = F.regexp_extract_all("html", F.lit(r'<a [^>]*?href="([^"]*)"'), 1)
    kind = F.element_at(F.array(F.lit(".PNG"), F.lit(".webp"), F.lit(".jpg")), (F.col("page_id") % 3 + 1).cast("int"))
    video = F.transform(hrefs, lambda h, i: F.concat(
        h, F.element_at(F.array(F.lit(".mp4"), F.lit(".m3u8"), F.lit(".webm")), i % 3 + 1)))
    return pages.select(
        F.col("page_id").alias("id"), "url",
        F.when(F.col("page_id") % 4 != 0, F.concat("url", F.lit("/cover.jpg"))).otherwise(F.lit("N/A")).alias("header_image"),
        F.transform(hrefs, lambda h: F.concat(h, kind)).alias("screenshots"),
        video.alias("videos"),
    )


def trailer_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """Escaped JSON attributes with an HLS trailer, a DASH trailer and surplus ones."""
    pages = table(spark, folder, "pages")
    page_id = F.col("page_id")
    json = F.concat(
        F.lit('{"trailers":[{"hlsManifest":"https:\\/\\/video.cdn\\/store_trailers\\/'), page_id,
        F.lit('\\/hls_264_master.m3u8?t=1&x=2"},{"dashManifests":["https:\\/\\/video.cdn\\/'), page_id,
        F.lit('\\/dash.mpd"]},{"hlsManifest":"https:\\/\\/video.cdn\\/b\\/'), page_id,
        F.lit('\\/hls_1.m3u8"},{"hlsManifest":"https:\\/\\/video.cdn\\/c\\/hls_1.m3u8"}]}'),
    )
    return pages.select("page_id", "url", "html", escaped(json).alias("attribute"))
