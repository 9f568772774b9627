"""CSV charsets, page extraction on literal markup, media files."""

from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from shelfwise.schemas import SOURCE_A, SOURCE_B, SOURCE_C
from shelfwise.sources import media, pages
from shelfwise.sources.csv import ARRIVAL, export_csv, read_csv, read_csv_replacing
from shelfwise.sources.html import Page, compile_selector, find_all, values
from shelfwise.sources.tables import run_sql


def rows(frame, *order):
    return [r.asDict() for r in frame.orderBy(*order).collect()]


def test_csv_charset_is_chosen_per_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿title,note\nCafé,\"two\nlines, \"\"q\"\"\"\nN/A,nan\n".encode("utf-8"))
    (tmp_path / "b.csv").write_bytes("title,note\nCafé,plain\nÜber,\n".encode("latin-1"))
    frame = read_csv(spark, str(tmp_path), multi_line=True)
    assert frame.columns == ["title", "note", ARRIVAL]
    found = {(r["title"], r["note"]) for r in frame.collect()}
    assert found == {("Café", 'two\nlines, "q"'), (None, None), ("Café", "plain"), ("Über", None)}


def test_csv_arrival_order_is_file_then_row(spark, tmp_path):
    for name, start in (("1.csv", 0), ("2.csv", 100)):
        (tmp_path / name).write_text("n\n" + "\n".join(str(start + i) for i in range(50)) + "\n")
    ordered = [int(r["n"]) for r in read_csv(spark, str(tmp_path)).orderBy(ARRIVAL).collect()]
    assert ordered == list(range(50)) + list(range(100, 150))


@pytest.mark.parametrize("multi_line", [False, True])
def test_csv_values_go_to_their_own_names(spark, tmp_path, multi_line):
    (tmp_path / "a.csv").write_text("title,url\nT1,U1\ntitle,url\n")
    (tmp_path / "b.csv").write_text('"url","title","no, te"\nU2,T2,"N,2"\n')
    found = {tuple(r) for r in read_csv(spark, str(tmp_path), multi_line).drop(ARRIVAL).select("title", "url", "no, te").collect()}
    assert found == {("T1", "U1", None), ("title", "url", None), ("T2", "U2", "N,2")}


def test_csv_replacing_refuses_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("title,url\nT1,U1\n")
    (tmp_path / "b.csv").write_text("url,title\nU2,T2\n")
    with pytest.raises(Exception, match="header"):
        read_csv_replacing(spark, str(tmp_path)).collect()


def test_page_helper_is_linear():
    import time

    def seconds(html, css=None):
        start = time.perf_counter()
        page = Page(html)
        if css:
            for row in find_all(page, page.top, compile_selector("tr")):
                find_all(page, row, compile_selector(css))
        return time.perf_counter() - start

    rows_of = lambda n: "<table>" + "<tr><th>a</th><th><span>b</span></th></tr>" * n + "</table>"
    stray = lambda n: "<b>" * n + "</i>" * n
    assert seconds(rows_of(20000), "span") < 16 * max(0.05, seconds(rows_of(2500), "span"))
    assert seconds(stray(20000)) < 16 * max(0.05, seconds(stray(2500)))


def test_first_entry_of_a_link_decides(spark):
    card = '<a class="product-tile" href="/en/game/one"><span class="badge">{}</span><h3>One</h3></a>'
    listing = frame_of(spark, ("list", card.format("DLC") + card.format("")), ("list", card.format("")))
    assert [r["page_id"] for r in rows(pages.listing_c(listing), "position")] == [1]


def test_carousel_candidates_in_order(spark):
    props = lambda n: '{&quot;trailers&quot;:[{&quot;hlsManifest&quot;:&quot;https://v/%d/hls_1&quot;}]}' % n
    details = frame_of(spark, ("https://s/app/7/x/", f'<div class="gamehighlight_other" data-props="{props(1)}"></div>'
                               f'<div class="gamehighlight_desktopcarousel" data-props="{props(2)}"></div>'))
    assert rows(pages.details_a(details, {}), "url")[0]["videos"] == ["https://v/2/movie_max_vp9.webm"]


LINES = [
    ("plain", "a,b", "5 inch"), ("two\nlines", "U1", "x"), ('quoted "word"', "\n\nstarts and ends\n", "y"), ("T2", None, "N,2"),
    ("é\n\"ü\",\n\"", "z", '"'), ("many\n" * 40 + "end", "w", "v"), ("\",\"\n\",\"", "q", ","), ("last", "one", "row"),
]


@pytest.mark.parametrize("size", ["32b", "64b", "1k", "1m"])
@pytest.mark.parametrize("charset", ["utf-8", "latin-1"])
def test_csv_cells_with_line_breaks_are_read_in_splits(spark, tmp_path, size, charset):
    import csv

    with open(tmp_path / "a.csv", "w", encoding=charset, newline="") as file:
        writer = csv.writer(file, lineterminator="\r\n" if size == "64b" else "\n")
        writer.writerows([("title", "url", "no, te"), *(row for _ in range(5) for row in LINES)])
    settings = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "1b", "spark.sql.files.minPartitionNum": "1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        frame = read_csv(spark, str(tmp_path))
        found = [tuple(r)[:3] for r in frame.orderBy(ARRIVAL).collect()]
        tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        for key in settings:
            spark.conf.unset(key)
    whole = {tuple(r)[:3] for r in read_csv(spark, str(tmp_path), multi_line=True).collect()}
    assert found == [row for _ in range(5) for row in LINES]
    assert set(found) == whole or size == "64b"
    assert tasks > (5 if size in ("32b", "64b") else 0)


def test_csv_signs_amid_cells_are_no_borders_and_uneven_quotes_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text('title,note\n5" disk,plain\nab"c"d,"x\ny"\n\n,\n')
    found = {tuple(r)[:2] for r in read_csv(spark, str(tmp_path)).collect()}
    assert found == {('5" disk', "plain"), ('ab"c"d', "x\ny"), (None, None)}
    (tmp_path / "b.csv").write_text('title,note\n"open,plain\nnext,line\n')
    with pytest.raises(ValueError, match="b.csv"):
        read_csv(spark, str(tmp_path))
    assert read_csv(spark, str(tmp_path), line_breaks=False).count() > 0


def test_csv_of_one_kind_is_not_joined_or_shuffled(spark, tmp_path):
    (tmp_path / "a.csv").write_text("title,url\nT1,U1\n")
    (tmp_path / "b.csv").write_text("title,url\nT2,U2\n")
    plan = read_csv(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_csv_replaces_bad_bytes(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"title\nCaf\xe9\n")
    assert [r["title"] for r in read_csv_replacing(spark, str(tmp_path)).collect()] == ["Caf�"]


def test_csv_export_round_trip(spark, tmp_path):
    original = spark.createDataFrame([(' a "q", b ', "x\ny"), ("é", None)], "t string, n string")
    export_csv(original, str(tmp_path / "out"))
    first = next((tmp_path / "out").glob("*.csv")).read_bytes()
    assert not first.startswith(b"\xef\xbb\xbf")
    assert sorted(map(str, read_csv(spark, str(tmp_path / "out"), multi_line=True).drop(ARRIVAL).collect())) == sorted(map(str, original.collect()))


def test_selectors():
    page = Page(
        "<!DOCTYPE html><div id=main class='a b'><p>one<p>two <b>x</b>&amp;y<!-- <p>no --><script>'<p>no</p>'</script></div>"
        "<ul><li>1<li class=hit data-k='v w'>2<ul><li>3</ul></ul><img src=/a/b.png><br/><span>tail"
    )

    def texts(css, attribute=None):
        return values(page, page.top, compile_selector(css), attribute)

    assert texts("#main p") == ["one", "two x&y"]
    assert texts("div.a.b > p > b") == ["x"]
    assert texts("ul > li") == ["1", "2 3", "3"]
    assert texts("li:nth-child(2)") == ["2 3"]
    assert texts("[data-k='v w']", "class") == ["hit"]
    assert texts("[class*='hi'], img[src*='b.p']", "src") == ["/a/b.png"]
    assert texts("span") == ["tail"]
    assert find_all(page, page.top, compile_selector("script p")) == []


def frame_of(spark, *documents):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(documents)], "page_id bigint, url string, html string")


def test_listing_and_details_of_source_a(spark):
    listing = frame_of(spark, ("list", """
        <div id="search_resultsRows">
         <a href="https://store/app/7/x/"><span class="title"> One </span><span class="platform_img win"></span>
          <span class="platform_img mac"></span><div class="search_released">30 Oct, 2025</div>
          <span class="search_review_summary positive" data-tooltip-html="Very Positive&lt;br&gt;84% of 10"></span>
          <div class="discount_block"><div class="discount_pct">-50%</div><div class="discount_original_price">$10.00</div>
          <div class="discount_final_price">$5.00</div></div></a>
         <a href="https://store/app/8/x/"><span class="title">Two</span><div class="search_price">Free To Play</div></a>
         <a><span class="title">No link</span></a>
         <a href="https://store/app/7/x/"><span class="title">Again</span></a>
        </div>"""))
    details = frame_of(spark, ("https://store/app/7/x/", """
        <div id="appHeaderGridContainer"><div class="grid_content"><a>Dev</a></div><div class="grid_content">Pub</div></div>
        <div class="details_block"><a href="/genre/1">RPG</a><a href="/genre/2">Indie 11</a></div>
        <div class="game_area_features_list_ctn"><a>Single-player</a><a>Online Multi-Player</a><a>Single-player</a></div>
        <div class="highlight_screenshot"><img src="https://steam/a.116x65.jpg"></div>"""))
    first, = rows(pages.store_records(listing, details, SOURCE_A), "url")
    assert first["title"] == "One" and first["price"] == "$5.00" and first["original_price"] == "$10.00"
    assert first["platforms"] == "Windows, Mac" and first["rating_score"] == 85 and first["rating_percentage"] == 84
    assert first["genres"] == "RPG, Indie 11" and first["developer"] == "Dev" and first["publisher"] == "Pub"
    assert first["categories"] == "Single-player, Online Multi-Player"
    assert (first["multiplayer"], first["singleplayer"]) == ("Yes", "Yes")
    assert first["screenshots"] == ["https://steam/a.1920x1080.jpg"]
    second = [r for r in rows(pages.listing_a(listing), "position") if r["title"] == "Two"][0]
    assert second["price"] == "Free" and second["rating_score"] is None and second["platforms"] == "N/A"


def test_source_b_skips_vouchers_and_odd_links(spark):
    listing = frame_of(spark, ("list", """
        <article class="item"><a class="cover" href="/en/12-game/"></a><div class="name"><span class="title" title="Full Name">F</span></div></article>
        <article class="item"><a class="cover" href="/en/13-x/"></a><h3>Steam Gift Card</h3></article>
        <article class="item"><a class="cover" href="/en/help/"></a><h3>Help</h3></article>"""))
    found = rows(pages.listing_b(listing), "position")
    assert [(r["url"], r["title"]) for r in found] == [("https://www.instant-gaming.com/en/12-game/", "Full Name")]


def test_source_c_rows_and_add_ons(spark):
    listing = frame_of(spark, ("list", """
        <a class="product-tile" href="/en/game/one_two"><span class="badge">Soon</span><span class="price">-10% $9.00 $10.00</span></a>
        <a class="product-tile" href="/en/game/three"><span class="badge">DLC</span><h3>Three</h3></a>
        <a class="product-tile" href="/en/game/four"><h3>Four - Season Pass</h3></a>"""))
    entry, = rows(pages.listing_c(listing), "position")
    assert entry["title"] == "SOON   One Two" and entry["price"] == "$9.00" and entry["discount_percentage"] == "10%"
    details = frame_of(spark, ("https://www.gog.com/en/game/one_two", """
        <div class="details__row"><div class="details__category">Company:</div><div class="details__content"><a>D</a></div></div>
        <div class="details__row"><div class="details__category">Publisher:</div><div class="details__content"><a>P</a></div></div>
        <div class="details__row"><div class="details__category">Release date:</div><div class="details__content">May 1, 2024</div></div>
        <span class="productcard-os-support__system productcard-os--linux"></span>
        <div class="productcard-rating__details">(76 Reviews)</div>"""))
    record, = rows(pages.details_c(details, {}), "url")
    assert (record["developer"], record["publisher"], record["release_date"]) == ("D", "P", "May 1, 2024")
    assert record["platforms"] == "Linux" and record["rating_count"] == "76" and record["rating"] == "N/A"
    assert record["description"] == "N/A" and record["screenshots"] == [] and record["header_image"] == "N/A"


def test_landing_form_joins_lists(spark):
    frame = spark.createDataFrame([("t", ["a", "b"], [])], "title string, screenshots array<string>, user_tags array<string>")
    landed = pages.as_text_columns(frame, SOURCE_B)
    assert landed.columns == ["title", "screenshots", "user_tags"]
    assert tuple(landed.first()) == ("t", "a|b", "N/A")
    assert tuple(pages.as_text_columns(frame, SOURCE_C).first()) == ("t", "a, b")


def test_media_files_are_registered_without_reading_them(spark, tmp_path):
    for folder, name, size in (("images", "game_1_a_b.jpg", 3), ("videos", "game_2_t.webm", 5), ("images", "game_9_x.jpg", 1), ("images", "note.txt", 1)):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_bytes(b"x" * size)
    games = spark.createDataFrame([(1,), (2,)], "id bigint")
    files = media.media_files(spark, str(tmp_path), games)
    found = [(r["game_id"], r["media_type"], r["file_name"], r["file_size"]) for r in rows(files, "game_id")]
    assert found == [(1, "image", "a_b.jpg", 3), (2, "video", "t.webm", 5)]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_manifest_without_media_is_empty(spark):
    frame = spark.createDataFrame([("u", "N/A", None, None)], "url string, header_image string, screenshots array<string>, videos array<string>")
    assert media.media_manifest(frame, SOURCE_A).count() == 0


def test_sql_parameters_are_not_spliced(spark):
    frame = spark.createDataFrame([("a' OR '1'='1",), ("b",)], "t string")
    found = run_sql(spark, "SELECT t FROM {f} WHERE t = :wanted", {"wanted": "a' OR '1'='1"}, f=frame)
    assert [r["t"] for r in found.collect()] == ["a' OR '1'='1"]
    assert run_sql(spark, "SELECT ? + 1 AS n", [41]).first()["n"] == 42
