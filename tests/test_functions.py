"""Literal input and expected output per scalar function."""

from __future__ import annotations

import datetime
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import arrays, dates, numbers, text, urls
from shelfwise.schemas import SOURCE_A, SOURCE_B, SOURCE_C


def apply(spark, function, values, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = frame.select("i", function(F.col("v")).alias("r")).collect()
    return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]


D = datetime.date


def test_release_date_shapes(spark):
    cases = {
        "30-Oct-25": D(2025, 10, 30), "October 30, 2025": D(2025, 10, 30), "30-Oct-2025": D(2025, 10, 30),
        "2025-10-30": D(2025, 10, 30), "30 Oct, 2025": D(2025, 10, 30), "Oct 30, 2025": D(2025, 10, 30),
        "30-10-2025": D(2025, 10, 30), "2025": D(2025, 1, 1), "soon": None, "30-Oct-69": D(1969, 10, 30),
        "30-Oct-68": D(2068, 10, 30), "29-Feb-72": D(1972, 2, 29), " Oct   30,  2025 ": D(2025, 10, 30),
        "May 5, 2024": D(2024, 5, 5), "31-02-2025": None, "Octember 3, 2025": None, "": None, None: None, "N/A": None,
    }
    assert apply(spark, dates.release_date, list(cases)) == list(cases.values())


def test_release_status(spark):
    day = F.lit(D(2025, 1, 1))
    found = apply(spark, lambda c: dates.release_status(c, day), [D(2025, 1, 1), D(2025, 1, 2), None], "date")
    assert found == ["Released", "Upcoming", "Unknown"]


def test_price(spark):
    cases = {
        "1.234,56": 1234.56, "19,99€": 19.99, "$5.50": 5.5, "Free To Play": 0.0, "N/A": None, "1,234.56": 1.23456,
        "1,234,567": 1.234, "EUR 7": 7.0, "none": None, None: None, "  £3.  ": 3.0, "12.": 12.0,
    }
    assert apply(spark, numbers.price, list(cases)) == list(cases.values())
    american = apply(spark, lambda c: numbers.price(c, "us"), ["1,234.56", "1,234,567", "Free", "$9"])
    assert american == [1234.56, 1234567.0, 0.0, 9.0]


@pytest.mark.parametrize(
    ("value", "source", "expected"),
    [
        ("8.5", SOURCE_B, 85.0), ("4.6", SOURCE_C, 92.0), ("85", SOURCE_A, 85.0), ("11", SOURCE_B, None),
        ("--", SOURCE_B, None), ("No user reviews", SOURCE_A, None), ("-1", SOURCE_A, None), ("1e1", SOURCE_B, 100.0),
        ("5.01", SOURCE_C, None), ("x", SOURCE_A, None), ("85", "elsewhere", None), (" 4.25 ", SOURCE_C, 85.0),
        ("4.6f", SOURCE_C, None),
    ],
)
def test_rating(spark, value, source, expected):
    assert apply(spark, lambda c: numbers.rating(c, F.lit(source)), [value]) == [expected]


def test_text_score_orders(spark):
    texts = [
        "Overwhelmingly Positive<br>95%", "Very Positive", "Mostly Positive", "Mixed", "Mostly Negative",
        "Negative", "Very Negative", "Overwhelmingly Negative", "N/A", None,
    ]
    assert apply(spark, numbers.text_score, texts) == [95, 85, 75, 50, 30, 25, 25, 25, None, None]
    strict = apply(spark, lambda c: numbers.text_score(c, strict=True), texts)
    assert strict == [95, 85, 70, 50, 30, 25, 15, 5, None, None]


def test_price_text(spark):
    def flat(c):
        parsed = numbers.price_text(c)
        return F.concat_ws("|", parsed["price"], parsed["original_price"], parsed["discount_percentage"])

    cases = {
        "-50% $19.99 $9.99": "$19.99|$9.99|50%", "Free": "Free|N/A|N/A", "€ 4.49": "€ 4.49|N/A|N/A",
        "": "N/A|N/A|N/A", "no price": "N/A|N/A|N/A",
    }
    assert apply(spark, flat, list(cases)) == list(cases.values())
    by_size = apply(spark, lambda c: numbers.price_text(c, by_size=True)["price"], ["-50% $19.99 $9.99", "$1.00"])
    assert by_size == ["$9.99", "$1.00"]


def test_counts_and_discounts(spark):
    assert apply(spark, numbers.review_count, ["1,234 reviews", "none", None, "12"]) == [1234.0, None, None, 12.0]
    assert apply(spark, numbers.discount, ["-50%", " 20 ", "N/A", "", None]) == [50.0, 20.0, None, None, None]
    pairs = spark.createDataFrame([(20.0, 15.0, 1.0), (10.0, 12.0, 1.0), (0.0, 5.0, 7.0), (3.0, 2.0, None)], "o double, d double, c double")
    found = pairs.select(numbers.recomputed_discount(F.col("o"), F.col("d"), F.col("c")).alias("r")).collect()
    assert [r["r"] for r in found] == [25.0, 0.0, 7.0, 33.33]


def test_final_price(spark):
    rows = [(10.0, 20.0, None, 8.0), (10.0, 0.0, 5.0, 5.0), (10.0, None, None, 10.0), (None, 5.0, None, None), (10.0, 0.0, None, 10.0)]
    frame = spark.createDataFrame(rows, "o double, d double, k double, e double")
    for row in frame.withColumn("r", numbers.final_price(F.col("o"), F.col("d"), F.col("k"))).collect():
        assert row["r"] == row["e"]


def test_zero_to_null(spark):
    assert apply(spark, lambda c: numbers.zero_to_null(c, "int"), ["85.0", "0", "", "85.9", None]) == [85, None, None, 85, None]
    assert apply(spark, lambda c: numbers.zero_to_null(c, "double"), ["0.0", "4.5"]) == [None, 4.5]


def test_clean_text(spark):
    cases = {
        " a&nbsp;b ": "a b", "a\\nb\\tc": "a b c", "x​ y": "x y", " N/A ": None, "NA": None, "n/a": None, "": None,
        "&amp;&lt;": None, "\x1c ": None, "a  \n b": "a b", "tab\\x": "tab\\x", "R&D": "R&D", None: None, "NAN": "NAN",
    }
    assert apply(spark, text.clean_text, list(cases)) == list(cases.values())


def test_genres_and_titles(spark):
    genres = {"rpg; role-playing|x": "Rpg, Role-Playing", "N/A": None, " ": None, "action,don't": "Action, Don'T", "a|b": None, "x, NA;n/a,na&nbsp;b": "Na B"}
    assert apply(spark, lambda c: text.genre_list(text.clean_text(c)), list(genres)) == list(genres.values())
    titles = {"ROLE-playing 3d": "Role-Playing 3D", "été noir": "Été Noir", "": "", "2nd (ii)  x_y": "2Nd (Ii)  X_Y"}
    assert all(key.title() == value for key, value in titles.items())
    assert apply(spark, text.title_case, list(titles)) == list(titles.values())
    keys = {"  Café: Édition_2! ": "café édition_2", "x ®": "x ", "x": "x", "!!!": "", "½ life²": "½ life²"}
    assert apply(spark, text.title_key, list(keys)) == list(keys.values())


def test_python_agrees_on_unicode_space_and_words(spark):
    """The white-space class and title key equal what Python's own rules give."""
    codes = [c for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    samples = [chr(c) for c in codes]
    stripped = apply(spark, text.strip, [f"{s}a{s}" for s in samples])
    assert stripped == [f"{s}a{s}".strip() for s in samples]
    # Characters of an early Unicode version, which the JVM and Python surely both know.
    letters = [s for s in samples if unicodedata.ucd_3_2_0.category(s) != "Cn"]
    keyed = apply(spark, text.title_key, [f"a{s}b" for s in letters])
    expected = [re.sub(r"[^\w\s]", "", f"a{s}b".lower().strip()) for s in letters]
    different = [(hex(ord(s)), k, e) for s, k, e in zip(letters, keyed, expected) if k != e]
    assert not different


def test_platform_and_sentinels(spark):
    assert apply(spark, text.clean_platform, [" none ", "NULL", "N/A", " PC ", ""]) == [None, None, None, "PC", None]
    assert apply(spark, text.null_if_token, ["N/A", "NaN", "", "x", "<NA>", "a,b"]) == [None, None, None, "x", None, "a,b"]


def test_fix_encoding(spark):
    cases = {"Itâ€™s": "It—TMs", "â€œquoteâ€\x9d": '"quote"', "Â©Â x": "© x", "ﬁ  \t x\x07": "fi x", "   ": "   ", None: None, "plain": "plain"}
    assert apply(spark, text.fix_encoding, list(cases)) == list(cases.values())
    assert apply(spark, lambda c: text.fix_encoding(c, repair_first=True), ["Itâ€™s", "â€˜x"]) == ["It's", "'x"]


def test_names_and_status(spark):
    assert apply(spark, text.safe_name, ['a<b>:"/\\|?*c']) == ["abc"]
    assert apply(spark, lambda c: text.safe_name(c, 80, True, True), [" x\x01" + "y" * 100]) == ["x" + "y" * 79]
    assert apply(spark, text.slug_title, ["https://h/en/game/baldurs_gate-iii/"]) == ["Baldurs Gate Iii"]
    assert apply(spark, text.status_tag, [" soon ", "new", "Pre-order"]) == ["SOON", "", "PRE-ORDER"]
    assert apply(spark, lambda c: text.with_status_prefix(c, F.lit("SOON")), ["Game", "SOON Game"]) == ["SOON   Game", "SOON Game"]
    assert apply(spark, text.flat_text, [" a\nb\r\tc ", "N/A", "", None]) == ["a b c", "N/A", "N/A", "N/A"]


def test_description(spark):
    long = "word " * 30
    cases = {
        long + "...": long.strip(), "short": "N/A", long + "Originally released in 1990": long.strip(),
        "Originally released in " + long: "N/A", "z" * 2000: "z" * 2000, None: "N/A",
    }
    assert apply(spark, text.description, list(cases)) == list(cases.values())
    assert apply(spark, lambda c: text.description(c, F.lit(long)), ["short"]) == [long.strip()]
    assert apply(spark, lambda c: text.description(c, limit=1000), ["z" * 2000]) == ["z" * 1000]
    assert apply(spark, lambda c: text.requirements_text(c, 3), [" abcd "]) == ["abc"]


def test_urls(spark):
    assert apply(spark, urls.product_id, ["/en/123-x/", "/en/x"]) == ["123", None]
    assert apply(spark, lambda c: urls.absolute_url(c, "https://h"), ["//c/x", "/x", "https://a", None]) == [
        "https://c/x", "https://h/x", "https://a", None,
    ]
    assert apply(spark, urls.full_size_screenshot, ["a.116x65.jpg"]) == ["a.1920x1080.jpg"]
    assert apply(spark, urls.large_image, ["a_256.jpg", "a-thumb.png", "a_999.jpg"]) == ["a_1024.jpg", "a-1024.png", "a_999.jpg"]
    assert apply(spark, urls.video_extension, ["x.m3u8", "x.mpd", "x.mp4?a", "x.webm"]) == [".txt", ".txt", ".mp4", ".webm"]
    assert apply(spark, urls.image_extension, ["x.PNG", "x.webp", "x.gif"]) == ["png", "webp", "jpg"]
    direct = apply(spark, urls.direct_video_urls, ["https://v/1/hls_264.m3u8?t=1"])[0]
    assert direct[0] == "https://v/1/movie_max_vp9.webm" and len(direct) == 6


def test_video_precedence(spark):
    embedded = "https://x/store_item_assets/a.webm"
    page = (
        '<source src="https://shared.fastly.steamstatic.com/store_item_assets/steam/apps/7/extras/e.webm">'
        '"https://video.cdn/store_trailers/steamdeck/1/movie480.webm" "https://video.cdn/store_trailers/7/movie480.webm"'
    )
    rows = [
        ([embedded, "https://x/other.webm"], '{"trailers":[{"hlsManifest":"https:\\/\\/v\\/1\\/hls_1.m3u8"}]}', page),
        ([], None, page),
        ([], "not json", ""),
    ]
    frame = spark.createDataFrame(rows, "e array<string>, j string, h string")
    found = frame.select(
        urls.video_urls(F.col("e"), F.col("j"), urls.page_video_urls(F.col("h"), 3), F.lit("https://s/app/7/x/"), 3).alias("v")
    ).collect()
    extras = "https://shared.fastly.steamstatic.com/store_item_assets/steam/apps/7/extras/e.webm"
    assert found[0]["v"] == [embedded, "https://v/1/movie_max_vp9.webm", extras]
    assert found[1]["v"] == [extras, "https://video.cdn/store_trailers/7/movie480.webm"]
    assert found[2]["v"] == ["https://cdn.akamai.steamstatic.com/steam/apps/7/movie480.webm"]


def test_arrays(spark):
    lists = [["b", "a", "b"], [], None]
    assert apply(spark, lambda c: arrays.distinct_items(c, 10), lists, "array<string>") == [["b", "a"], [], None]
    assert apply(spark, arrays.delimited, lists, "array<string>") == ["b|a|b", "N/A", "N/A"]
    assert apply(spark, lambda c: arrays.yes_no(c, "multi"), [["Online Multi-player"], ["x"], None], "array<string>") == ["Yes", "No", "No"]
    assert apply(spark, arrays.platforms_in, ["works on windows and OS X", "none"]) == ["Windows, Mac", "N/A"]
    assert apply(spark, arrays.user_tags, [["RPG", "...", " x "]], "array<string>") == [["RPG", "x"]]
    assert apply(spark, arrays.short_genres, [["RPG", "-", "y" * 40, "101 Tag 1"]], "array<string>") == [["RPG", "101 Tag 1"]]


def test_nfkc_holds_a_slice_of_a_batch_as_strings():
    import tracemalloc
    import unicodedata

    import pyarrow as pa

    texts = [f"{i} ﬁ½ " * 300 for i in range(8000)] + [None, "", "Å" * 3_000_000, "plain"]
    values = pa.array(texts, pa.string())
    tracemalloc.start()
    normal = text._normalizer().func(values)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert values.nbytes > 20_000_000 and peak < 25_000_000
    assert normal.to_pylist() == [t if t is None else unicodedata.normalize("NFKC", t) for t in texts]
    assert text._normalizer().func(values.slice(0, 0)).to_pylist() == []
