"""Text cleaning, title keys, safe names and descriptions."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shelfwise.schemas import NA_TOKENS, PLATFORM_NA_TOKENS, TEXT_NA_TOKENS

# Unicode white space inside a (?U) pattern: Java's own class lacks U+001C..U+001F.
SPACE = r"\s\x1c-\x1f"
# The same characters as text, for trimming without a pattern.
SPACE_CHARACTERS = "".join(
    chr(code)
    for first, last in (
        (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
        (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
    )
    for code in range(first, last + 1)
)

# --------------------------------------------------------------------------
# These must equal the catalogue's cleaning rules.
# --------------------------------------------------------------------------
ENTITIES = ("nbsp", "amp", "lt", "gt", "quot")
MOJIBAKE = (
    ("â€™", "'"),
    ("â€˜", "'"),
    ("â€œ", '"'),
    ("â€\x9d", '"'),
    ("â€", "—"),
    ("â„¢", "™"),
    ("Â®", "®"),
    ("Â©", "©"),
    ("Â ", " "),
    ("Â", ""),
)
CONTROL_CHARACTERS = r"[\x00-\x08\x0B-\x0C\x0E-\x1F\x7F]"
DESCRIPTION_JUNK = (
    "Discover the grim dark universes",
    "Originally released in",
    "See new chat messages",
    "friend invites",
)
DESCRIPTION_MINIMUM = 50
STATUS_TAGS = ("SOON", "PRE-ORDER", "MOD", "COMING")


def strip(c: Column) -> Column:
    """Remove leading and trailing Unicode white space."""
    return F.btrim(c, F.lit(SPACE_CHARACTERS))


def squeeze(c: Column) -> Column:
    """Collapse runs of Unicode white space to one blank and trim."""
    return F.trim(F.regexp_replace(c, f"(?U)[{SPACE}]+", " "))


def null_if_token(c: Column, tokens=NA_TOKENS) -> Column:
    """Missing-value tokens of the CSV reader become null (no token holds a comma)."""
    return F.when(F.find_in_set(c, F.lit(",".join(tokens))) == 0, c)


def clean_text(c: Column) -> Column:
    """Null for missing tokens and blanks; entities, NBSP, ZWSP and escaped breaks become blanks.

    Entities and escapes are only looked for in text that has an ``&`` or a backslash.
    """
    suspicious = c.contains("&") | c.contains("\\")
    noise = rf"&(?:{'|'.join(ENTITIES)});|\\[nrt]"
    plain = F.when(suspicious, F.regexp_replace(c, noise, " ")).otherwise(c)
    spaced = F.trim(F.regexp_replace(plain, rf"(?U)[{SPACE}\x{{200b}}]+", " "))
    return F.nullif(F.when(~strip(c).isin(*TEXT_NA_TOKENS), spaced), F.lit(""))


def flat_text(c: Column) -> Column:
    """One-line form for CSV cells: breaks and tabs become blanks, carriage returns vanish."""
    flat = strip(F.replace(F.regexp_replace(c, r"[\n\t]", " "), F.lit("\r"), F.lit("")))
    return F.when(c.isNull() | c.isin("", "N/A"), F.lit("N/A")).otherwise(flat)


# A noncharacter, which text cannot hold, followed by the blank that initcap looks for.
_WORD_MARK = "\uffff "


def title_case(c: Column) -> Column:
    """Capitalise every run of cased letters ("role-playing" -> "Role-Playing").

    ``initcap`` only capitalises after blanks, so every start of a letter run is marked by one
    and unmarked afterwards.
    """
    marked = F.regexp_replace(c, r"(?<=[^\p{Lu}\p{Ll}\p{Lt}])(?=[\p{Lu}\p{Ll}\p{Lt}])", _WORD_MARK)
    return F.replace(F.initcap(marked), F.lit(_WORD_MARK), F.lit(""))


def title_key(c: Column) -> Column:
    """Matching key of a title: lower case, trimmed, punctuation removed (trim comes first)."""
    return F.regexp_replace(strip(F.lower(c)), rf"(?U)[^\p{{L}}{SPACE}\p{{N}}_]", "")


def genre_list(c: Column) -> Column:
    """Split on ``, ; |``, drop missing tokens and parts of one character, title-case the rest.

    ``c`` is text that ``clean_text`` has cleaned, so its parts only need trimming; the
    separators are no letters, so the joined text is title-cased at once.
    """
    parts = F.transform(F.split(F.when(c != "N/A", c), r"[,;|]"), lambda g: F.trim(g))
    kept = F.filter(parts, lambda g: (F.length(g) > 1) & ~g.isin(*TEXT_NA_TOKENS))
    return F.nullif(title_case(F.array_join(kept, ", ")), F.lit(""))


def genre_names(c: Column) -> Column:
    """Array of trimmed non-empty names from a comma list."""
    return F.filter(F.transform(F.split(c, ","), strip), lambda g: g != "")


def clean_platform(c: Column) -> Column:
    trimmed = strip(c)
    return F.when(~F.lower(trimmed).isin(*PLATFORM_NA_TOKENS), trimmed)


def _normalizer():
    """The UDF is built from a local function, so workers receive it by value and need
    nothing installed but pyarrow. Of a batch, only a slice at a time is held as Python strings."""
    slice_bytes = 1_000_000

    def normalize(values: pa.Array) -> pa.Array:
        rows = max(1, slice_bytes * len(values) // max(1, values.nbytes))
        parts = (values.slice(at, rows).to_pylist() for at in range(0, len(values), rows))
        normal = ([v if v is None else unicodedata.normalize("NFKC", v) for v in part] for part in parts)
        return pa.concat_arrays([pa.array([], pa.string()), *(pa.array(part, pa.string()) for part in normal)])

    return F.arrow_udf(normalize, StringType())


def nfkc(c: Column) -> Column:
    """Unicode NFKC. ASCII text is already normal, so only other text crosses to Python."""
    return F.coalesce(_normalizer()(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)


def replace_mojibake(c: Column) -> Column:
    """The mojibake table in order, applied only to text that can match a row of it.

    The rows that begin with the second lead character only remove it, so they are one replacement.
    """
    first, second = MOJIBAKE[0][0][0], MOJIBAKE[-1][0]
    removed = F.replace(c, F.lit(second), F.lit(""))
    repaired_text = c
    for damaged, repaired in MOJIBAKE:
        if damaged.startswith(first):
            repaired_text = F.replace(repaired_text, F.lit(damaged), F.lit(repaired))
    both = F.replace(repaired_text, F.lit(second), F.lit(""))
    return (
        F.when(c.contains(first) & c.contains(second), both)
        .when(c.contains(first), repaired_text)
        .when(c.contains(second), removed)
        .otherwise(c)
    )


def fix_encoding(c: Column, repair_first: bool = False) -> Column:
    """NFKC, mojibake table, control characters removed, blanks collapsed, trimmed.

    The default order normalises first, which turns the trade-mark and small-tilde signs of
    two table rows into other characters, so these rows do not match. ``repair_first`` runs
    the table before normalisation. Blank text is returned unchanged.
    """
    repaired = nfkc(replace_mojibake(c)) if repair_first else replace_mojibake(nfkc(c))
    blanks = F.regexp_replace(F.regexp_replace(repaired, CONTROL_CHARACTERS, ""), r"[ \t]+", " ")
    return F.when(strip(c) != "", strip(blanks)).otherwise(c)


def safe_name(c: Column, limit: int | None = None, control: bool = False, strip_first: bool = False) -> Column:
    """File-system name: reserved characters removed; ``limit`` cuts it to so many characters.

    ``control`` also removes control characters; ``strip_first`` trims before the cut.
    """
    reserved = r'[<>:"/\\|?*\x00-\x1F]' if control else r'[<>:"/\\|?*]'
    name = F.regexp_replace(c, reserved, "")
    whole = strip(name) if strip_first else name
    return whole if limit is None else F.left(whole, F.lit(limit))


def slug_title(url: Column) -> Column:
    """Title from the last ``/game/`` segment of a URL."""
    slug = F.regexp_replace(F.substring_index(url, "/game/", -1), "^/+|/+$", "")
    return title_case(F.translate(slug, "_-", "  "))


def status_tag(badge: Column) -> Column:
    """Upper-cased badge when it names a release status, else an empty text."""
    tag = F.upper(strip(badge))
    return F.when(tag.rlike("|".join(STATUS_TAGS)), tag).otherwise(F.lit(""))


def with_status_prefix(title: Column, tag: Column) -> Column:
    """Title with the tag in front, unless it already starts with it."""
    needed = (F.coalesce(tag, F.lit("")) != "") & ~F.startswith(title, tag)
    return F.when(needed, F.concat(tag, F.lit("   "), title)).otherwise(title)


def description(summary: Column, meta: Column | None = None, limit: int | None = None) -> Column:
    """Summary text without ellipsis and page furniture; short ones fall back to the meta tag.

    ``limit`` cuts either to so many characters.
    """
    long_enough = F.length(strip(summary)) > DESCRIPTION_MINIMUM
    text = F.regexp_replace(strip(summary), r"\.{3,}$", "")
    text = squeeze(text)
    for phrase in DESCRIPTION_JUNK:
        text = strip(F.substring_index(text, phrase, 1))
    main = _long_part(F.when(long_enough, text), limit)
    return F.coalesce(main, F.lit("N/A")) if meta is None else F.coalesce(main, _long_part(strip(meta), limit), F.lit("N/A"))


def _long_part(c: Column, limit: int | None) -> Column:
    """A text that is long enough, cut to ``limit`` characters, else null; reads the text once."""
    kept = F.regexp_extract(c, rf"(?s)^.{{{DESCRIPTION_MINIMUM + 1},{'' if limit is None else limit}}}", 0)
    return F.nullif(kept, F.lit(""))


def requirements_text(c: Column, limit: int | None = None) -> Column:
    """A requirements block, cut to ``limit`` characters."""
    return strip(c) if limit is None else F.left(strip(c), F.lit(limit))


def requirements_list(items: Column) -> Column:
    """Requirement items joined by a pipe, ``N/A`` when there are none."""
    return F.when(F.size(items) > 0, F.array_join(F.transform(items, flat_text), " | ")).otherwise(F.lit("N/A"))
