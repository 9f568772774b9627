"""Secret scan: fixed patterns, and strings that zstandard cannot explain from their surroundings.

Assignments, access keys and hex runs are found by pattern. Other candidates are long mixed
strings that follow a sensitive word, or a string that does, or stand in a BEGIN/END block. Each is compressed together with the text around it, the
compressor primed with a dictionary of identifiers; its marginal bytes are what it adds. A name
or a word whose parts occur nearby adds little, a random string adds nearly its own length.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import per_worker, with_computed

# Fixed patterns and lengths of the scan.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGNED_WORDS = ("passw", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "novel")

SENSITIVE = re.compile(r"passw|secret|token|key|credential|bearer|auth|private|signature|salt", re.IGNORECASE | re.ASCII)
SENSITIVE_WORDS = ("passw", "secret", "token", "key", "credential", "bearer", "auth", "private", "signature", "salt")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]+)-----")
END = re.compile(r"-----END ([A-Z0-9 ]+)-----")
BLOCK_LINE = re.compile(r"^[ \t>]*(=?[A-Za-z0-9+/]{4,}={0,2})[ \t\r]*$", re.MULTILINE)

# What the compressor knows beforehand: words of code and configuration.
IDENTIFIERS = (
    "import from return class function const public private static void string int float boolean null true false "
    "self this value values name names index items list array object config configuration settings default "
    "environment variable username password passwd secret token access_token refresh_token api_key apikey "
    "authorization bearer basic credential credentials signature certificate private_key public_key client_id "
    "client_secret connection_string database hostname localhost endpoint request response header headers "
    "content-type application/json multipart/form-data https://www. http:// .com .org .net .json .yaml .txt "
    "version build release deploy service server client session cookie expires timestamp created_at updated_at "
    "AKIA example EXAMPLE 0123456789 0000000000 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ"
)


def sensitive_blocks(text: str) -> list[tuple[int, int]]:
    """Spans between a BEGIN mark of a sensitive name and the next END mark of that name; blocks don't overlap.

    END marks are listed by name once, so marks without a partner cost no further search.
    """
    ends: dict[str, list[tuple[int, int]]] = {}
    for m in END.finditer(text):
        ends.setdefault(m[1], []).append(m.span())
    out, at = [], 0
    for m in BEGIN.finditer(text):
        marks = ends.get(m[1], [])
        k = bisect_left(marks, (m.end(), 0))
        if m.start() >= at and k < len(marks):
            at = marks[k][1]
            if SENSITIVE.search(m[1]):
                out.append((m.end(), marks[k][0]))
    return out


class Novelty:
    """Marginal compressed bytes of a string against its surroundings and a dictionary."""

    def __init__(self, identifiers: str):
        primed = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(
            level=9, dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False
        )

    def share(self, candidate: str, around: str) -> float:
        """Marginal bytes of ``candidate`` after ``around``, as a share of its length."""
        known = around.encode("utf-8", "replace")
        added = len(self.compressor.compress(known + candidate.encode())) - len(self.compressor.compress(known))
        return added / len(candidate)


def novelty(identifiers: str) -> Novelty:
    return per_worker(("novelty", identifiers), lambda: Novelty(identifiers))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, leftmost and non-overlapping for each kind."""
    spans = []
    low = text.lower()
    if any(w in low for w in ASSIGNED_WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return spans


def surroundings(text: str, start: int, end: int, window: int) -> str:
    """The text around a candidate, its own other occurrences blanked, also those that the window's edge divides."""
    value = text[start:end]
    own = value.rstrip("=").rpartition("=")[2]  # behind a name
    own = own if len(own) >= 16 else value
    whole = re.compile(rf"(?<![A-Za-z0-9+/_-]){re.escape(own)}(?![A-Za-z0-9+/_-])")  # not as part of another name
    without = lambda part: whole.sub(" " * len(own), part) if own in part else part
    low = max(0, start - window)
    further = max(0, low - len(own))
    return without(text[further:start])[low - further :] + without(text[end : end + window + len(own)])[:window]


def novel_spans(
    text: str, taken: list[tuple[int, int, int]], judge: Novelty, reach: int, window: int, least: float
) -> list[tuple[int, int, int]]:
    """Candidates in a sensitive context that no base span touches and that do not compress.

    The context is a sensitive word before, a string found before, a string with a sensitive context and no
    word in between, or a BEGIN/END block with a sensitive name. Of a block with a string found, every line is given.
    """
    low = text.lower()
    if not any(w in low for w in SENSITIVE_WORDS):
        return []
    found, at = [], 0
    covered: list[list[int]] = []
    for start, _, end in sorted(taken):
        if covered and start < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])

    def free(start: int, end: int) -> bool:
        nonlocal at
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        return at == len(covered) or covered[at][0] >= end

    blocks = sensitive_blocks(text) if "-----BEGIN " in text else []
    block = 0
    told = last = -1  # ends of the last string found and of the last one with a sensitive context
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while block < len(blocks) and blocks[block][1] <= start:
            block += 1
        inside = block < len(blocks) and blocks[block][0] <= start
        near = told >= 0 and start - told <= reach
        adjoining = last >= 0 and start - last <= reach and not any(c.isalnum() for c in text[last:start])
        if not (inside or near or adjoining or SENSITIVE.search(text, max(0, start - reach), start)):
            continue
        last = end
        if not free(start, end):
            continue
        value = m[0]
        if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
            continue
        if judge.share(value, surroundings(text, start, end, window)) >= least:
            found.append((start, 3, end))
            told = end
    at = 0
    for first, behind in blocks:
        if any(first <= start < behind for start, _, _ in found):
            lines = [m.span(1) for m in BLOCK_LINE.finditer(text, first, behind)]
            have = {x for start, _, end in found if first <= start < behind for x in range(start, end)}
            found += [(start, 3, end) for start, end in lines if free(start, end) and start not in have]
    return found


def scan(
    docs: DataFrame,
    into: str = "secrets",
    text: str = "text",
    identifiers: str = IDENTIFIERS,
    reach: int = 160,
    window: int = 512,
    least: float = 0.7,
) -> DataFrame:
    """Rows of ``docs`` plus ``into``: spans (kind, start, end) by start, then kind; code points, end exclusive.

    ``reach``: how far before a candidate the sensitive word, or a string found, may stand. ``window``: code points of
    surroundings on each side. ``least``: marginal bytes a byte from which a candidate is reported.
    Every text is scanned whole. Null and empty texts have no spans (an empty list). Repeated rows
    get equal spans. A column already named ``into`` is replaced, others are carried along.
    """
    kind = T.ArrayType(
        T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    )

    def spans_of(value: str | None) -> list[dict]:
        if not value:
            return []
        spans = base_spans(value)
        spans += novel_spans(value, spans, novelty(identifiers), reach, window, least)
        return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(spans)]

    return with_computed(docs, into, kind, text, lambda: lambda texts: [spans_of(t) for t in texts])


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def report(docs: DataFrame) -> DataFrame:
    """Per document: counts of each base kind, a digest of the base spans, and all spans as text."""
    spans = F.col("secrets")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return scan(docs.select("doc_id", "text")).select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(listed(F.filter(spans, lambda s: s["kind"] != "novel")), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
    )
