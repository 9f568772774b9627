"""CSV landing files: charset choice, missing tokens, arrival order, export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.functions.text import null_if_token
from shelfwise.session import staging, stored

OPTIONS = {"header": "true", "quote": '"', "escape": '"', "inferSchema": "false"}
ARRIVAL = "ingest_ord"


def _reader(spark: SparkSession, encoding: str, multi_line: bool):
    return spark.read.options(**OPTIONS).option("multiLine", multi_line).option("encoding", encoding)


def _with_arrival(df: DataFrame) -> DataFrame:
    """File, block and row order of the scan as one comparable column."""
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select("*", place.alias(ARRIVAL))


def _header_names(line: Column) -> Column:
    """Names of a header line, without quotes and byte-order mark."""
    cells = F.regexp_extract_all(F.ltrim(line, F.lit("\ufeff")), F.lit(r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'), 1)
    return F.transform(cells, lambda c: F.replace(F.regexp_replace(c, r'^"|"$', ""), F.lit('""'), F.lit('"')))


def _open_quotes(line: Column) -> Column:
    """1 if a line holds an odd number of quotes that begin or end a cell: it opens or closes one over its end.

    Doubled quotes are signs of the cell; one amid other signs is no cell's border (``5" disk``).
    """
    borders = F.regexp_count(F.replace(line, F.lit('""'), F.lit("")), F.lit(r'(?<![^,])"|"(?![^,])'))
    return F.when(F.contains(line, F.lit('"')), F.pmod(borders, F.lit(2))).otherwise(0)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value, open) of every line; blocks are the splits in which files are scanned."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    return lines.withColumn("open", _open_quotes(F.col("value")).cast("int"))


def _splits(lines: DataFrame) -> DataFrame:
    """Per file and split: whether it begins inside a cell, is valid UTF-8, and its first line.

    Parities are counted per split and summed along each file: a row per split, not per line.
    """
    placed = lines.withColumn("place", F.monotonically_increasing_id())
    counted = placed.groupBy("file", "block").agg(
        F.sum("open").alias("open"), F.max(~F.is_valid_utf8("value")).alias("latin"), F.min_by("value", "place").alias("first")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("inside", F.coalesce(F.sum("open").over(before), F.lit(0)) % 2 == 1)


PIECE = "file string, block long, row long, kind int, whole int, value binary"
WHOLE, HEAD, TAIL, INSIDE = range(4)  # HEAD ends a record of an earlier split, TAIL begins one, INSIDE does neither


def _pieces(inside: dict[tuple[str, int], bool], kinds: dict[str, int]):
    """Lines in scan order -> records, and at the ends of a split parts of records that cross it.

    ``inside`` names the splits that begin inside a cell, ``kinds`` the files that differ from the rest.
    Records are cut by running parity, for a batch of lines at once; what is held is one open record.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    schema = pa.schema(
        [("file", pa.string()), ("block", pa.int64()), ("row", pa.int64()), ("kind", pa.int32()), ("whole", pa.int32()), ("value", pa.binary())]
    )

    def batch_of(file, block, rows, whole, values):
        n = len(values)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([file] * n, pa.string()), pa.array(np.full(n, block)), pa.array(rows, pa.int64()),
                pa.array(np.full(n, kinds.get(file, 0)), pa.int32()), pa.array(whole, pa.int32()), values.cast(pa.binary()),
            ],
            schema=schema,
        )

    def run(batches):
        split, row, odd, held, held_at, started = None, 0, 0, [], 0, True

        def rest():
            """What is open at the end of a split."""
            if held:
                kind = TAIL if started else INSIDE
                yield batch_of(*split, [held_at], [kind], pa.array([b"\n".join(held)], pa.binary()))

        for batch in batches:
            files, blocks = batch.column("file"), batch.column("block").to_numpy()
            codes = files.dictionary_encode().indices.to_numpy()
            edges = [0, *(np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1).tolist(), batch.num_rows]
            for begin, end in zip(edges, edges[1:]):
                if begin == end:
                    continue
                here = (files[begin].as_py(), int(blocks[begin]))
                if here != split:
                    yield from rest()
                    split, row, held = here, 0, []
                    odd = int(inside.get(here, False))
                    started = not odd
                values, flips = batch.column("value").slice(begin, end - begin), batch.column("open").to_numpy()[begin:end]
                after = (odd + np.cumsum(flips)) % 2
                ends = np.flatnonzero(after == 0)  # lines that end a record
                if not held:
                    held_at = row
                if not len(ends):
                    held += values.to_pylist()
                else:
                    first = int(ends[0])
                    head = b"\n".join([*held, *values.slice(0, first + 1).to_pylist()])
                    yield batch_of(*split, [held_at], [WHOLE if started else HEAD], pa.array([head], pa.binary()))
                    started = True
                    if len(ends) > 1:
                        offsets = pa.array(ends + 1, pa.int32())
                        lists = pa.ListArray.from_arrays(offsets, values.cast(pa.binary()))
                        yield batch_of(*split, row + ends[:-1] + 1, np.zeros(len(ends) - 1, int), pc.binary_join(lists, b"\n"))
                    last = int(ends[-1]) + 1
                    held, held_at = values.slice(last).to_pylist(), row + last
                odd, row = int(after[-1]), row + end - begin
        if split:
            yield from rest()

    return run


def _records(spark: SparkSession, path: str) -> tuple[DataFrame, list[tuple[list[str], bool]]]:
    """(place, kind, value) of every record but the headers, and for each kind of file its names and whether it is Latin-1.

    A first pass counts quote parities per split; where their sum along a file is odd, a split begins inside a cell.
    The second pass cuts records at line ends outside cells, in all splits at once. Only records that cross a
    split are put together by a shuffle. The driver gets the splits that begin inside a cell and the files that differ from the
    most common kind; both are fewer than the splits.
    """
    lines = _lines(spark, path)
    with staging(spark):
        splits = stored(_splits(lines))
        files = splits.groupBy("file").agg(
            F.max("latin").alias("latin"), F.min_by("first", "block").alias("line"), (F.sum("open") % 2 == 1).alias("uneven")
        )
        text = F.when(F.col("latin"), F.decode(F.col("line").cast("binary"), "ISO-8859-1")).otherwise(F.col("line"))
        files = stored(files.select("file", "latin", "uneven", _header_names(text).alias("names")))
        uneven = [r["file"] for r in files.filter("uneven").limit(3).collect()]
        if uneven:
            raise ValueError(f"quotes do not pair up, read with line_breaks=False or mend: {', '.join(uneven)}")
        found = files.groupBy("names", "latin").agg(F.count("*").alias("n"), F.min("file").alias("file")).collect()
        found.sort(key=lambda r: r["file"])
        common = max(found, key=lambda r: r["n"], default=None)
        order = [common, *(r for r in found if r is not common)] if common else []
        number = {(tuple(r["names"]), r["latin"]): k for k, r in enumerate(order)}
        if len(order) > 1:
            other = files.filter(~((F.col("names") == F.lit(order[0]["names"])) & (F.col("latin") == F.lit(order[0]["latin"])))).collect()
            kinds = {r["file"]: number[tuple(r["names"]), r["latin"]] for r in other}
        else:
            kinds = {}
        inside = {(r["file"], r["block"]): True for r in splits.filter("inside").select("file", "block").collect()}
    pieces = lines.withColumn("value", F.col("value").cast("binary")).mapInArrow(_pieces(inside, kinds), PIECE)
    whole = pieces.filter(f"whole = {WHOLE}").select("file", "block", "row", "kind", "value")
    crossing = pieces.filter(f"whole <> {WHOLE}")
    along = Window.partitionBy("file").orderBy("block", "row")
    numbered = crossing.withColumn("record", F.sum((F.col("whole") == TAIL).cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct("block", "row", "value")))
    joined = numbered.groupBy("file", "record", "kind").agg(parts.alias("parts")).select(
        "file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["row"].alias("row"), "kind",
        F.array_join(F.transform("parts", lambda p: p["value"].cast("string")), "\n").cast("binary").alias("value"),
    )
    place = F.struct("file", "block", "row").alias(ARRIVAL)
    records = (whole.unionByName(joined) if inside else whole).filter("block > 0 or row > 0").select(place, "kind", "value")
    return records, [(r["names"], r["latin"]) for r in order]


def _parsed(record: Column, width: int) -> Column:
    """Cells of one record."""
    return F.from_csv(record, ", ".join(f"_c{i} string" for i in range(width)), OPTIONS | {"header": "false"})


def read_csv(spark: SparkSession, path: str, multi_line: bool = False, line_breaks: bool = True) -> DataFrame:
    """All-text CSV scan in which every file that is not valid UTF-8 is read as Latin-1.

    Cells may hold line breaks: files are split for reading all the same, and records are cut at the line ends
    that stand outside cells. A line break inside a cell is read as one line feed. A file whose quotes don't pair
    up is refused; with ``line_breaks=False`` every line is a record, whatever quotes it holds. ``multi_line=True`` leaves
    each file to one task and Spark's own parser.

    A first pass over the lines, aggregated per split and file, finds the charset and each file's header, so files may have
    their columns in different orders: a value goes to the name its own file gives it. The columns are those of all
    headers, null where a file lacks one. Missing tokens become null. Rows carry their file, block and place as ``ARRIVAL``.
    """
    if multi_line or not line_breaks:
        return _read_lines(spark, path, multi_line)
    records, kinds = _records(spark, path)
    names = list(dict.fromkeys(name for header, _ in kinds for name in header))
    width = max((len(header) for header, _ in kinds), default=1)
    latin = F.decode("value", "ISO-8859-1")
    utf8 = F.col("value").cast("string")
    flags = [is_latin for _, is_latin in kinds]
    if len(set(flags)) <= 1:
        text = latin if any(flags) else utf8
    else:
        text = F.when(F.col("kind").isin([k for k, f in enumerate(flags) if f]), latin).otherwise(utf8)
    cells = records.withColumn("text", text).filter(F.trim("text") != "").select(ARRIVAL, "kind", _parsed(F.col("text"), width).alias("cells"))

    def value(name: str) -> Column:
        where: dict[int, list[int]] = {}
        for k, (header, _) in enumerate(kinds):
            where.setdefault(header.index(name) if name in header else -1, []).append(k)
        cell = {at: F.col("cells")[f"_c{at}"] if at >= 0 else F.lit(None).cast("string") for at in where}
        chosen = cell.pop(next(iter(where)))
        for at, column in cell.items():
            chosen = F.when(F.col("kind").isin(where[at]), column).otherwise(chosen)
        return null_if_token(chosen).alias(name)

    return cells.select(*[value(name) for name in names], ARRIVAL)


def _read_lines(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """Spark's own parser, by lines or by whole files.

    Bytes are scanned as Latin-1, which maps each byte to one character, and turned back into
    UTF-8 text unless the file has an invalid line.
    """
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("_file"), place.alias("_place"), "value")
    files = lines.groupBy("_file").agg(
        F.max(~F.is_valid_utf8("value")).alias("_latin"), F.min_by("value", "_place").alias("_line")
    )
    latin_text = F.decode(F.col("_line").cast("binary"), "ISO-8859-1")
    named = files.select(
        "_file", "_latin", _header_names(F.when(F.col("_latin"), latin_text).otherwise(F.col("_line"))).alias("_names")
    )
    headers = [r["_names"] for r in named.groupBy("_names").agg(F.min("_file").alias("f")).orderBy("f").collect()]
    names = list(dict.fromkeys(name for header in headers for name in header))
    places = [f"_c{i}" for i in range(max(map(len, headers), default=1))]
    schema = ", ".join(f"{c} string" for c in places)
    scanned = _with_arrival(_reader(spark, "ISO-8859-1", multi_line).schema(schema).csv(path))
    joined = scanned.join(named, F.col(f"{ARRIVAL}.file") == F.col("_file"))

    def text(name: str) -> Column:
        raw = F.get(F.array(*places), F.array_position("_names", F.lit(name)).cast("int") - 1)
        utf8 = F.decode(F.encode(raw, "ISO-8859-1"), "UTF-8")
        return null_if_token(F.when(F.col("_latin"), raw).otherwise(utf8)).alias(name)

    return joined.select(*[text(name) for name in names], ARRIVAL)


def read_csv_replacing(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All-text CSV scan as UTF-8; undecodable bytes become the replacement character.

    Cells may hold line breaks, as in ``read_csv``. A file whose header differs from the others' stops the scan.
    """
    if multi_line:
        scanned = _with_arrival(_reader(spark, "UTF-8", True).option("enforceSchema", "false").csv(path))
        columns = [null_if_token(F.col(f"`{c}`")).alias(c.removeprefix("\ufeff")) for c in scanned.columns if c != ARRIVAL]
        return scanned.select(*columns, ARRIVAL)
    records, kinds = _records(spark, path)
    headers = list(dict.fromkeys(tuple(header) for header, _ in kinds))
    if len(headers) > 1:
        raise ValueError(f"the CSV header {list(headers[1])} differs from {list(headers[0])}")
    names = headers[0] if headers else ()
    text = F.make_valid_utf8(F.col("value").cast("string"))
    cells = records.withColumn("text", text).filter(F.trim("text") != "").select(ARRIVAL, _parsed(F.col("text"), max(1, len(names))).alias("cells"))
    return cells.select(*[null_if_token(F.col("cells")[f"_c{i}"]).alias(name) for i, name in enumerate(names)], ARRIVAL)


def export_csv(df: DataFrame, path: str, mode: str = "errorifexists", encoding: str = "UTF-8") -> None:
    """Header CSV without a byte-order mark, blanks kept. Lists must be joined to text before."""
    exact = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode(mode).options(header="true", quote='"', escape='"', encoding=encoding, **exact).csv(path)


def save_table(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: tuple[str, ...] = ()) -> None:
    """Canonical sink: Parquet, optionally partitioned."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
