"""Batch files: CSV, JSON lines and pretty JSON, each row with its file path.

Every reader returns the same columns: one string column per accepted field
spelling (null where the file lacks it), ``file`` and ``unreadable`` (the text
of a record that could not be parsed, else null). Formats and layouts then
combine by column name.
"""

from __future__ import annotations

import csv
import gzip
import warnings
import zlib
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txflow.schemas import CSV_GLOB, JSON_GLOB, JSONL_GLOB, KNOWN_NAMES
from txflow.session import first_line

_PATH = "_metadata.file_path"
_AT_ONCE = 32
_CSV = {"header": "true", "quote": '"', "escape": '"', "multiLine": "false", "enforceSchema": "true"}


def manifest(spark: SparkSession, base: str, glob: str = "*", opened: bool = False) -> DataFrame:
    """Files under ``base``: path, length, modificationTime and why one is not read.

    Only the listing is touched, unless the CSV files are to be ``opened`` as
    well, which tells those that can't be read. Empty files are not listed.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", glob).load(base).select("path", "length", "modificationTime"))
    reason = F.when(F.col("path").endswith(".csv.gzip"), F.lit("compressed files must end in .gz"))
    files = files.withColumn("error", reason)
    if not opened:
        return files
    tried = headers(spark, base).select("path", F.col("error").alias("_error"))
    return files.join(tried, "path", "left").withColumn("error", F.coalesce("error", "_error")).drop("_error")


def read_csv(spark: SparkSession, base: str, names: list[str] | None = None, on_error: str = "raise") -> DataFrame | None:
    """All CSV files, every one read under its own header.

    Files that share a header row share one scan, so the plan grows with the
    number of layouts and not with the number of files. A file that can't be
    read stops the load; with ``on_error="skip"`` it is left out with a warning.
    """
    names = KNOWN_NAMES if names is None else names
    layouts = _csv_layouts(spark, base, on_error)
    frames = []
    for header, paths in layouts.items():
        raw = ", ".join(f"_c{i} STRING" for i in range(len(header)))
        rows = spark.read.schema(raw).options(**_CSV).csv(paths)
        cells = [(title, F.col(f"_c{i}")) for i, title in enumerate(header)]
        frames.append(rows.select(*_by_name(cells, names), F.col(_PATH).alias("file"),
                                  F.lit(None).cast("string").alias("unreadable")))
    return _stack(frames)


def read_jsonl(spark: SparkSession, base: str, names: list[str] | None = None) -> DataFrame | None:
    """One JSON object per line, in a single pass: no schema inference scan.

    A line becomes a map from trimmed key to text, so any key spelling is found
    and numbers, booleans and nested values all arrive as text. A line holding
    an array gives one row per element; a broken line is kept as ``unreadable``.
    """
    names = KNOWN_NAMES if names is None else names
    lines = _listed(spark, base, JSONL_GLOB)
    if lines is None:
        return None
    lines = (lines.text(base).where(F.length(F.trim("value")) > 0)
             .select("value", F.col(_PATH).alias("file")))
    records = lines.select("file", "value", F.explode_outer(_objects("value")).alias("m"))
    return records.select(*_by_key("m", names), "file", F.when(F.col("m").isNull(), F.col("value")).alias("unreadable"))


def read_json(spark: SparkSession, base: str, names: list[str] | None = None) -> DataFrame | None:
    """Pretty JSON files: an object or an array of objects spanning lines (UTF-8).

    Files are read in pieces that end with a closing brace, by as many tasks as
    their size asks for, and first checked: only a file that is sound to its end
    gives records. Where braces are also nested or quoted, the pieces of a file
    are sorted and put together to records, so no task holds one whole either.
    What is left, such as a file that can't be parsed, is taken as one text (at
    most 2 GB) by one task; it gives one row with its text in ``unreadable``, a
    null among other elements one with the text null. Nested values keep their
    JSON form. Files without any content and empty arrays give no rows.
    """
    names = KNOWN_NAMES if names is None else names
    reader = _listed(spark, base, JSON_GLOB)
    if reader is None:
        return None
    texts = reader.text(base, wholetext=True)
    pieces = _pieces(_reader(spark, JSON_GLOB), base)
    sound, odd = _sound(pieces)
    frames = [_records(_apart(pieces, odd), names)] if sound else []
    if odd:
        joined = _put_together(pieces.where(F.col("file").isin(odd)))
        sound, broken = _sound(joined)
        frames += [_records(_apart(joined, broken), names)] if sound else []
        frames += [_whole_files(texts.where(F.col(_PATH).isin(broken)), names)] if broken else []
    return _stack(frames or [_whole_files(texts, names)])


def _whole_files(texts: DataFrame, names: list[str]) -> DataFrame:
    """Records of JSON files of which each is one text."""
    text = F.regexp_replace("value", "^\ufeff", "")
    texts = texts.select(text.alias("value"), F.col(_PATH).alias("file")).where(F.col("value").rlike(r"\S"))
    # The text of a file goes on only if it is broken, and never with each of its records.
    alone = (F.size("all") == 1) & F.get("all", F.lit(0)).isNull()
    parsed = texts.select("file", _objects("value").alias("all"), "value").select(
        "file", "all", F.when(F.col("all").isNull() | alone, F.col("value")).otherwise("null").alias("text"))
    nothing = F.array(F.lit(None).cast("MAP<STRING, STRING>"))
    records = parsed.select("file", "text", F.explode(F.coalesce("all", nothing)).alias("m"))
    return records.select(*_by_key("m", names), "file", F.when(F.col("m").isNull(), F.col("text")).alias("unreadable"))


def _pieces(reader, base: str) -> DataFrame:
    """JSON files cut behind every closing brace, which is left out; ``block`` and ``at`` tell a file's pieces in order."""
    return reader.option("lineSep", "}").text(base).select(
        F.col(_PATH).alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_size").alias("size"), "value")


def _apart(pieces: DataFrame, files: list[str]) -> DataFrame:
    return pieces.where(~F.col("file").isin(files)) if files else pieces


_SPACE = " \t\r\n"
#: What a piece can be.
_ODD, _FIRST, _NEXT, _END, _ONLY, _BLANK = range(6)


def _object_in(pieces: DataFrame) -> DataFrame:
    """Adds ``lead``, what stands before a piece's first opening brace, and ``m``, the object behind it if that is all there is."""
    lead = F.substring_index("value", "{", 1)
    begun = F.substr("value", F.length(lead) + 1)
    alone = F.from_json(F.concat(F.lit("["), begun, F.lit("}]")), "ARRAY<MAP<STRING, STRING>>")
    split = pieces.select("*", F.btrim(lead, F.lit(_SPACE)).alias("lead"), alone.alias("all"))
    return split.select("*", F.when(F.size("all") == 1, F.get("all", F.lit(0))).alias("m")).drop("all")


def _sound(pieces: DataFrame) -> tuple[int, list[str]]:
    """How many files consist of nothing but whole objects, alone or in an array, and the names of the others."""
    lead, whole, bare = F.col("lead"), F.col("m").isNotNull(), ~F.col("value").contains("{")
    kind = (F.when(whole & (lead == "["), _FIRST).when(whole & (lead == ","), _NEXT).when(whole & (lead == ""), _ONLY)
            .when(bare & (lead == "]"), _END).when(bare & (lead == ""), _BLANK).otherwise(_ODD))
    told = _object_in(pieces).select("file", "block", "at", "size", F.octet_length("value").alias("bytes"), kind.alias("kind"))
    # Within a block pieces are in the order of ``at``; the kind of the first and last goes with that number.
    tagged = F.col("at") * 8 + F.col("kind")
    blocks = told.groupBy("file", "block").agg(
        F.min(tagged).alias("first"), F.max(tagged).alias("last"), F.count("*").alias("n"),
        F.max("size").alias("size"), F.sum(F.col("bytes") + 1).alias("bytes"),
        *[F.count_if(F.col("kind") == k).alias(f"n{k}") for k in (_FIRST, _NEXT, _END, _ONLY, _BLANK)])
    n = lambda k: F.sum(f"n{k}")
    first, last = F.min_by("first", "block") % 8, F.max_by("last", "block") % 8
    array = (first == _FIRST) & (last == _END) & (n(_FIRST) == 1) & (n(_END) == 1) & (n(_NEXT) + 2 == F.sum("n"))
    # An only object that nothing follows may lack its brace: then the pieces and a brace for each are longer than the file.
    closed = (last == _BLANK) | ((F.sum("bytes") == F.max("size")) & ~F.col("file").endswith(".gz"))
    single = (first == _ONLY) & closed & (n(_ONLY) == 1) & (n(_BLANK) + 1 == F.sum("n"))
    files = blocks.groupBy("file").agg((array | single).alias("sound"))
    return tuple(files.agg(F.count_if("sound"), F.collect_list(F.when(~F.col("sound"), F.col("file")))).first())


def _records(pieces: DataFrame, names: list[str]) -> DataFrame:
    """Records of sound files."""
    objects = _object_in(pieces.where(F.col("value").contains("{")).select("file", "value"))
    return objects.select(*_by_key("m", names), "file", F.lit(None).cast("string").alias("unreadable"))


def _put_together(pieces: DataFrame) -> DataFrame:
    """Pieces joined where a brace ended no element of the file's array: it was nested, or stood in quotes."""
    ahead = Window.partitionBy("file").orderBy("block", "at").rowsBetween(Window.unboundedPreceding, -1)
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"')))
    marked = pieces.select("*", bare.alias("bare"), quotes.alias("quotes"))
    quoted = F.coalesce(F.sum("quotes").over(ahead), F.lit(0)) % 2 == 1
    # Text outside of quotes; a piece that begins within quotes is given the one that opened them.
    marked = marked.select("*", F.regexp_replace(F.when(quoted, F.concat(F.lit('"'), "bare")).otherwise(F.col("bare")),
                                                 '"[^"]*("|$)', "").alias("plain"),
                           (quoted != (F.col("quotes") % 2 == 1)).alias("open")).drop("bare", "quotes")
    size = lambda marks: F.length("plain") - F.length(F.translate("plain", marks, ""))
    steps = size("{[") - size("]") - F.when(F.col("open"), 0).otherwise(1)
    upto = ahead.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    deep = marked.select("file", "block", "at", "value", "open", steps.alias("steps"))
    deep = deep.select("*", (~F.col("open") & (F.sum("steps").over(upto) == 1)).alias("ends"))
    numbered = deep.select("*", F.coalesce(F.count_if("ends").over(ahead), F.lit(0)).alias("record"))
    parts = F.sort_array(F.collect_list(F.struct("block", "at", "value")))
    return numbered.groupBy("file", "record").agg(parts.alias("parts")).select(
        "file", F.lit(0).cast("long").alias("block"), F.col("record").alias("at"), F.lit(-1).cast("long").alias("size"),
        F.array_join(F.transform("parts", lambda p: p["value"]), "}").alias("value"))


def read_all(spark: SparkSession, base: str, names: list[str] | None = None, on_error: str = "raise") -> DataFrame:
    """Everything under ``base``, combined by column name."""
    frames = [read_csv(spark, base, names, on_error), read_jsonl(spark, base, names), read_json(spark, base, names)]
    stacked = _stack([f for f in frames if f is not None])
    if stacked is None:
        raise ValueError(f"no readable CSV, JSON or JSON lines files under {base}")
    return stacked


def _objects(text: str) -> Column:
    """The objects in a JSON text, each a map from key to text: those of an array, or the text's only one."""
    one = F.array(F.from_json(text, "MAP<STRING, STRING>"))
    return F.when(F.col(text).rlike(r"^\s*\["), F.from_json(text, "ARRAY<MAP<STRING, STRING>>")).otherwise(one)


def _by_key(record: str, names: list[str]) -> list[Column]:
    """Pick ``names`` among a map's keys: as written, and with blanks around them only where a record has such keys."""
    padded = F.exists(F.map_keys(record), lambda k: k != F.trim(k))

    def value_of(name: str) -> Column:
        trimmed = F.filter(F.map_entries(record), lambda e: F.trim(e["key"]) == name)
        return F.coalesce(F.try_element_at(record, F.lit(name)),
                          F.when(padded, F.try_element_at(trimmed, F.lit(1))["value"])).alias(name)

    return [value_of(n) for n in names]


def _by_name(cells: list[tuple[str, Column]], names: list[str]) -> list[Column]:
    """Pick ``names`` among titled cells; titles equal after trimming fill each other's gaps."""
    found = defaultdict(list)
    for title, column in cells:
        found[title.strip()].append(column)
    return [(F.coalesce(*found[n]) if n in found else F.lit(None).cast("string")).alias(n) for n in names]


def _stack(frames: list[DataFrame]) -> DataFrame | None:
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _listed(spark: SparkSession, base: str, glob: str):
    """A reader over the matching files, or None where there are none."""
    if not manifest(spark, base, glob).where("error IS NULL").limit(1).count():
        return None
    return _reader(spark, glob)


def _reader(spark: SparkSession, glob: str):
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)


def _csv_layouts(spark: SparkSession, base: str, on_error: str) -> dict[tuple[str, ...], list[str]]:
    """Header row -> files that start with it. What returns is a row per file, as a file scan holds on the driver anyway."""
    try:
        rows = headers(spark, base).collect()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise
        return {}
    layouts, lost = defaultdict(list), []
    for path, header, error in rows:
        if error is not None:
            lost.append(f"{path}: {error}")
        elif header:
            layouts[tuple(header)].append(path)
    if lost:
        message = f"{len(lost)} CSV files can't be read, such as " + "; ".join(sorted(lost)[:5])
        if on_error == "raise":
            raise ValueError(message)
        warnings.warn(message, stacklevel=2)
    return {header: sorted(paths) for header, paths in sorted(layouts.items())}


def headers(spark: SparkSession, base: str) -> DataFrame:
    """path, header (its cells), error of every CSV file under ``base``.

    Tasks fetch a few kilobytes of each file. A file they can't open, for want of
    credentials or because only Spark knows its scheme, is opened from the driver
    by Spark's own file system, as many at a time as ``_AT_ONCE``, and no further
    than its first line; ``error`` tells why a file can't be read that way either.
    """
    listed = manifest(spark, base, CSV_GLOB).where("error IS NULL").select("path")
    wide, schema = spark.sparkContext.defaultParallelism * 4, "path STRING, header ARRAY<STRING>, error STRING"
    heads = listed.repartition(wide).mapInPandas(_first_lines, schema).collect()

    def again(row) -> tuple[str, list[str] | None, str | None]:
        if row.error is None:
            return tuple(row)
        try:
            line = first_line(spark, row.path)
            return row.path, _cells(line) if line is not None else [], None
        except Py4JJavaError:
            return tuple(row)

    with ThreadPoolExecutor(_AT_ONCE) as pool:
        return spark.createDataFrame(list(pool.map(again, heads)), schema)


def _cells(line: str) -> list[str]:
    return next(csv.reader([line.removeprefix("\ufeff").rstrip("\r")]), [])


def _first_lines(batches):
    """Header cells of each listed file, or why there are none."""
    from pyarrow import fs

    for batch in batches:
        found, errors = [], []
        for path in batch["path"]:
            try:
                if path.startswith(("file:", "/")):
                    system, inner = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
                else:
                    scheme, rest = path.split(":", 1)
                    name = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
                    system, inner = fs.FileSystem.from_uri(quote(f"{name}:{rest}", safe=":/@"))
                with system.open_input_stream(inner, compression=None) as raw:
                    stream = gzip.open(raw, "rb") if path.endswith(".gz") else raw
                    line = b""
                    while b"\n" not in line:
                        piece = stream.read(65536)
                        if not piece:
                            break
                        line += piece
                # Bytes that are no UTF-8 become the same replacement as in Spark's reader.
                found.append(_cells(line.split(b"\n")[0].decode("utf-8", "replace")))
                errors.append(None)
            except (OSError, EOFError, ValueError, NotImplementedError, zlib.error) as error:
                found.append(None)
                errors.append(f"{type(error).__name__}: {error}"[:300])
        yield batch.assign(header=found, error=errors)[["path", "header", "error"]]
