"""Reading flat exports: all-text scan, header clean-up, row order, staging.

``read_export`` reads text as text. Types come later from column functions, so a
dirty cell is a reject with a reason and never a failed read.
"""

from __future__ import annotations

import csv
import io
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leaseload.functions.text import is_empty, squeeze
from leaseload.sources.contracts import NA_CELLS, TOTALS_COLUMN

ROW_ORDER = "_row_ord"


def normal_header(raw: list[str]) -> list[str]:
    """Trimmed upper-case names; the n-th repeat of a name gets ".n"."""
    seen: dict[str, int] = {}
    names = []
    for cell in raw:
        name = cell.strip().upper()
        n = seen.get(name, 0)
        seen[name] = n + 1
        names.append(name if n == 0 else f"{name}.{n}")
    return names


def _data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_")]


def with_header(df: DataFrame, upper: bool = True) -> DataFrame:
    """Normalise the names of a frame that is already in memory or in parquet."""
    names = [c if c.startswith("_") else (c.strip().upper() if upper else c.strip()) for c in df.columns]
    renamed = df.toDF(*names)
    return renamed.drop(*[c for c in renamed.columns if c.strip().upper() == TOTALS_COLUMN])


def na_to_null(df: DataFrame) -> DataFrame:
    cells = [
        F.when(~F.col(f"`{c}`").isin(*NA_CELLS), F.col(f"`{c}`")).alias(c) if c in _data_columns(df) else F.col(c)
        for c in df.columns
    ]
    return df.select(*cells)


def trim_cells(df: DataFrame) -> DataFrame:
    return df.select(*[squeeze(f"`{c}`").alias(c) if c in _data_columns(df) else F.col(c) for c in df.columns])


def fill_blank(df: DataFrame) -> DataFrame:
    return df.na.fill("", subset=_data_columns(df))


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.na.drop(how="all", subset=_data_columns(df))


def drop_blank_key(df: DataFrame, key: Column | str) -> DataFrame:
    """Drop footer and summary rows, which have no key."""
    return df.filter(~is_empty(key))


# One set of options for batch and stream.
READ_OPTIONS = {"quote": '"', "escape": '"', "header": "true"}


def header_cells(lines: list[str]) -> list[str]:
    """Cells of a header that may hold line breaks inside quotes."""
    text = ""
    for line in lines:
        text += line if not text else f"\n{line}"
        if text.count('"') % 2 == 0:
            break
    return next(csv.reader(io.StringIO(text.lstrip("\ufeff"))), [])


# Sources of one row per file and per distinct header come to the driver; more headers
# than this are no export.
MOST_HEADERS = 1_000
FALLBACK_ENCODING = "ISO-8859-1"
QUOTE, DELIMITER, LINE_END = '"', ",", "\n"

# Where a line is: at the start of a cell, within an unquoted cell, within quotes, or
# behind a closing quote (which a second quote opens again).
_START, _WITHIN, _QUOTED, _CLOSED = range(4)


def _after_text(state: Column, part: Column) -> Column:
    """State after the text between two quotes."""
    outside = F.when(part.endswith(DELIMITER), _START).otherwise(_WITHIN)
    behind = F.when(part == "", _CLOSED).otherwise(outside)
    return F.when(state == _QUOTED, _QUOTED).when(state == _CLOSED, behind).otherwise(outside)


def _after_quote(state: Column) -> Column:
    """State after a quote: it opens a cell only at the cell's start, as in ``1,5" door`` it does not."""
    return F.when(state == _START, _QUOTED).when(state == _QUOTED, _CLOSED).when(state == _CLOSED, _QUOTED).otherwise(_WITHIN)


def ends_open(line: Column, inside: bool) -> Column:
    """Whether a line that begins at a record's start (or ``inside`` quotes) ends within quotes."""
    parts = F.split(line, QUOTE)
    if inside:
        begin = F.lit(_QUOTED)
    else:
        head = F.element_at(parts, 1)
        begin = F.when((head == "") | head.endswith(DELIMITER), _START).otherwise(_WITHIN)
    rest = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    state = F.aggregate(rest, begin.cast("int"), lambda s, part: _after_text(_after_quote(s), part).cast("int"))
    return F.when(F.contains(line, F.lit(QUOTE)), state == _QUOTED).otherwise(F.lit(inside))


def scanned(spark: SparkSession, path: str, encoding: str | None = None, folder: str | None = None) -> DataFrame:
    """The lines of all files, read once and in splits, and stored.

    Columns path, block, line (rising within a block), value (bytes), utf8, and whether the
    line ends within quotes if it begins at a record's start (``open``) or within quotes
    (``stays``). A split does not know which of the two holds; :func:`_records` finds out.
    """
    reader = spark.read.option("lineSep", LINE_END)
    line = F.col("value")
    lines = (reader.option("encoding", encoding) if encoding else reader).text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        line.cast("binary").alias("value"),
        F.is_valid_utf8(line).alias("utf8"),
        ends_open(line, inside=False).alias("open"),
        ends_open(line, inside=True).alias("stays"),
        (F.trim(F.replace(line, F.lit("\r"), F.lit(""))) == "").alias("blank"),
    )
    return stage(lines, folder)


def _files(lines: DataFrame) -> DataFrame:
    """One row per file: its number by name, its encoding, its first line, whether any line opens a quoted cell."""
    filled = F.when(~F.col("blank"), F.col("line"))
    blocks = lines.groupBy("path", "block").agg(
        F.min(filled).alias("line"), F.min("utf8").alias("utf8"), F.max("open").alias("open")
    )
    files = blocks.groupBy("path").agg(
        F.min("utf8").alias("utf8"),
        F.max("open").alias("open"),
        F.min(F.when(F.col("line").isNotNull(), F.struct("block", "line"))).alias("first"),
    )
    # One row per file; numbers follow the names.
    number = F.row_number().over(Window.orderBy("path"))
    return files.filter("first IS NOT NULL").select(
        F.col("path").alias("file_path"), number.alias("file"), F.col("utf8").alias("file_utf8"),
        F.col("open").alias("file_open"), F.col("first.block").alias("first_block"), F.col("first.line").alias("first_line"),
    )


def _records(lines: DataFrame) -> DataFrame:
    """Records of files with quoted line breaks: (file, block, line, text) by the record's first line.

    A line maps "within quotes before it" to "within quotes after it". Maps that do not
    depend on the state before are constants; between two of them it only turns over. So
    the state before a line is the last constant and the number of turns since, within
    its block, or what the earlier blocks hand over: a prefix over one row per block.
    Blocks stay separate tasks; only records that run over a line end are put together.
    """
    constant = F.col("open") == F.col("stays")
    turns = (F.col("open") & ~F.col("stays")).cast("int")
    in_block = Window.partitionBy("path", "block").orderBy("line")
    upto, before = in_block.rowsBetween(Window.unboundedPreceding, 0), in_block.rowsBetween(Window.unboundedPreceding, -1)
    marked = lines.withColumn("turned", F.sum(turns).over(upto))
    # What a constant leaves, with the turns before it taken out.
    left = F.when(constant, (F.col("open").cast("int") + F.col("turned")) % 2)
    marked = marked.withColumns(
        {"left": F.last(left, ignorenulls=True).over(before), "so_far": F.coalesce(F.sum(turns).over(before), F.lit(0))}
    )
    whole = marked.groupBy("path", "block").agg(
        F.max("turned").alias("turned"), F.max(F.when(constant, F.struct("line", left.alias("left")))).alias("last")
    )
    by_file = Window.partitionBy("path").orderBy("block")
    so_far = by_file.rowsBetween(Window.unboundedPreceding, 0)
    earlier = by_file.rowsBetween(Window.unboundedPreceding, -1)
    summed = whole.withColumn("turns", F.sum("turned").over(so_far))
    kept = F.when(F.col("last").isNotNull(), (F.col("last.left") + F.col("turns") - F.col("turned")) % 2)
    summed = summed.withColumn("kept", kept)
    entry = (F.coalesce(F.last("kept", ignorenulls=True).over(earlier), F.lit(0)) + F.coalesce(F.sum("turned").over(earlier), F.lit(0))) % 2
    final = (F.coalesce(F.last("kept", ignorenulls=True).over(so_far), F.lit(0)) + F.col("turns")) % 2
    last_block = F.lead("block").over(by_file).isNull()
    unclosed = F.raise_error(F.concat(F.lit("a quoted cell is not closed in "), F.col("path")))
    entries = summed.select(
        F.col("path").alias("entry_path"), F.col("block").alias("entry_block"),
        F.when(last_block & (final == 1), unclosed.cast("int")).otherwise(entry).alias("entry"),
    )
    stated = marked.join(entries, (F.col("path") == F.col("entry_path")) & (F.col("block") == F.col("entry_block")))
    quoted_before = (F.coalesce("left", "entry") + F.col("so_far")) % 2 == 1
    stated = stated.withColumn("within", quoted_before).withColumn(
        "goes_on", F.when(F.col("within"), F.col("stays")).otherwise(F.col("open"))
    )
    alone = stated.filter("NOT within AND NOT goes_on AND NOT blank").select("path", "file", "first_block", "first_line", "block", "line", "text")
    # Records that run over line ends go by their first line, which may lie in an earlier block.
    parts = stated.filter("within OR goes_on")
    begins = F.when(~F.col("within"), F.struct("block", "line"))
    handed = parts.groupBy("path", "block").agg(F.max(begins).alias("begun")).select(
        F.col("path").alias("handed_path"), F.col("block").alias("handed_block"), F.last("begun", ignorenulls=True).over(earlier).alias("handed")
    )
    parts = parts.withColumn("own", F.last(begins, ignorenulls=True).over(in_block))
    parts = parts.join(handed, (F.col("path") == F.col("handed_path")) & (F.col("block") == F.col("handed_block")))
    parts = parts.withColumn("head", F.coalesce("own", "handed"))
    joined = parts.groupBy("path", "file", "first_block", "first_line", "head").agg(
        F.expr(f"listagg(text, '{LINE_END}') WITHIN GROUP (ORDER BY block, line)").alias("text")
    )
    joined = joined.select("path", "file", "first_block", "first_line", "head.block", "head.line", "text")
    return alone.unionByName(joined)


def read_export(
    spark: SparkSession,
    path: str,
    encoding: str | None = None,
    strict_na: bool = True,
    upper: bool = True,
    fallback: str = FALLBACK_ENCODING,
    folder: str | None = None,
) -> DataFrame:
    """Read a folder of CSV exports, every column as text, with its row order in ``_row_ord``.

    The files are read once, split by ``spark.sql.files.maxPartitionBytes`` also where quoted
    cells hold line breaks, and their lines are stored in ``folder`` (the shared folder);
    everything after reads those. A quote opens a cell only at its start, so ``5" door`` is
    text. A quoted cell that is never closed ends the job.

    Without ``encoding`` each file is UTF-8 if all its bytes are, and ``fallback`` if not.
    Columns bind by name: a folder may hold files with other column orders, and a column
    that a file lacks is null there. Blank lines between records are left out. A line ends
    with a line feed, with or without a carriage return.
    """
    lines = scanned(spark, path, encoding, folder)
    files = stage(_files(lines), folder)
    text = F.when(F.col("file_utf8"), F.col("value").cast("string")).otherwise(F.decode("value", fallback))
    placed = lines.join(files, F.col("path") == F.col("file_path")).withColumn("text", text)
    simple = placed.filter("NOT file_open AND NOT blank").select("path", "file", "first_block", "first_line", "block", "line", "text")
    records = simple
    told = files.agg(F.max("file_open").alias("open"), F.max("first_block").alias("block")).first()
    if told.open:
        records = simple.unionByName(stage(_records(placed.filter("file_open")), folder))
    is_header = (F.col("block") == F.col("first_block")) & (F.col("line") == F.col("first_line"))
    bare = F.when(F.col("text").endswith("\r"), F.substr("text", F.lit(1), F.length("text") - 1)).otherwise(F.col("text"))
    records = records.withColumn("text", bare)

    # Headers stand in first blocks; only those are looked through, unless one is blank.
    first_blocks = F.col("block") == 0 if told.block == 0 else F.lit(True)
    headers = stage(records.filter(is_header & first_blocks).select(F.col("file").alias("header_file"), F.col("text").alias("header")), folder)
    distinct = headers.groupBy("header").agg(F.min("header_file").alias("n")).orderBy("n")
    found = [r.header for r in distinct.head(MOST_HEADERS + 1)]
    if not found:
        raise ValueError(f"no header in {path}")
    if len(found) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers in {path}")
    names = {h: normal_header(c) if upper else [x.strip() for x in c] for h, c in ((h, header_cells(h.split("\n"))) for h in found)}
    columns = list(dict.fromkeys(n for own in names.values() for n in own))
    widest = max(map(len, names.values()))
    # Which cell of a record each column is, by header.
    cells = spark.createDataFrame(
        [(h, [own.index(c) + 1 if c in own else None for c in columns]) for h, own in names.items()],
        "of_header string, at array<int>",
    )
    bound = headers.join(cells, F.col("header") == F.col("of_header")).select("header_file", "at")
    schema = ", ".join(f"c{i} STRING" for i in range(widest))
    parsed = F.from_csv("text", schema, {"quote": QUOTE, "escape": QUOTE, "sep": DELIMITER, "multiLine": "true"})
    cells_of = records.filter(~is_header).select("file", "block", "line", parsed.alias("p"))
    listed = F.array(*[F.col(f"p.c{i}") for i in range(widest)])
    rows = cells_of.select("file", "block", "line", listed.alias("cells")).join(bound, F.col("file") == F.col("header_file"))
    ordered = rows.select(
        *[F.get("cells", F.element_at("at", i + 1) - 1).alias(n) for i, n in enumerate(columns)],
        F.struct("file", "block", "line").alias(ROW_ORDER),
    )
    ordered = ordered.drop(*[c for c in ordered.columns if c.strip().upper() == TOTALS_COLUMN])
    return na_to_null(ordered) if strict_na else ordered


_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a session whose tasks all run in the driver's own process may go without: it
    gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="leaseload-"))
    return _own_folder[0]


def stage(df: DataFrame, folder: str | None = None, **options: str) -> DataFrame:
    """Write an export once as parquet (with its writer's options) in the shared folder and read it back.

    Staging pays for the text parse once, gives every later scan column pruning,
    and pins ``_row_ord``: a recomputed text scan may split files differently.
    """
    spark = df.sparkSession
    target = f"{folder or shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(target)
    return spark.read.parquet(target)
