r"""CSV records that span lines, cut in parallel.

A record ends at a line end that is neither inside an enclosed field nor
escaped. Whether a line end is one depends on everything before it, so a
file cannot simply be split at its line ends; but a line acts on the little
that has to be known, and the actions of lines compose:

* at the start of a line the reader is at a record's start (``F``), in an
  unenclosed field whose line end was escaped (``U``), or in an enclosed
  field (``Q``); ``line_effect`` gives the state after the line for each;
* from the second line of a block on (a block is what the file source deals
  to a task) a line either keeps, toggles or sets "in an enclosed field", so
  running states are running sums and last values of one window per block, for
  each of the three states that the block might start in;
* the blocks of a file are then chained: one short row per block.

Lines of files without any such record never get here: ``open_files``
finds the others in a scan that shuffles one row per file. Only those
files' lines are shuffled, by block. Lines of a record that spans several
are gathered by record number; one above ``MAX_RECORD`` bytes (usually a
quote that is never closed) is kept as its first line and marked too long,
so no task has to hold it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spokewise.functions._util import let
from spokewise.sources.formats import CsvFormat

# fixed value: the largest row of the dialect, 16 MB
MAX_RECORD = 16 * 1024 * 1024
F_, U_, Q_, E_ = 0, 1, 2, 3   # field start, unenclosed, enclosed, just after a quote in an enclosed field


def needs_states(fmt: CsvFormat) -> bool:
    """Whether a line end can be part of a record under this format."""
    return fmt.quote is not None or fmt.escape_unenclosed is not None


def _odd_tail(text: Column, char: str) -> Column:
    """The text ends with an odd number of ``char``."""
    return (F.length(text) - F.length(F.rtrim(text, F.lit(char)))) % 2 == 1


def _after_text(state: Column, text: Column, fmt: CsvFormat) -> Column:
    """State after a stretch of text without quotes."""
    at_end = F.endswith(text, F.lit(fmt.delimiter))
    if fmt.escape_unenclosed:
        body = F.substring(text, F.lit(1), F.length(text) - F.lit(len(fmt.delimiter)))
        at_end = at_end & ~_odd_tail(body, fmt.escape_unenclosed)
    return F.when((text == "") | (state == Q_), state).when(at_end, F.lit(F_)).otherwise(F.lit(U_))


def _after_quote(state: Column) -> Column:
    return F.when(state == F_, F.lit(Q_)).when(state == Q_, F.lit(E_)).when(state == E_, F.lit(Q_)).otherwise(F.lit(U_))


def line_effect(line: Column, start: int, fmt: CsvFormat) -> Column:
    """State (``F_``, ``U_`` or ``Q_``) at the start of the next line."""
    if fmt.quote is None:
        end = F.lit(U_)
    else:
        end = let(F.split(line, "\\Q" + fmt.quote + "\\E", -1), lambda stretches: F.aggregate(
            F.slice(stretches, F.lit(2), F.size(stretches)),
            _after_text(F.lit(start), F.get(stretches, F.lit(0)), fmt),
            lambda state, text: let(_after_quote(state), lambda now: _after_text(now, text, fmt))))
    if fmt.escape_unenclosed:
        return (F.when(end == Q_, F.lit(Q_)).when(_odd_tail(line, fmt.escape_unenclosed), F.lit(U_))
                .otherwise(F.lit(F_)))
    return F.when(end == Q_, F.lit(Q_)).otherwise(F.lit(F_))


def read_lines(spark: SparkSession, paths: list[str], fmt: CsvFormat) -> DataFrame:
    """(file, block, pos, line): the lines of the files, ``pos`` rising within a block."""
    return (spark.read.option("lineSep", fmt.record_delimiter or "\n").text(paths)
           .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line")))


def open_files(lines: DataFrame, fmt: CsvFormat) -> DataFrame:
    """(file): files with a line that does not end its record, or with an escape character."""
    odd = line_effect(F.col("line"), F_, fmt) != F_
    if fmt.escape_unenclosed:
        odd = odd | F.contains("line", F.lit(fmt.escape_unenclosed))
    if fmt.quote is not None:    # lines without either character cost two searches
        some = F.contains("line", F.lit(fmt.quote))
        if fmt.escape_unenclosed:
            some = some | F.contains("line", F.lit(fmt.escape_unenclosed))
        odd = some & odd
    return lines.groupBy("file").agg(F.bool_or(odd).alias("odd")).where("odd").select("file")


@dataclass(frozen=True)
class _Names:
    """Column of a block's running value for each state that it may start in."""

    tag: str

    def __getitem__(self, state: int) -> str:
        return f"_{self.tag}{state}"


def numbered(lines: DataFrame, fmt: CsvFormat, write) -> DataFrame:
    """(file, block, pos, line, record, alone): number of the record in its file that each line belongs to.

    ``alone`` lines are known to be whole records. ``write`` cuts the plan
    (a written table), as the numbered lines are read several times.
    """
    starts = (F_, U_, Q_)
    block = Window.partitionBy("file", "block").orderBy("pos")
    sofar = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after, count, begins = _Names("after"), _Names("count"), _Names("begins")

    first = F.col("_row") == 1
    header = first & (F.col("block") == 0) if fmt.skip_header else F.lit(False)
    df = lines.withColumn("_row", F.row_number().over(block))
    for s in starts:     # a header line ends itself, whatever it holds
        effect = line_effect(F.col("line"), s, fmt)
        if s == U_ and fmt.quote is not None:     # as in F once there is text before the first quote
            bare = (F.col("line") != "") & ~F.startswith("line", F.lit(fmt.quote))
            effect = F.when(bare, F.col(f"_e{F_}")).otherwise(effect)
        df = df.withColumn(f"_e{s}", F.when(header, F.lit(F_)).otherwise(effect))
    esc = (F.when(header, F.lit(False)).otherwise(_odd_tail(F.col("line"), fmt.escape_unenclosed))
           if fmt.escape_unenclosed else F.lit(False))
    df = df.withColumn("_esc", esc).withColumn("_was_esc", F.coalesce(F.lag("_esc").over(block), F.lit(False)))

    # from the second line on: outside a field, a line starts in U after an escaped line end, else in F
    outside = F.when(F.col("_was_esc"), F.col(f"_e{U_}")).otherwise(F.col(f"_e{F_}")) == Q_
    inside = F.col(f"_e{Q_}") == Q_
    df = df.withColumn("_toggle", F.when(first, F.lit(0)).otherwise((outside & ~inside).cast("int")))
    df = df.withColumn("_odd", F.sum("_toggle").over(sofar) % 2 == 1)
    sets = F.when(~first & (outside == inside), outside != F.col("_odd"))
    df = df.withColumn("_base", F.last(sets, ignorenulls=True).over(sofar))
    for s in starts:
        here = F.first(F.col(f"_e{s}") == Q_).over(sofar)      # after the block's first line
        df = df.withColumn(after[s], F.coalesce(F.col("_base"), here) != F.col("_odd"))
    for s in starts:
        begin = F.when(first, F.lit(s == F_)).otherwise(~F.lag(after[s]).over(block) & ~F.col("_was_esc"))
        df = df.withColumn(begins[s], begin).withColumn(count[s], F.sum(F.col(begins[s]).cast("long")).over(sofar))
    for s in starts:
        df = df.withColumn(f"_next{s}", F.lead(begins[s]).over(block))
    keep = [c[s] for c in (after, count, begins) for s in starts] + [f"_next{s}" for s in starts]
    df = write(df.select("file", "block", "pos", "line", "_esc", *keep))

    # the blocks of a file, in order: state and record number that each starts with, told by its last line
    ends = df.where(F.col(f"_next{F_}").isNull()).select("file", F.struct("block", *[
        F.when(F.col(after[s]), F.lit(Q_)).when(F.col("_esc"), F.lit(U_)).otherwise(F.lit(F_)).alias(f"end{s}")
        for s in starts], *[F.col(count[s]).alias(f"n{s}") for s in starts]).alias("b"))

    def of(state: Column, b: Column, field: str) -> Column:
        return F.when(state == F_, b[f"{field}{F_}"]).when(state == U_, b[f"{field}{U_}"]).otherwise(b[f"{field}{Q_}"])

    none = F.array().cast("array<struct<block:bigint,state:int,before:bigint>>")
    chained = ends.groupBy("file").agg(F.array_sort(F.collect_list("b")).alias("blocks")).select("file", F.inline(F.aggregate(
        "blocks", F.struct(none.alias("done"), F.lit(F_).alias("state"), F.lit(0).cast("bigint").alias("before")),
        lambda a, b: F.struct(
            F.concat(a["done"], F.array(F.struct(b["block"].alias("block"), a["state"].alias("state"),
                                                 a["before"].alias("before")))).alias("done"),
            of(a["state"], b, "end").alias("state"), (a["before"] + of(a["state"], b, "n")).alias("before")),
        lambda a: a["done"])))

    def chosen(names) -> Column:
        return (F.when(F.col("state") == F_, F.col(names(F_))).when(F.col("state") == U_, F.col(names(U_)))
                .otherwise(F.col(names(Q_))))

    whole = F.coalesce(chosen(lambda s: begins[s]) & chosen(lambda s: f"_next{s}"), F.lit(False))
    out = df.join(chained, ["file", "block"]).select(
        "file", "block", "pos", "line", (F.col("before") + chosen(lambda s: count[s])).alias("record"), whole.alias("alone"))
    return out.where(F.col("record") > 1) if fmt.skip_header else out


def gathered(lines: DataFrame, fmt: CsvFormat) -> DataFrame:
    """(file, record, too_long): the records of numbered lines; blank ones are left out, as the CSV reader does."""
    sep = fmt.record_delimiter or "\n"
    alone = lines.where("alone").select("file", F.col("line").alias("record"), F.lit(False).alias("too_long"))
    parts = lines.where(~F.col("alone"))
    size = parts.groupBy("file", "record").agg(F.sum(F.octet_length("line") + F.lit(len(sep))).alias("bytes"))
    large = size.where(F.col("bytes") > MAX_RECORD).select("file", "record")
    joined = (parts.join(large, ["file", "record"], "left_anti").groupBy("file", "record")
              .agg(F.array_sort(F.collect_list(F.struct("block", "pos", "line"))).alias("l"))
              .select("file", F.array_join(F.transform("l", lambda p: p["line"]), sep).alias("record"), F.lit(False).alias("too_long")))
    long = (parts.join(large, ["file", "record"], "left_semi").groupBy("file", "record")
            .agg(F.min_by("line", F.struct("block", "pos")).alias("line"))
            .select("file", F.substring("line", 1, 1000).alias("record"), F.lit(True).alias("too_long")))
    out = alone.unionByName(joined).unionByName(long)
    if fmt.record_delimiter is None:
        out = out.withColumn("record", F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)"))
                             .otherwise(F.col("record")))
    return out.where(F.col("too_long") | (F.trim("record") != ""))


def fields_of(record: Column, fmt: CsvFormat) -> Column:
    """The fields of a record as an array of text; an empty field is null, as for the CSV reader."""
    return let(F.split(record, "\\Q" + fmt.delimiter + "\\E", -1), lambda pieces: _fields(pieces, fmt))


def _fields(pieces: Column, fmt: CsvFormat) -> Column:
    """Fields from the pieces between delimiters; some delimiters stand inside a field."""
    quote, escape = fmt.quote, fmt.escape_unenclosed

    def seen(piece: Column, i: Column) -> Column:
        opens = F.startswith(F.trim(piece) if fmt.trim_space else piece, F.lit(quote)) if quote else F.lit(False)
        quotes = (F.length(piece) - F.length(F.replace(piece, F.lit(quote), F.lit("")))) if quote else F.lit(0)
        return F.struct(i.alias("i"), opens.alias("opens"), (quotes % 2 == 1).alias("odd"),
                        (_odd_tail(piece, escape) if escape else F.lit(False)).alias("esc"))

    def step(a: Column, p: Column) -> Column:
        """A field goes on while its quotes are odd in number, or while an unenclosed one ends escaped."""
        fresh = ~a["within"]
        enclosed = F.when(fresh, p["opens"]).otherwise(a["enclosed"])
        odd = F.when(fresh, p["odd"]).otherwise(a["odd"] != p["odd"])
        goes_on = F.when(enclosed, odd).otherwise(p["esc"])
        return F.struct(F.when(goes_on, a["ends"]).otherwise(F.concat(a["ends"], F.array(p["i"]))).alias("ends"),
                        goes_on.alias("within"), enclosed.alias("enclosed"), odd.alias("odd"))

    zero = F.struct(F.array().cast("array<int>").alias("ends"), F.lit(False).alias("within"),
                    F.lit(False).alias("enclosed"), F.lit(False).alias("odd"))
    last = F.size(pieces) - 1
    found = F.aggregate(F.transform(pieces, seen), zero, step,
                       lambda a: F.when(a["within"], F.concat(a["ends"], F.array(last))).otherwise(a["ends"]))

    def field(ends: Column, end: Column, k: Column) -> Column:
        begin = F.when(k == 0, F.lit(0)).otherwise(F.get(ends, k - 1) + 1)
        text = F.array_join(F.slice(pieces, begin + 1, end - begin + 1), fmt.delimiter)
        return let(F.trim(text) if fmt.trim_space else text, value)

    def value(plain: Column) -> Column:
        open_text = plain
        if escape:
            special = "".join("\\" + c if not c.isalnum() and not c.isspace() else c
                              for c in dict.fromkeys(fmt.delimiter + "\n" + escape + (quote or "")))
            open_text = F.when(F.contains(plain, F.lit(escape)), F.regexp_replace(
                plain, "\\Q" + escape + "\\E([" + special + "])", "$1")).otherwise(plain)
        if not quote:
            return F.nullif(open_text, F.lit(""))
        enclosed = F.startswith(plain, F.lit(quote)) & F.endswith(plain, F.lit(quote)) & (F.length(plain) >= 2)
        inner = F.replace(F.substring(plain, F.lit(2), F.length(plain) - 2), F.lit(quote * 2), F.lit(quote))
        return F.nullif(F.when(enclosed, inner).otherwise(open_text), F.lit(""))

    whole = let(found, lambda ends: F.transform(ends, lambda end, k: field(ends, end, k)))
    # most records have no delimiter inside a field: no piece goes on, so each is a field
    goes_on = F.exists(pieces, lambda piece: let(seen(piece, F.lit(0)), lambda p: F.when(p["opens"], p["odd"]).otherwise(p["esc"])))
    return F.when(goes_on, whole).otherwise(F.transform(
        pieces, lambda piece: let(F.trim(piece) if fmt.trim_space else piece, value)))
