"""Review records as JSON lines: strict, lenient and typed reading, and writing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.functions.casts import cast_to
from revlens.schema import REVIEW_DEFAULTS, REVIEW_FIELDS, REVIEW_SCHEMA
from revlens.session import materialise
from revlens.sources.whole import put_whole

# Columns that tell the place of a line in the input, see read_lines.
PLACE = ["block", "row"]
# Characters of a line that an error shows.
SHOWN = 200

_CORRUPT = "_corrupt_record"


def read_strict(
    spark: SparkSession, path: str | list[str], schema: T.StructType = REVIEW_SCHEMA
) -> DataFrame:
    """Typed records; any line that is not whole a record of ``schema`` fails the job.

    Every field is checked whatever is selected afterwards, and the text behind the record. The
    error names the line's file, block and row.
    """
    return parse_strict(read_lines(spark, path), schema).select(*schema.names)


def read_pruned(
    spark: SparkSession, path: str | list[str], schema: T.StructType = REVIEW_SCHEMA
) -> DataFrame:
    """As ``read_strict``, but only the selected columns are parsed and checked, which is faster."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw lines with their place in the input.

    ``(file, block, row)`` is unique and sorts lines in file order.
    """
    return _placed(spark.read.text(path))


def head_lines(spark: SparkSession, path: str | list[str], n: int) -> DataFrame:
    """The first ``n`` lines of files in the order of their paths, in order (starts jobs).

    Lines are counted per block of a file, in parallel, for the first file, then for the first
    ones by fours until there are enough; files behind them are not opened. Then the blocks in
    front of the cut are read, and only the lines of the block with the cut are numbered.
    """
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    text = spark.read.text(path)
    # The contents of these files aren't read: paths only are selected.
    files = spark.read.format("binaryFile").load(path).select(file.alias("file"))
    counted, seen, number, cut = None, "", 1, None
    while n > 0 and cut is None:
        names = [r.file for r in files.filter(F.col("file") > seen).orderBy("file").limit(number).collect()]
        if not names:
            break
        blocks = text.filter((file > seen) & (file <= names[-1])).groupBy(file.alias("file"), block.alias("block")).agg(F.count(F.lit(1)).alias("n"))
        blocks = materialise(blocks)
        counted = blocks if counted is None else counted.union(blocks)
        so_far = F.sum("n").over(Window.orderBy("file", "block"))
        cut = counted.withColumn("up_to", so_far).filter(F.col("up_to") >= n).orderBy("file", "block").first()
        seen, number = names[-1], 4 * number
    if cut is None:
        lines = _placed(text).filter(F.lit(n > 0))
    else:
        placed = _placed(text.filter(file <= cut.file))
        in_file = F.col("file") == cut.file
        before = placed.filter(~in_file | (F.col("block") < cut.block))
        last = placed.filter(in_file & (F.col("block") == cut.block))
        order = F.row_number().over(Window.partitionBy("file", "block").orderBy("row"))
        last = last.withColumn("_number", order).filter(F.col("_number") <= cut.n - (cut.up_to - n)).drop("_number")
        lines = before.union(last)
    return lines.orderBy("file", *PLACE).select("value")


def _placed(text: DataFrame) -> DataFrame:
    return text.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def parse_strict(lines: DataFrame, schema: T.StructType = REVIEW_SCHEMA, column: str = "value") -> DataFrame:
    """Typed records of JSON lines held in a column; a line that is no record fails the job.

    Blank lines are left out, and an array of objects gives a record for each. The whole line is
    checked, text behind the record included. Other columns of ``lines`` are kept in front; those
    of a line's place (``file``, ``block``, ``row``) are named in the error.
    """
    line = F.col(column)
    wrapped = T.StructType().add("r", T.ArrayType(schema)).add("end", T.IntegerType()).add(_CORRUPT, T.StringType())
    many = F.ltrim(line).startswith("[")
    text = F.when(many, F.concat(F.lit('{"r":'), line, F.lit(',"end":1}'))).otherwise(F.concat(F.lit('{"r":['), line, F.lit('],"end":1}')))
    kept = [c for c in lines.columns if c != column]
    parsed = F.from_json(text, wrapped, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}).alias("_parsed")
    found = not_blank(lines, column).select(*kept, line.alias("_line"), F.inline(F.array(parsed)))
    whole = F.col(_CORRUPT).isNull() & (F.col("end") == 1) & F.forall("r", lambda r: r.isNotNull()) & (F.col("_line").rlike(r"^\s*\[") | (F.size("r") == 1))
    place = [F.concat(F.lit(f" {c} "), F.col(c).cast("string")) for c in ("file", *PLACE) if c in kept]
    error = F.concat(F.lit("not a record:"), *place, F.lit(" line "), F.substring("_line", 1, SHOWN))
    records = F.when(F.coalesce(whole, F.lit(False)), F.col("r")).otherwise(F.raise_error(error))
    return found.select(*kept, F.inline(records))


def not_blank(lines: DataFrame, column: str = "value") -> DataFrame:
    """The lines that are more than white space."""
    return lines.filter(F.col(column).rlike(r"\S"))


def _wrapped(line: Column) -> Column:
    """The line in an object with a mark behind it: what does not end there is broken."""
    return F.concat(F.lit('{"r":['), line, F.lit('],"end":"."}'))


_LENIENT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "allowSingleQuotes": "false"}


def _wrapper(element: T.DataType) -> T.StructType:
    return T.StructType().add("r", T.ArrayType(element)).add("end", T.StringType()).add(_CORRUPT, T.StringType())


def is_json(line: Column) -> Column:
    """Whether the text is one whole JSON value of any kind."""
    found = F.from_json(_wrapped(line), _wrapper(T.StringType()), _LENIENT)
    return F.coalesce(found[_CORRUPT].isNull() & (found["end"] == ".") & (F.size(found["r"]) == 1), F.lit(False))


def unpacked(lines: DataFrame, fields: Iterable[str], column: str, kept: list[str]) -> tuple[DataFrame, Column]:
    """Each line with ``r``, whose first element is its raw record, and whether it is a whole object.

    The line is unpacked by a generator so that it is parsed once, whatever is done afterwards.
    """
    record = T.StructType([T.StructField(name, T.StringType()) for name in fields])
    parsed = F.from_json(_wrapped(F.col(column)), _wrapper(record), _LENIENT)
    found = lines.select(*kept, F.inline(F.array(parsed)))
    return found, F.col(_CORRUPT).isNull() & (F.col("end") == ".") & (F.size("r") == 1) & F.get("r", F.lit(0)).isNotNull()


def parse_lenient(lines: DataFrame, fields: Iterable[str], column: str = "value") -> DataFrame:
    """One row per line that is a JSON object; every field as raw text.

    Lines that are blank, broken, or not an object are dropped (``rejects.accounted`` keeps
    account of them). Other columns of ``lines`` are kept in front.
    """
    kept = [c for c in lines.columns if c != column]
    found, one = unpacked(lines, fields, column, kept)
    return found.filter(one).select(*kept, "r", F.get("r", F.lit(0)).alias("_record")).select(*kept, "_record.*")


def typed(raw: DataFrame, fields: Mapping[str, str], keep: Iterable[str] = ()) -> DataFrame:
    """Typed projection of raw text columns: ``{name: int|float|str|bool|date}``.

    The columns named in ``keep`` come first, unchanged.
    """
    casts = (cast_to(F.col(name), kind).alias(name) for name, kind in fields.items())
    return raw.select(*keep, *casts)


def read_lenient(
    spark: SparkSession, path: str | list[str], fields: Mapping[str, str] = REVIEW_FIELDS
) -> DataFrame:
    """Lenient reading followed by the typed projection."""
    return typed(parse_lenient(spark.read.text(path), fields), fields)


def with_defaults(
    records: DataFrame,
    defaults: Mapping[str, object] = REVIEW_DEFAULTS,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Fixed projection with a default for each missing field, and the image count.

    The columns named in ``keep`` come first, unchanged.
    """

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(defaults[name])).alias(name)

    images = [image_count(F.col("images")).alias("image_count")] if "images" in records.columns else []
    return records.select(*keep, *(filled(name) for name in defaults), *images)


def image_count(images: Column) -> Column:
    """Length of the image list; 0 where it is missing."""
    return F.coalesce(F.size(images), F.lit(0))


def from_rows(spark: SparkSession, rows: Iterable, schema: T.StructType = REVIEW_SCHEMA) -> DataFrame:
    """Local rows as a DataFrame of review records."""
    return spark.createDataFrame(list(rows), schema)


def write_jsonl(records: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write records as JSON lines, one file per partition (starts jobs); whole or not at all."""
    put_whole(records, path, lambda df, place: df.write.json(place), _text_lines, mode)


def write_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the ``value`` column as text lines, unchanged (starts jobs); whole or not at all."""
    put_whole(lines.select("value"), path, lambda df, place: df.write.text(place), _text_lines, mode)


def _text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)
