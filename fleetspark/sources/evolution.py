"""Schema evolution on read.

Landing JSON is read as text; the declared fields are typed columns, fields
the schema does not know are not lost but kept, as raw JSON text, in
``_rescued_data``, and a record that is no JSON object is kept whole in
``_corrupt_record`` -- both can be parsed again once the schema grows.

Landing CSV is read by the header of each file: a column is found by its name,
wherever it stands; one the schema does not know goes to ``_rescued_data``, one
the file lacks is NULL, and a line with more or fewer cells than its header, or
with a cell that doesn't fit its column's type, is kept whole in
``_corrupt_record``, too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

RESCUE_COL = "_rescued_data"
CORRUPT_COL = "_corrupt_record"


def _typed(field: StructField, options: dict[str, str]) -> Column:
    raw = F.try_element_at(F.col("_all"), F.lit(field.name))
    if isinstance(field.dataType, StringType):
        typed = raw
    elif isinstance(field.dataType, (StructType, ArrayType, MapType)):
        typed = F.from_json(raw, field.dataType, options)
    else:
        typed = raw.try_cast(field.dataType)
    return typed.alias(field.name)


def parse_with_rescue(
    text: DataFrame, schema: StructType, value_col: str = "value", options: dict[str, str] | None = None, corrupt: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The fields of ``schema``, the ``keep`` columns of ``text`` and ``_rescued_data`` (and ``_corrupt_record``).

    Every record is parsed once, into its top-level fields; scalars are cast from their text (NULL where they
    don't fit their type). A blank line is a row of NULLs; filter those before."""
    names = F.array(*[F.lit(f.name) for f in schema.fields])
    held = text.select(*keep, F.col(value_col).alias("_text"), F.from_json(F.col(value_col), "map<string,string>").alias("_all"))
    out = [_typed(f, options or {}) for f in schema.fields]
    out += list(keep)
    out.append(F.map_filter("_all", lambda k, v: ~F.array_contains(names, k)).alias(RESCUE_COL))
    if corrupt:
        out.append(F.when(F.col("_all").isNull(), F.col("_text")).alias(CORRUPT_COL))
    return held.select(*out)


LINE, FILE, AT = "value", "_file", "_at"
#: Files of one read whose headers are sent to every task; more are joined.
MOST_HEADERS = 10_000


def _with_cells(lines: DataFrame, line: str, width: int, out: str) -> DataFrame:
    """Adds the cells of a CSV line as an array of strings, empty or NULL where there is nothing: between quotes as a CSV
    parser reads them (the first ``width``, each line parsed once), without quotes what stands between commas."""
    names = [f"c{i}" for i in range(width)]
    quoted = F.when(F.contains(F.col(line), F.lit('"')), F.col(line))
    parsed = lines.withColumn("_parsed", F.from_csv(quoted, ", ".join(f"{n} string" for n in names), {"mode": "PERMISSIVE"}))
    cells = F.array(*[F.col("_parsed").getField(n) for n in names])
    return parsed.withColumn(out, F.when(F.col("_parsed").isNull(), F.split(line, ",")).otherwise(cells)).drop("_parsed")


def _cell_count(line: Column) -> Column:
    """Cells of a CSV line: commas outside quotes, and one."""
    bare = F.regexp_replace(line, r'"(?:[^"\\\\]|\\\\.|"")*"', "")
    commas = lambda text: F.length(text) - F.length(F.replace(text, F.lit(","))) + 1
    return F.when(F.contains(line, F.lit('"')), commas(bare)).otherwise(commas(line))


def _few(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A small result, computed once and sent to every task; one of over ``MOST_HEADERS`` rows stays a plan."""
    found = df.limit(MOST_HEADERS + 1).collect()
    return F.broadcast(spark.createDataFrame(found, df.schema)) if len(found) <= MOST_HEADERS else df


def csv_lines(text: DataFrame) -> DataFrame:
    """Lines of a text read with their file and place; the first line of a file has the smallest place of its file."""
    return text.select(
        LINE, F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("_block"), "_metadata"
    )


def parse_csv_by_header(lines: DataFrame, schema: StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """The fields of ``schema``, the ``keep`` columns, ``_rescued_data`` (JSON text of the cells under other names, NULL if there are none)
    and ``_corrupt_record``, for every line of ``csv_lines`` but headers and blank lines.

    A header is the line with the smallest place in the first block of its file: one number a file is aggregated, then the lines
    in those places are picked. What a header says about its columns is worked out once a file, not once a line. A name that a header
    repeats counts where it stands first. Quoted cells may hold commas, but no line breaks."""
    spark = lines.sparkSession
    placed = lines.withColumn(AT, F.monotonically_increasing_id())
    starts = _few(spark, placed.where("_block = 0").groupBy(FILE).agg(F.min(AT).alias("_header_at")))
    first = placed.join(starts, FILE).where(F.col(AT) == F.col("_header_at"))
    first = _few(spark, first.select(FILE, "_header_at", F.col(LINE).alias("_header"), _cell_count(F.col(LINE)).alias("_width")))
    width = first.agg(F.max("_width")).first()[0] or 1
    first = _with_cells(first, "_header", width, "_cell")
    named = F.transform(F.slice("_cell", 1, width), lambda x: F.trim(F.regexp_replace(F.nullif(x, F.lit("")), "^\uFEFF", "")))
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    other = F.filter(
        F.transform("_names", lambda n, i: F.struct(n.alias("n"), i.alias("i"))),
        lambda x: x["n"].isNotNull() & (x["i"] < F.col("_width")) & ~F.array_contains(known, x["n"]) & (F.array_position("_names", x["n"]) == x["i"] + 1),
    )
    at = [F.array_position("_names", f.name).cast("int").alias(f"_at{k}") for k, f in enumerate(schema.fields)]
    heads = first.select(FILE, "_header_at", "_width", named.alias("_names")).select(FILE, "_header_at", "_width", other.alias("_other"), *at)
    rows = placed.join(_few(spark, heads), FILE)
    rows = rows.where((F.col(AT) != F.col("_header_at")) & (F.trim(LINE) != ""))
    rows = _with_cells(rows, LINE, width, "_cell")

    def value(i: Column) -> Column:
        return F.nullif(F.get("_cell", i), F.lit(""))

    cells = [F.when(F.col(f"_at{k}") > 0, value(F.col(f"_at{k}") - 1)).alias(f"_c{k}") for k in range(len(schema.fields))]
    unknown = F.map_from_entries(F.transform("_other", lambda x: F.struct(x["n"], value(x["i"]))))
    rescued = F.when(F.size("_other") > 0, F.to_json(unknown, {"ignoreNullFields": "false"}))
    rows = rows.select(*keep, LINE, "_width", *cells, rescued.alias(RESCUE_COL))
    typed = [F.col(f"_c{k}").try_cast(f.dataType) for k, f in enumerate(schema.fields)]
    odd = F.lit(False)  # a cell that doesn't fit its column's type
    for k, f in enumerate(schema.fields):
        if not isinstance(f.dataType, StringType):
            odd = odd | (F.col(f"_c{k}").isNotNull() & typed[k].isNull())
    out = [c.alias(f.name) for c, f in zip(typed, schema.fields, strict=True)]
    out += [F.col(c) for c in keep]
    out.append(F.col(RESCUE_COL))
    out.append(F.when((_cell_count(F.col(LINE)) != F.col("_width")) | odd, F.col(LINE)).alias(CORRUPT_COL))
    return rows.select(*out)


def read_csv_evolving(spark, path: str, schema: StructType) -> DataFrame:
    return parse_csv_by_header(csv_lines(spark.read.text(path).select(LINE, "_metadata")), schema)


def read_json_evolving(spark, path: str, schema: StructType, options: dict[str, str] | None = None) -> DataFrame:
    return parse_with_rescue(spark.read.text(path), schema, options=options)
