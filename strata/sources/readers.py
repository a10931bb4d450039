"""Raw-source readers (SRC1-SRC5, SRC9-SRC11).

Bronze keeps raw text: every column is read as ``StringType`` with an
explicit schema (no inference pass over the data). Typed reads take an
explicit ``StructType``; ``inferSchema`` is an opt-in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# All text tokens that pandas' CSV reader turns into missing values.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
               "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# The order of rows in the source files, as persisted in bronze (see with_file_order).
FILE_ORDER = ("_arquivo", "_bloco", "_linha")
# The same order with a block's number in place of its file's path and its start (see with_block_order).
BLOCK_ORDER = ("_ordem_bloco", "_linha")


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def apply_null_tokens(df: DataFrame, columns: Sequence[str] | None = None,
                      tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Map the pandas null tokens to NULL on string columns."""
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    toks = list(tokens)
    return df.withColumns({c: F.when(F.col(c).isin(toks), F.lit(None).cast("string")).otherwise(F.col(c))
                           for c in cols})


def csv_options(reader, multi_line: bool = False):
    """The dialect of a batch or stream reader: header, surrounding spaces kept (they are data here:
    " PENDENTE "), a quote inside a quoted field doubled."""
    return (reader.option("header", True).option("ignoreLeadingWhiteSpace", False).option("escape", '"')
            .option("ignoreTrailingWhiteSpace", False).option("multiLine", multi_line))


def csv_header(spark: SparkSession, path: str, multi_line: bool = False) -> list[str]:
    """Column names of a CSV file, or of a folder's first one (only the first line is read)."""
    return csv_options(spark.read, multi_line).csv(path).columns


def read_csv_text(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                  null_tokens: Sequence[str] | None = NULL_TOKENS, multi_line: bool = False) -> DataFrame:
    """SRC1: CSV with header, quoted fields, every column text.

    Columns are bound by the names in the header (of the first file; a file
    with another header raises); ``columns`` selects and orders them, and a
    missing one raises. No ``inferSchema``: only the first line is read for
    names. ``multi_line`` allows line breaks in quoted fields; such files
    cannot be split, so land many of them."""
    names = csv_header(spark, path, multi_line)
    df = csv_options(spark.read, multi_line).option("enforceSchema", False).schema(text_schema(names)).csv(path)
    if columns:
        df = df.select(*columns)
    return apply_null_tokens(df, tokens=null_tokens) if null_tokens else df


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                   null_tokens: Sequence[str] | None = NULL_TOKENS, multi_line: bool = False) -> DataFrame:
    """SRC2: CSV with an explicit schema (inferred only if none, see ``infer_types``).

    Fields are read as text, bound by header name, null tokens become NULL,
    and the rest is cast (a text that does not fit the type is NULL)."""
    if schema is None:
        raw = read_csv_text(spark, path, None, null_tokens, multi_line)
        st = infer_types(raw)
    else:
        st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        raw = read_csv_text(spark, path, st.fieldNames(), null_tokens, multi_line)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in st.fields])


def infer_types(raw: DataFrame) -> T.StructType:
    """The narrowest type of bigint, double and boolean that all values of each text column fit, else
    string (also for a column without values). Missing values fit every type, so call it after the null
    tokens are gone. One pass over the rows, one row to the driver."""
    kinds = ("bigint", "double", "boolean")
    fits = [F.count(F.when(F.col(c).isNotNull() & F.col(c).try_cast(k).isNull(), 1)).alias(f"{i}_{k}")
            for i, c in enumerate(raw.columns) for k in kinds]
    some = [F.count(F.col(c)).alias(f"{i}") for i, c in enumerate(raw.columns)]
    row = raw.agg(*fits, *some).first()

    def kind(i: int) -> str:
        return next((k for k in kinds if row[str(i)] and not row[f"{i}_{k}"]), "string")

    return T._parse_datatype_string(", ".join(f"`{c}` {kind(i)}" for i, c in enumerate(raw.columns)))


def _json_reader(spark: SparkSession, schema: T.StructType, whole_file: bool):
    r = spark.read.schema(schema).option("mode", "FAILFAST")
    # A file that is one array is one "line": no valid JSON holds a NUL, so nothing ends it early. Unlike
    # multiLine this parses bytes in memory, where the text of a number is at hand and not read again.
    return r.option("lineSep", "\u0000") if whole_file else r


def _with_fields(df: DataFrame) -> DataFrame:
    """``df``; a record without a value in any column raises (its fields have other names)."""
    some = F.coalesce(*[F.col(f"`{c}`").cast("string") for c in df.columns])
    wrong = F.raise_error(F.lit(f"a JSON record has none of the fields {', '.join(df.columns)}")).cast("boolean")
    return df.where(F.when(some.isNull(), wrong).otherwise(True))


def read_json_text(spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = False) -> DataFrame:
    """SRC3: JSON records, every field text (number tokens keep their
    text, e.g. ``30.0``). JSON Lines by default; ``multi_line=True`` reads
    files that hold an array, one task per file, so land many of them.
    A record that cannot be parsed raises, and so does one without a value in any of ``columns``."""
    reader = _json_reader(spark, text_schema(columns), multi_line).option("primitivesAsString", True)
    return _with_fields(reader.json(path))


def read_json_typed(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    """SRC4: JSON records with an explicit schema; a bad record raises (see ``read_json_text``)."""
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    return _with_fields(_json_reader(spark, st, multi_line).json(path))


def read_layer(spark: SparkSession, root: str, name: str) -> DataFrame:
    """SRC5: a layer table by name template ``{root}/{name}``."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


def read_source(spark: SparkSession, path: str, fmt: str | None = None, columns: Sequence[str] | None = None,
                multi_line: bool = False) -> DataFrame:
    """SRC9: dispatch on ``fmt`` or the path extension (``.json`` -> JSON,
    ``.parquet`` -> Parquet, else CSV); text schema for CSV/JSON."""
    f = fmt or ("json" if path.rstrip("/").endswith(".json") else
                "parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    if f == "json":
        if not columns:
            raise ValueError("JSON text reads need the column list")
        return read_json_text(spark, path, columns, multi_line)
    if f == "parquet":
        return spark.read.parquet(path)
    return read_csv_text(spark, path, columns, multi_line=multi_line)


def path_missing(e: AnalysisException) -> bool:
    """Whether an error says that a path does not exist (and nothing else)."""
    return e.getCondition() == "PATH_NOT_FOUND"


def read_optional(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet") -> DataFrame | None:
    """SRC10: first existing path of ``paths`` (e.g. ``x.parquet`` then
    ``x``); ``None`` when none exists, so the caller can skip its mart.
    A path that exists and cannot be read raises."""
    for p in paths:
        try:
            df = spark.read.format(fmt).load(p)
            df.schema  # noqa: B018  (forces path resolution only)
            return df
        except AnalysisException as e:
            if not path_missing(e):
                raise
    return None


def with_file_order(df: DataFrame) -> DataFrame:
    """The place of each row in its source: file path, start of the file
    block, and a running id that grows within the block (``FILE_ORDER``).

    Take it directly at the scan and persist it (bronze): Spark schedules
    splits by size, so the running id alone is not file order."""
    return df.select("*", F.col("_metadata.file_path").alias("_arquivo"),
                     F.col("_metadata.file_block_start").alias("_bloco"),
                     F.monotonically_increasing_id().alias("_linha"))


def with_block_order(bronze: DataFrame) -> DataFrame:
    """``bronze`` with the number of each row's file block in ``FILE_ORDER`` (``_ordem_bloco``) in place of the
    file's path, which is longer than most rows: what is sorted by file order then holds a number a row.

    The blocks are a small table, one row for each split of the source files."""
    blocks = bronze.select("_arquivo", "_bloco").distinct()
    order = F.array_sort(F.collect_list(F.struct("_arquivo", "_bloco")))
    numbered = blocks.agg(order.alias("b")).select(F.posexplode("b").alias("_ordem_bloco", "b")) \
        .select("_ordem_bloco", F.col("b._arquivo").alias("_arquivo"), F.col("b._bloco").alias("_bloco"))
    return bronze.join(F.broadcast(numbered), ["_arquivo", "_bloco"]).drop("_arquivo", "_bloco")
