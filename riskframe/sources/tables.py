"""Sources and sinks: CSV, parquet, fitted tables, reports and run records."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.columns import finite_or_null, nan_to_null
from riskframe.sources import versions

_FLOATING = (T.DoubleType, T.FloatType)


def normalise_names(df: DataFrame) -> DataFrame:
    """``id-01`` and ``id_01`` are the same column in different files."""
    return df.toDF(*[c.replace("-", "_") for c in df.columns])


def nulls_for_nan(df: DataFrame) -> DataFrame:
    return df.select(*[
        nan_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, _FLOATING) else F.col(f.name)
        for f in df.schema.fields
    ])


#: Quotes inside a quoted cell are doubled.
_CSV = {"header": True, "escape": '"'}


def _first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file, packed or not, without reading more of it."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    file = jvm.org.apache.hadoop.fs.Path(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(file)
    stream = file.getFileSystem(conf).open(file)
    try:
        packed = stream if codec is None else codec.createInputStream(stream)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(packed, "UTF-8")).readLine()
    finally:
        stream.close()


def _layouts(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Header line -> the files that begin with it. Files are listed by the scan that reads them; empty ones have no header."""
    files = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda f: _first_line(spark, f), files))
    found: dict[str, list[str]] = {}
    for file, header in zip(files, headers):
        if header:
            found.setdefault(header, []).append(file)
    return found


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None, bad_cells: str | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """A CSV table with headers. ``columns`` prunes the scan to those fields.

    Each file's own header says what its fields are, in whatever order; ``id-01`` and ``id_01`` are one name. A field that
    some files lack is null there, one that all lack is absent. Cells are read as text and cast; what does not fit its type
    becomes null, and ``bad_cells`` names a column for the array of such fields, so that rows can go to a reject table.

    A line with too many or too few cells, or with a quote that is not closed on it, is malformed. ``malformed`` names a
    column that holds such a line as it is, its cells being null, and null for a good one: rows with and without it are all
    lines but blank ones and headers (a line that repeats its file's header is one). Without it a scan of all fields fails on
    a line with too many or too few cells; a pruned scan does not look at the cells beyond its fields.
    """
    known = {f.name: f.dataType for f in schema.fields}
    parts = []
    for header, files in sorted(_layouts(spark, path).items()):
        names = spark.createDataFrame([(header,)], "value string").select(F.from_csv("value", _texts(header), _CSV).alias("r"))
        fields = [name.replace("-", "_") for name in names.select("r.*").first()]
        wanted = [n for n in fields if columns is None or n in columns]
        raw = _lines(spark, files, header, fields) if malformed else _rows(spark, files, fields, columns is None)
        cells = [F.col(n).try_cast(known.get(n, T.StringType())).alias(n) for n in wanted]
        bad = F.array_compact(F.array(*[
            F.when(F.col(n).isNotNull() & F.col(n).try_cast(known[n]).isNull(), n) for n in wanted if n in known]))
        beside = [bad.cast("array<string>").alias(bad_cells)] if bad_cells else []
        parts.append(raw.select(*cells, *beside, *([F.col(_LINE).alias(malformed)] if malformed else [])))
    if not parts:
        raise ValueError(f"no CSV file with a header in {path}")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    order = [*columns, *[c for c in (bad_cells, malformed) if c]] if columns else out.columns
    return nulls_for_nan(out.select(*order))


_LINE = "_malformed_line"


def _text_fields(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in fields])


def _rows(spark: SparkSession, files: list[str], fields: list[str], whole: bool) -> DataFrame:
    """The cells of all lines; if all fields are read, a line with another number of them is an error."""
    reader = spark.read.options(**_CSV, enforceSchema=True)
    if not whole:
        return reader.schema(_text_fields(fields)).csv(files)
    raw = reader.options(columnNameOfCorruptRecord=_LINE, columnPruning=False).schema(_text_fields([*fields, _LINE])).csv(files)
    failed = F.raise_error(F.concat(F.lit("malformed line: "), F.col(_LINE))).cast("string")
    first = F.when(F.col(_LINE).isNotNull(), failed).otherwise(F.col(fields[0]))
    return raw.select(first.alias(fields[0]), *fields[1:])


def _lines(spark: SparkSession, files: list[str], header: str, fields: list[str]) -> DataFrame:
    """The cells of well-formed lines, and the other lines as they are."""
    lines = spark.read.text(files).where((F.col("value") != header) & (F.trim("value") != ""))
    struct = ", ".join(f"`{n.replace('`', '``')}` string" for n in [*fields, _LINE])
    cells = F.from_csv("value", struct, {**_CSV, "columnNameOfCorruptRecord": _LINE})
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    read = lines.select("value", (quotes % 2 == 1).alias("open"), cells.alias("r"))
    broken = F.col("open") | F.col("r")[_LINE].isNotNull()
    return read.select(*[F.when(~broken, F.col("r")[n]).alias(n) for n in fields], F.when(broken, F.col("value")).alias(_LINE))


def _texts(header: str) -> str:
    """A schema with room for every field of a header line."""
    return ", ".join(f"c{i} string" for i in range(header.count(",") + 1))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV).csv(path)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A table written by ``write_parquet``, in its current version, or any parquet files."""
    df = spark.read.parquet(versions.resolve(spark, path))
    return nulls_for_nan(normalise_names(df.select(*columns) if columns else df))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the table at ``path``, which ``df`` may read; a job that fails leaves the old one, see ``versions``."""
    versions.replace_table(df, path, partition_by)


def write_report(df: DataFrame, path: str) -> None:
    """A one-row report as one JSON file; nulls are written, not dropped."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def strict_json(df: DataFrame, columns: list[str], alias: str = "input") -> F.Column:
    """The named columns as JSON text in which no NaN or Infinity can stand for a number, however deep it is nested."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.to_json(F.struct(*[_finite(F.col(c), types[c]).alias(c) for c in columns]), {"ignoreNullFields": "false"}).alias(alias)


def _finite(value: F.Column, kind: T.DataType) -> F.Column:
    """The value with null for every NaN and infinity inside; parts without floating numbers are left as they are."""
    if isinstance(kind, _FLOATING):
        return finite_or_null(value)
    if not _has_floats(kind):
        return value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: _finite(v, kind.elementType))
    if isinstance(kind, T.MapType):  # a key is always a JSON string
        return F.transform_values(value, lambda _, v: _finite(v, kind.valueType))
    parts = [_finite(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
    return F.when(value.isNotNull(), F.struct(*parts))


def _has_floats(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_floats(f.dataType) for f in kind.fields)
    inner = kind.elementType if isinstance(kind, T.ArrayType) else kind.valueType if isinstance(kind, T.MapType) else None
    return isinstance(kind, _FLOATING) if inner is None else _has_floats(inner)


def append_run(record: DataFrame, ledger_path: str) -> None:
    """Add run records to the ledger; earlier records are never rewritten."""
    record.write.mode("append").parquet(ledger_path)


def latest_run(ledger: DataFrame, time_column: str = "ts") -> DataFrame:
    whole = F.struct(*ledger.columns)
    return ledger.agg(F.max_by(whole, F.col(time_column)).alias("r")).select("r.*")
