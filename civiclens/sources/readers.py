"""Scans of CSV, text, JSON and Parquet. Columns the caller does not select are not read."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclens import contracts
from civiclens.sources.ranges import document_features, lines_after_first, quoted_lines


MOST_HEADERS = 100


def read_csv(
    spark: SparkSession, path: str | Sequence[str], sep: str = ",", *, multi_line: bool = False
) -> DataFrame:
    """CSV with a header; every column is text, and empty text is NULL.

    Quotes hold separators, doubled quotes stand for one, and a backslash is a character like
    others (RFC 4180). Line breaks within quotes need ``multi_line``, by which a file is one task, or
    :func:`read_csv_by_ranges`.
    """
    return spark.read.csv(path, header=True, sep=sep, quote='"', escape='"', multiLine=multi_line)


def read_csv_by_ranges(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> DataFrame:
    """The same with line breaks within quotes, and many tasks per file.

    Files may order their columns differently: each is read by its own header, and matched by name. Blank lines are
    left out. Reads the files three times, and shuffles only records that cross a range.
    """
    found, headers = quoted_lines(spark, path, header=True)
    found = found.filter(F.trim("record") != "")
    kinds = [row[0] for row in headers.select("record").distinct().limit(MOST_HEADERS + 1).collect()]
    if len(kinds) > MOST_HEADERS:
        raise ValueError(f"the files have over {MOST_HEADERS} different headers")
    options = {"sep": sep, "quote": '"', "escape": '"'}
    frames = []
    for header in sorted(kinds):
        rows = found
        if len(kinds) > 1:
            rows = found.join(headers.filter(F.col("record") == header).select("file"), "file", "left_semi")
        schema = ", ".join(f"`{name.replace('`', '``')}` STRING" for name in _names(spark, header, options))
        frames.append(rows.select(F.inline(F.array(F.from_csv("record", schema, options)))))
    if not frames:
        raise ValueError("no file has a header")
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    return whole


def _names(spark: SparkSession, header: str, options: Mapping[str, str]) -> list[str]:
    """Names of a header; an empty one is named by its place, and so is a repeated one."""
    parts = header.count(options["sep"]) + 1
    schema = ", ".join(f"c{i} STRING" for i in range(parts))
    row = spark.range(1).select(F.from_csv(F.lit(header), schema, dict(options)).alias("row")).first()["row"]
    names = list(row)
    while len(names) > 1 and names[-1] is None and not header.endswith(options["sep"]):
        names.pop()  # separators within quotes were counted too
    lower = [(name or "").lower() for name in names]
    return [
        f"_c{i}" if not name else f"{name}{i}" if lower.count(name.lower()) > 1 else name
        for i, name in enumerate(names)
    ]


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_union(frames: Sequence[DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """All rows of the frames, matched by column name, with just ``columns`` if given."""
    picked = [frame.select(*[F.col(f"`{c}`") for c in columns or frame.columns]) for frame in frames]
    whole = picked[0]
    for frame in picked[1:]:
        whole = whole.unionByName(frame)
    return whole


def read_features(
    spark: SparkSession, path: str, properties: T.StructType = contracts.BLOCK_PROPERTIES
) -> DataFrame:
    """Properties of the features of GeoJSON files, one FeatureCollection each.

    The schema is given, so nothing is inferred and the geometry is not kept. A
    file is one task: bring large data as many files, or convert it once.
    """
    schema = contracts.feature_schema(properties)
    return explode_features(spark.read.schema(schema).option("multiLine", True).json(path))


def read_features_whole_text(
    spark: SparkSession, path: str, properties: T.StructType = contracts.BLOCK_PROPERTIES
) -> DataFrame:
    """The same from files read as one text each."""
    schema = contracts.feature_schema(properties)
    texts = spark.read.text(path, wholetext=True)
    return explode_features(texts.select(F.inline(F.array(F.from_json("value", schema)))))


def read_features_by_ranges(
    spark: SparkSession, path: str, properties: T.StructType = contracts.BLOCK_PROPERTIES
) -> DataFrame:
    """The same, with many tasks per file: one document may be as large as it likes.

    Reads the files three times, and shuffles only features that cross a range.
    """
    schema = T.StructType([T.StructField("properties", properties)])
    texts = document_features(spark, path)
    return texts.select(F.from_json("record", schema).alias("feature")).select("feature.properties.*")


def explode_features(collections: DataFrame) -> DataFrame:
    """One row per element of the ``features`` array, with its properties as columns."""
    return collections.select(F.explode("features").alias("feature")).select("feature.properties.*")


def read_lines(
    spark: SparkSession, path: str | Sequence[str], header: str | None = None, *, skip_first: bool = False
) -> DataFrame:
    """Lines of text as column ``line``, without any line equal to ``header``; with ``skip_first`` without the
    first line of each file instead, and with all others."""
    if skip_first:
        return lines_after_first(spark, path)
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    return lines if header is None else lines.filter(F.col("line") != header)


def parse_csv_lines(lines: DataFrame, schema: str) -> DataFrame:
    """Columns of CSV lines; quotes hold commas, and doubled quotes stand for one."""
    parsed = F.from_csv("line", schema, {"quote": '"', "escape": '"'})
    return lines.select(F.inline(F.array(parsed)))


def parse_split_lines(
    lines: DataFrame, positions: Mapping[str, int], *, sep: str, min_parts: int
) -> DataFrame:
    """Parts of lines at the given positions; lines with fewer than ``min_parts`` are dropped."""
    parts = F.split("line", f"\\Q{sep}\\E", -1)
    return (
        lines.select(parts.alias("parts"))
        .filter(F.size("parts") >= min_parts)
        .select(*[F.get("parts", F.lit(at)).alias(name) for name, at in positions.items()])
    )


def source_name(pattern: str = r"([^/]+?)(?:\.log)?$") -> Column:
    """Name of the file a row was read from, or what ``pattern`` captures of its path."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
