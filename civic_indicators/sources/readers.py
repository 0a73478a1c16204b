"""Named-table scan with a declared schema.

Sheets of the original workbooks are landed as Parquet or CSV files (one
folder per sheet); Spark reads them in parallel splits, with the schema given
rather than inferred so the scan needs no extra pass over the data.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from civic_indicators.functions.cols import col
from civic_indicators.sources.headers import unique_names, with_unique_headers


def scan(spark: SparkSession, path: str, fmt: str = "parquet",
         schema: StructType | str | None = None,
         row_order: str | None = None, malformed: str | None = None, **options) -> DataFrame:
    """Read one landed sheet. CSV defaults to a header row; repeated headers
    get ``.1`` suffixes like a sheet reader gives them.

    The files of a CSV folder are aligned by their own headers, by name: exports may order
    their columns differently, lack some (null there) or have further ones. With a declared
    ``schema`` its columns are taken by name, and headers outside it are not read.

    A CSV file is split among tasks; a sheet whose cells hold line breaks needs
    ``multiLine="true"``, which reads each file in one task.

    ``row_order`` adds a column that sorts rows as the sheet has them (what
    "first value per person" means): file path, offset of the split in the
    file, position in the split. Parts of one sheet are ordered by their names.

    ``malformed`` adds a column (reason, line) for CSV records whose number of cells is not that
    of their file's header, null for the others (see ``split_malformed``).
    """
    if fmt == "csv":
        options.setdefault("header", "true")
        options.setdefault("encoding", "UTF-8")
    if fmt != "csv" or str(options["header"]).lower() != "true":
        if malformed:
            raise ValueError("malformed records are told by a CSV header")
        reader = spark.read.format(fmt)
        df = (reader.schema(schema) if schema is not None else reader).options(**options).load(path)
        return with_unique_headers(_ordered(df, df.columns, row_order))
    declared = None if schema is None else spark.createDataFrame([], schema).schema
    parts = [_sheet(spark, names, files, options, declared, row_order, malformed) for names, files in header_sets(spark, path, options)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    last = [c for c in (row_order, malformed) if c]
    return out.select(*[col(c) for c in out.columns if c not in last], *[col(c) for c in last]) if last else out


def _ordered(df: DataFrame, names: list[str], row_order: str | None) -> DataFrame:
    if not row_order:
        return df.toDF(*names)
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                  F.monotonically_increasing_id().alias("row"))
    return df.select("*", at.alias("__row_order")).toDF(*names, row_order)


def _sheet(spark: SparkSession, names: list[str], files: str | list[str], options: dict, declared: StructType | None,
           row_order: str | None, malformed: str | None) -> DataFrame:
    """The files of one header. Columns are read by position, then named and chosen."""
    types = {f.name: f.dataType for f in declared} if declared is not None else {}
    raw = StructType([StructField(f"_c{i}", types.get(n, StringType())) for i, n in enumerate(names)])
    options = {**options, "enforceSchema": "true"}  # positions are known: the header is not compared again
    if malformed:
        raw = raw.add("__raw", StringType())
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__raw"}
    df = _ordered(spark.read.format("csv").schema(raw).options(**options).load(files), [*names, *([malformed] if malformed else [])], row_order)
    if malformed:
        df = df.withColumn(malformed, _malformed(col(malformed), [col(n) for n in names], options))
    if declared is None:
        return df
    have = [col(f.name) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in declared]
    return df.select(*have, *[col(c) for c in (malformed, row_order) if c])


def header_sets(spark: SparkSession, path: str, options: dict) -> list[tuple[list[str], str | list[str]]]:
    """(header names, files) of a CSV folder, one entry per different header, in the order of the files.

    A single header keeps the path as it was given, so that the scan is the plain one. Only each
    file's first record is read here, through Spark's file systems; files without any are left out.
    """
    files = sorted(spark.read.options(**{**options, "header": "false", "inferSchema": "false"}).schema("_c0 STRING").csv(path).inputFiles())
    by_line: dict[str, list[str]] = {}
    for f, line in zip(files, _first_records(spark, files, options)):
        if line is not None:
            by_line.setdefault(line, []).append(f)
    sets: dict[tuple, list[str]] = {}
    for same in by_line.values():
        sets.setdefault(tuple(sheet_headers(spark, same[0], options)), []).extend(same)
    if len(sets) <= 1:
        return [(list(names), path) for names in sets] or [(sheet_headers(spark, path, options), path)]
    return [(list(names), same) for names, same in sorted(sets.items(), key=lambda x: x[1][0])]


def _first_records(spark: SparkSession, files: list[str], options: dict) -> list[str | None]:
    """The first record of each file, as text: lines until quotes are closed."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    quote = options.get("quote", '"') or '"'

    def first(file: str) -> str | None:
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        stream = p.getFileSystem(conf).open(p)
        codec = codecs.getCodec(p)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, options["encoding"]))
        try:
            lines = [reader.readLine()]
            while lines[-1] is not None and (not "".join(lines).strip() or sum(x.count(quote) for x in lines) % 2):
                lines.append(reader.readLine())
            text = "\n".join(x for x in lines if x is not None)
            return text if text.strip() else None
        finally:
            reader.close()

    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(first, files))


def sheet_headers(spark: SparkSession, path: str, options: dict) -> list[str]:
    """Header names as a sheet reader gives them: a blank header at position i
    is ``Unnamed: i`` and repeats get ``.1``, ``.2`` (Spark's CSV reader would
    rename repeats by position instead). Reads one parsed record, so quoted
    headers with line breaks stay whole."""
    first = spark.read.options(**{**options, "header": "false"}).csv(path).limit(1).collect()
    raw = list(first[0]) if first else []
    return unique_names([v if v not in (None, "") else f"Unnamed: {i}" for i, v in enumerate(raw)])


def _malformed(raw: Column, cells: list[Column], options: dict) -> Column:
    """(reason, line) of a record that Spark found not to have as many cells as ``cells``; null for the others.

    Spark tells such records, and keeps their lines, only where every cell is read: the condition on the
    cells always holds and keeps them in the scan. Nor may a null test of the raw line reach the scan.
    """
    quote, sep = (re.escape(options.get(k, d) or d) for k, d in (("quote", '"'), ("sep", ",")))
    found = F.size(F.split(F.regexp_replace(raw, f"{quote}(?:[^{quote}]|{quote}{quote})*{quote}", "q"), sep))
    reason = F.when(found > len(cells), F.lit("too_many_cells")).when(found < len(cells), F.lit("too_few_cells")).otherwise(F.lit("not_readable"))
    read = F.coalesce(*[c.cast("string") for c in cells], F.lit("")) >= ""
    return F.when((F.coalesce(F.length(raw), F.lit(-1)) >= 0) & read, F.struct(reason.alias("reason"), raw.alias("line")))


def split_malformed(df: DataFrame, malformed: str) -> tuple[DataFrame, DataFrame]:
    """S1 + P13: (well-formed rows, malformed records as ``reason`` and ``line``), complementary."""
    bad = col(malformed)
    return df.where(bad.isNull()).drop(malformed), df.where(bad.isNotNull()).select(bad["reason"].alias("reason"), bad["line"].alias("line"))


def table(spark: SparkSession, root: str, name: str,
          schema: StructType | str | None = None) -> DataFrame:
    """A table ``<root>/<name>.parquet``; a declared schema skips footer-based inference."""
    path = f"{root.rstrip('/')}/{name}.parquet"
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return df
