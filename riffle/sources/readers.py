"""Sources (S1–S10): every reader returns a lazy DataFrame.

Readers push work to Spark's own data sources (CSV, JSON, XML, binaryFile,
JDBC, Parquet), so scans are split across executors and filters/column
pruning reach the files where the format allows.
"""

from __future__ import annotations

import csv
import io
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .framing import Features, records

# Fixed value: the byte-order mark some spreadsheet exports put before the header.
BOM = "﻿"


def _strip_bom(df: DataFrame) -> DataFrame:
    first = df.columns[0] if df.columns else None
    if first and first.startswith(BOM):
        return df.withColumnRenamed(first, first[len(BOM):])
    return df


#: Quotes inside a value are doubled; rows that do not fit the header fail rather than lose fields.
CSV_OPTIONS = {"quote": '"', "escape": '"', "encoding": "UTF-8", "mode": "FAILFAST"}


def read_csv(spark: SparkSession, path: str, schema: str | None = None, header: bool = True,
             na: str = "", multi_line: bool = True) -> DataFrame:
    """CSV with header, UTF-8 (BOM stripped from the first name), empty text = NULL.

    Without a schema every column is text; use ``infer_types`` (one pass)
    rather than Spark's sampling ``inferSchema``.  ``multi_line`` reads line
    breaks inside quoted values; a large file is then cut into records by many
    tasks (:mod:`.framing`), unless a schema is given or there is no header.
    """
    if multi_line and header and schema is None:
        return _stacked_csv(spark, path, None, None, {"nullValue": na, "emptyValue": na}, None)
    r = (spark.read.options(**CSV_OPTIONS).option("header", header).option("nullValue", na)
         .option("emptyValue", na).option("multiLine", multi_line))
    if schema:
        r = r.schema(schema)
    return _strip_bom(r.csv(path))


def read_many(spark: SparkSession, path: str, fmt: str = "csv", exclude: str | None = None,
              source_col: str = "source", options: dict | None = None,
              exclude_path: str | None = None) -> DataFrame:
    """Many files of one kind stacked, tagged with their base file name.

    ``exclude`` is a regex on the file name, ``exclude_path`` one on the full
    path (e.g. a partition folder); both filter on the hidden ``_metadata``
    columns, so rows of excluded files are never kept.  CSV files are stacked
    by column name: each distinct header is read by itself, and a column that
    a file lacks is NULL for its rows.
    """
    if fmt == "csv":
        return _stacked_csv(spark, path, exclude, source_col, options or {}, exclude_path)
    r = spark.read.format(fmt).options(**(options or {}))
    if fmt == "parquet":
        r = r.option("mergeSchema", True)
    df = r.load(path)
    for col, pat in (("_metadata.file_name", exclude), ("_metadata.file_path", exclude_path)):
        if pat:
            df = df.filter(~F.coalesce(F.col(col).rlike(pat), F.lit(False)))
    df = df.withColumn(source_col, F.col("_metadata.file_name"))
    return _strip_bom(df)


def _header_names(header: str) -> list[str]:
    """Column names of a header record; a repeated name gets its position, as an empty one does."""
    names = next(csv.reader(io.StringIO(header, newline="")), [])
    seen: dict[str, int] = {}
    for n in names:
        seen[n.lower()] = seen.get(n.lower(), 0) + 1
    return [n if n and seen[n.lower()] == 1 else f"{n or '_c'}{i}" for i, n in enumerate(names)]


def _stacked_csv(spark: SparkSession, path: str, exclude: str | None, source_col: str | None, options: dict,
                 exclude_path: str | None) -> DataFrame:
    """All CSV files under ``path`` by column name, in three jobs whatever their number.

    Records are cut in parallel; the first one of each file (a short row a
    file) is its header.  All files are then parsed in one scan: by position,
    once for each width in use, and each column is picked by its file's header.
    """
    kept = lambda c, pat: ~F.coalesce(c.rlike(pat), F.lit(False)) if pat else F.lit(True)
    name = F.element_at(F.split("path", "/"), -1)
    rec = (records(spark, path).withColumn("record", F.regexp_replace("record", "\r$", ""))
           .where(kept(name, exclude) & kept(F.col("path"), exclude_path)))
    heads = {r.path: r.record.removeprefix(BOM) for r in rec.where("first").select("path", "record").collect()}
    if not heads:
        raise FileNotFoundError(f"no file under {path}")
    kinds = sorted(set(heads.values()))
    names = [_header_names(h) for h in kinds]
    from ..operators.joins import lookup
    which = lookup(spark, [(p, kinds.index(h)) for p, h in heads.items()], "__path string, __kind int")
    rows = rec.where("NOT first AND record <> ''").join(F.broadcast(which), F.col("path") == F.col("__path"))  # a row a file
    given = {"quote": '"', "escape": '"', "nullValue": "", "emptyValue": ""} | {k: str(v) for k, v in options.items()}
    for w in sorted({len(n) for n in names}):
        schema = ", ".join([*[f"c{i} string" for i in range(w)], "__bad string"])
        parse = F.from_csv("record", schema, given | {"columnNameOfCorruptRecord": "__bad", "mode": "PERMISSIVE"})
        of_width = F.col("__kind").isin([k for k, n in enumerate(names) if len(n) == w])
        misfit = F.raise_error(F.concat(F.lit("a row does not fit its header: "), "path"))
        rows = rows.withColumn(f"__w{w}", F.when(of_width, parse))
        rows = rows.withColumn(f"__w{w}", F.when(F.col(f"__w{w}.__bad").isNotNull(), misfit).otherwise(F.col(f"__w{w}")))

    def picked(n: str) -> Column:
        places = [(k, len(own), own.index(n)) for k, own in enumerate(names) if n in own]
        if len(kinds) == 1:
            return F.col(f"__w{places[0][1]}.c{places[0][2]}").alias(n)
        return reduce(lambda e, p: e.when(F.col("__kind") == p[0], F.col(f"__w{p[1]}.c{p[2]}")), places[1:],
                      F.when(F.col("__kind") == places[0][0], F.col(f"__w{places[0][1]}.c{places[0][2]}"))).alias(n)

    union = list(dict.fromkeys(n for own in names for n in own))
    return rows.select(*[picked(n) for n in union], *([name.alias(source_col)] if source_col else []))


def read_table(spark: SparkSession, name_or_url: str, query: str | None = None,
               properties: dict | None = None, partition: dict | None = None) -> DataFrame:
    """A table from a relational database over JDBC, or a Parquet table path.

    ``partition`` (``column, lowerBound, upperBound, numPartitions``) splits
    a JDBC read across executors.
    """
    if not name_or_url.startswith("jdbc:"):
        return spark.read.parquet(name_or_url)
    r = spark.read.format("jdbc").option("url", name_or_url).options(**(properties or {}))
    r = r.option("query", query) if query else r
    for k, v in (partition or {}).items():
        r = r.option(k, v)
    return r.load()


def fetch_by_ids(df: DataFrame, ids: DataFrame, key: str, ids_key: str | None = None) -> DataFrame:
    """Parameterised pull: rows whose key is in another frame's ids (S5) — a semi join."""
    from ..operators.joins import members
    return members(df, ids, key, ids_key or key)


def read_gpx_points(spark: SparkSession, path: str, row_tag: str = "trkpt") -> DataFrame:
    """GPX track points / waypoints → (lon, lat, ele, ts, name) rows (S6), built-in XML reader."""
    df = spark.read.format("xml").option("rowTag", row_tag).load(path)
    cols = {c: c for c in df.columns}
    out = [F.col("_lon").cast("double").alias("lon"), F.col("_lat").cast("double").alias("lat")]
    if "ele" in cols:
        out.append(F.col("ele").cast("double").alias("ele"))
    if "time" in cols:
        out.append(F.to_timestamp_ntz(F.col("time").cast("string")).alias("ts"))
    if "name" in cols:
        out.append(F.col("name").cast("string").alias("name"))
    return df.select(*out)


def json_rows(df: DataFrame, column: str) -> DataFrame:
    """The JSON texts of a column as rows, their schema inferred over all of them."""
    spark = df.sparkSession
    texts = getattr(df.select(column)._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(spark._jsparkSession.read().json(texts), spark)


def coordinate_rings(kind: Column, coordinates: Column) -> Column:
    """Rings (or lines) of a geometry as ``array<array<struct<x,y>>>``, from the text of its coordinates.

    Parts of several polygons come one after the other, holes among them: for
    the even-odd rule their order is of no matter.  Points have none.
    """
    depth = lambda n: F.from_json(coordinates, "array<" * n + "double" + ">" * n)
    rings = (F.when(kind == "MultiPolygon", F.flatten(depth(4))).when(kind.isin("Polygon", "MultiLineString"), depth(3))
             .when(kind == "LineString", F.array(depth(2))))
    return F.transform(rings, lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))


def read_geojson(spark: SparkSession, path: str, multiline: bool = False, geometry: str = "point",
                 ring_name: str = "ring") -> DataFrame:
    """GeoJSON features → rows of properties plus their geometry.

    Accepts one feature per line (as written by ``write_geojson``) or
    FeatureCollection files (``multiline=True``), of which a large one is cut
    into features by many tasks (:mod:`.framing`).  Layer folders of the former
    come as a column.  ``geometry="point"`` gives
    ``lon`` and ``lat``; ``"rings"`` the rings of lines and polygons with their
    parts and holes (:func:`coordinate_rings`), ready for ``spatial.within``.
    """
    if multiline:
        raw = records(spark, path, Features).select("record")
    else:
        raw = spark.read.option("recursiveFileLookup", "false").text(path).withColumnRenamed("value", "record")
    layers = [c for c in raw.columns if c != "record"]
    part = lambda p: F.get_json_object("record", p)
    f = raw.where(part("$.type") == "Feature").select(
        *layers, part("$.properties").alias("__p"), part("$.geometry.type").alias("__kind"),
        part("$.geometry.coordinates").alias("__xy"))
    schema = json_rows(f.where("__p IS NOT NULL"), "__p").schema
    f = f.withColumn("__p", F.from_json("__p", schema))
    props = [*layers, *[F.col(f"__p.`{n}`").alias(n) for n in schema.names]]
    if geometry == "rings":
        return f.select(*props, coordinate_rings(F.col("__kind"), F.col("__xy")).alias(ring_name))
    point = F.from_json("__xy", "array<double>")
    return f.select(*props, point[0].alias("lon"), point[1].alias("lat"))


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Directory listing as a table (path, name, length, modified).

    ``binaryFile`` with the content column pruned: only metadata is read.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path).select("path", "length", "modificationTime")
    return df.withColumn("name", F.regexp_extract("path", r"[^/]*$", 0))


def column_catalog(df: DataFrame, comments: dict[str, str] | None = None, counts: bool = True) -> DataFrame:
    """Column names, types, comments and non-null counts.

    Names/types come from the schema; counts are one aggregate pass (one row).
    """
    spark = df.sparkSession
    rows = [(i + 1, f.name, f.dataType.simpleString(), (comments or {}).get(f.name, f.metadata.get("comment")))
            for i, f in enumerate(df.schema.fields)]
    cat = spark.createDataFrame(rows, "position int, name string, type string, comment string")
    if not counts:
        return cat
    c = df.agg(*[F.count(F.col(f"`{n}`")).alias(n) for n in df.columns])
    long = c.unpivot([], c.columns, "name", "n_non_null")
    return cat.join(long, "name", "left")


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Literal lookup / appended constant rows."""
    from ..operators.joins import lookup
    return lookup(spark, rows, schema)
