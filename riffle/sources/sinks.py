"""Sinks (K1–K6).  Writes are distributed: each task writes its own files.

Nothing is written to a path that the same job reads; snapshots go to version
folders of their own, named in a log.
"""

from __future__ import annotations

import datetime as _dt
import os
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> str:
    """CSV with missing values written as empty strings (K1).

    Blanks at the ends of a value stay; quotes inside one are doubled.
    """
    (df.write.mode(mode).option("header", header).option("nullValue", "").option("emptyValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("quote", '"').option("escape", '"').csv(path))
    return path


def route(df: DataFrame, rules: Sequence[tuple[Column, str]], path: str, fmt: str = "parquet",
          default: str | None = None, dest_col: str = "dest", mode: str = "overwrite") -> str:
    """Route rows to several outputs by predicate in ONE pass (K2).

    The first matching rule names the destination; output is partitioned by
    it (``<path>/dest=<name>/``).  Rows matching no rule go to ``default``;
    without one such a row fails the write.
    """
    expr = None
    for cond, name in rules:
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    rest = F.lit(default) if default is not None else F.raise_error(F.lit("a row matches no rule and no default"))
    out = df.withColumn(dest_col, expr.otherwise(rest))
    out.write.mode(mode).partitionBy(dest_col).format(fmt).save(path)
    return path


def stamped(path: str, run_date: _dt.date | str | None = None, name: str = "run_date") -> str:
    """Date-stamped output location (K3): ``<path>/<name>=YYYYMMDD``; the date is an argument."""
    d = run_date or _dt.date.today()
    s = d.strftime("%Y%m%d") if isinstance(d, _dt.date) else str(d)
    return os.path.join(path, f"{name}={s}")


class SnapshotConflict(RuntimeError):
    """Another writer committed the version that this one was about to."""


def _fs(spark, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _commit(spark, staged: str, entry: str) -> bool:
    """Give a complete log entry its name, unless the name is taken."""
    src, fs = _fs(spark, staged)
    dst, _ = _fs(spark, entry)
    if fs.getUri().getScheme() == "file":  # a rename would replace the entry, a link never does
        path = lambda p: spark._jvm.java.io.File(p.toUri().getPath()).toPath()
        if fs.exists(dst):
            return False
        spark._jvm.java.nio.file.Files.createLink(path(dst), path(src))
        fs.delete(src, False)
        return True
    return bool(fs.rename(src, dst)) if not fs.exists(dst) else False


def versions(spark, root: str) -> list[dict]:
    """Committed versions of a table, oldest first: ``version, run_date, folder``."""
    log, fs = _fs(spark, os.path.join(root, "_log"))
    if not fs.exists(log):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(log)]
    entries = [n for n in names if n.endswith(".json") and not n.startswith((".", "_"))]
    if not entries:
        return []
    found = spark.read.schema("version long, run_date string, folder string").json(
        [os.path.join(root, "_log", n) for n in entries]).collect()  # a short row a version
    return sorted((r.asDict() for r in found), key=lambda r: r["version"])


def snapshot(df: DataFrame, root: str, run_date: str | None = None) -> int:
    """Write ``df`` as the next version of the table at ``root`` (K4); returns its number.

    Every version has a folder of its own, named at random, so no run touches
    another one's files and a date may have several versions.  The version
    exists once its entry in the log has its name: the entry is written whole
    beside the log and then named, which fails if the name is taken
    (``SnapshotConflict``: a second writer was faster; nothing is lost, run
    again).  A run that ends at any point before leaves the table as it was.
    Earlier versions are the archive: see :func:`read_snapshot`.
    """
    import json
    import uuid
    spark = df.sparkSession
    known = versions(spark, root)
    number = known[-1]["version"] + 1 if known else 1
    folder = f"version-{uuid.uuid4().hex}"
    df.write.parquet(os.path.join(root, folder))
    entry = json.dumps({"version": number, "run_date": run_date, "folder": folder})
    log, fs = _fs(spark, os.path.join(root, "_log"))
    fs.mkdirs(log)
    staged, _ = _fs(spark, os.path.join(root, f"_staged-{folder}"))
    out = fs.create(staged, False)
    out.write(bytearray(entry.encode()))
    out.close()
    if not _commit(spark, staged.toString(), os.path.join(root, "_log", f"{number:020d}.json")):
        raise SnapshotConflict(f"{root}: version {number} was committed by another writer")
    return number


def read_snapshot(spark, root: str, version: int | None = None, run_date: str | None = None) -> DataFrame:
    """A version of a table: the latest, one by number, or the latest of a date."""
    known = [v for v in versions(spark, root) if version in (None, v["version"]) and run_date in (None, v["run_date"])]
    if not known:
        raise FileNotFoundError(f"{root}: no such version")
    return spark.read.parquet(os.path.join(root, known[-1]["folder"]))


def replace_table(df: DataFrame, root: str) -> int:
    """Replace-table write (K5): readers see the old or the new table, never none."""
    return snapshot(df, root)


def geojson_lines(df: DataFrame, lon: str, lat: str, props: Sequence[str]) -> Column:
    """One GeoJSON Feature per row as JSON text."""
    return F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*[F.col(p) for p in props]).alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array(F.col(lon), F.col(lat)).alias("coordinates"))
         .alias("geometry")))


def write_geojson(df: DataFrame, path: str, lon: str, lat: str, props: Sequence[str],
                  layer: str | None = None, mode: str = "overwrite") -> str:
    """GeoJSON features, one per line, one folder per layer (K6)."""
    cols = [geojson_lines(df, lon, lat, props).alias("value")]
    out = df.select(*cols, *([F.col(layer)] if layer else []))
    w = out.write.mode(mode)
    if layer:
        w = w.partitionBy(layer)
    w.text(path)
    return path


def write_geojson_polygons(df: DataFrame, path: str, ring_name: str, props: Sequence[str], mode: str = "overwrite") -> str:
    """GeoJSON polygon features, one per line; ``ring_name`` holds an array of rings (K6)."""
    corners = F.transform(ring_name, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))
    feature = F.to_json(F.struct(
        F.lit("Feature").alias("type"), F.struct(*[F.col(p) for p in props]).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), corners.alias("coordinates")).alias("geometry")))
    df.select(feature.alias("value")).write.mode(mode).text(path)
    return path


def write_gpx(df: DataFrame, path: str, lon: str, lat: str, ts: str, ele: str | None = None,
              mode: str = "overwrite") -> str:
    """GPX-shaped XML track points (``trkpt`` with ``lat``/``lon`` attributes) with the XML source."""
    cols = [F.col(lat).alias("_lat"), F.col(lon).alias("_lon"),
            F.date_format(F.col(ts), "yyyy-MM-dd'T'HH:mm:ss").alias("time")]
    if ele:
        cols.append(F.col(ele).alias("ele"))
    df.select(*cols).write.mode(mode).format("xml").option("rootTag", "trkseg").option("rowTag", "trkpt").save(path)
    return path
