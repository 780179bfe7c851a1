"""Kline archives and CSV files: schema, header aliases, units, checksums, merging."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from seriesmill.operators.asof import keep_last
from seriesmill.plans.materialize import sized

# The kline record, its types and the header names that differ.
KLINE_TYPES = {
    "open_time": "bigint", "open": "double", "high": "double", "low": "double", "close": "double", "volume": "double",
    "close_time": "bigint", "quote_asset_volume": "double", "number_of_trades": "bigint",
    "taker_buy_base_asset_volume": "double", "taker_buy_quote_asset_volume": "double", "ignore": "string",
}
HEADER_ALIASES = {
    "quote_volume": "quote_asset_volume", "count": "number_of_trades",
    "taker_buy_volume": "taker_buy_base_asset_volume", "taker_buy_quote_volume": "taker_buy_quote_asset_volume",
}
MICROSECONDS_ABOVE = 10 ** 14


def to_milliseconds(t: Column) -> Column:
    """Epoch values beyond any millisecond date are microseconds."""
    return F.when(t > MICROSECONDS_ABOVE, F.floor(t / 1000)).otherwise(t).cast("bigint")


def typed(raw: DataFrame) -> DataFrame:
    """Text columns to the kline types; a value that does not parse fails the job."""
    missing = [c for c in KLINE_TYPES if c not in raw.columns]
    if missing:
        raise ValueError(f"header missing columns {missing}")
    extra = [c for c in raw.columns if c not in KLINE_TYPES]
    df = raw.select(*[F.col(c).cast(t).alias(c) for c, t in KLINE_TYPES.items()], *extra)
    return df.withColumns({c: to_milliseconds(F.col(c)) for c in ("open_time", "close_time")})


def read_klines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Kline CSV files, each with or without a header row, with their ``file``.

    A file's header, if its first line does not begin with a number, decides the place of each of
    its values.  The files are read as lines, so a large file is still split over tasks.
    """
    lines = spark.read.text(list(paths)).select(
        F.input_file_name().alias("file"), F.ltrim(F.replace("value", F.lit("\ufeff"), F.lit(""))).alias("line")).where("line <> ''")
    is_row = F.col("line").rlike(r'^"?[0-9]')
    heads = sized(lines.where(~is_row).groupBy("file").agg(F.first("line").alias("header"), F.count(F.lit(1)).alias("heads")))
    named = F.when(F.col("header").isNull(), F.array(*[F.lit(c) for c in KLINE_TYPES])).otherwise(_names("header"))
    wrong = F.coalesce((F.col("heads") > 1) | (F.size(F.array_except(F.array(*[F.lit(c) for c in KLINE_TYPES]), _names("header"))) > 0), F.lit(False))
    fault = F.concat(F.lit("header missing columns, or a line that is no row, in "), F.col("file"), F.lit(": "), F.col("header"))
    # a file of nothing but a faulty header fails too
    rows = heads.join(lines.where(is_row), "file", "right").select("file", "line", "header", "heads").unionByName(
        heads.where(wrong).select("file", F.lit("0").alias("line"), "header", "heads"))
    cells = F.map_from_arrays(named, F.transform(F.split("line", ","), lambda v: F.trim(F.replace(v, F.lit('"'), F.lit("")))))
    raw = rows.select("file", F.when(wrong, F.raise_error(fault)).otherwise(cells).alias("c"))
    return typed(raw.select(*[F.element_at("c", c).alias(c) for c in KLINE_TYPES], "file"))


def _names(header: str) -> Column:
    return F.transform(F.split(header, ","), lambda h: _alias(F.lower(F.replace(F.trim(F.replace(h, F.lit('"'), F.lit(""))), F.lit(" "), F.lit("_")))))


def read_archives(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Archive files as ``path, content``."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(paths).select("path", "content")


def expand_archives(archives: DataFrame) -> DataFrame:
    """Kline rows of ZIP archives with exactly one CSV member each, with their ``path``.

    Archives are spread over tasks; each is unpacked and split into lines on its own.
    """
    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    members = [n for n in z.namelist() if n.endswith(".csv")]
                    if len(members) != 1:
                        raise ValueError(f"Expected exactly one CSV member in {path}, found {members}")
                    text = z.read(members[0]).decode("utf-8-sig")
                lines = [ln for ln in text.splitlines() if ln.strip()]
                headed = bool(lines) and not lines[0].lstrip()[:1].isdigit()
                header = lines[0] if headed else ""
                yield pd.DataFrame({"path": path, "header": header, "line": lines[1:] if headed else lines})

    lines = archives.mapInPandas(unpack, "path string, header string, line string")
    # the header decides each value's place, per archive
    named = F.when(F.col("header") == "", F.array(*[F.lit(c) for c in KLINE_TYPES])).otherwise(_names("header"))
    cells = F.map_from_arrays(named, F.split("line", ","))
    raw = lines.select("path", cells.alias("c"))
    return typed(raw.select("path", *[F.element_at("c", c).alias(c) for c in KLINE_TYPES]))


def _alias(name: Column) -> Column:
    out = name
    for short, full in HEADER_ALIASES.items():
        out = F.when(name == short, F.lit(full)).otherwise(out)
    return out


def checksum_of(body: Column) -> Column:
    """Digest of a checksum file ``<sha256>  <name>``."""
    return F.lower(F.element_at(F.split(F.trim(body), r"\s+"), 1))


def audit_checksums(archives: DataFrame, manifest: DataFrame) -> DataFrame:
    """``verified``, ``mismatch``, or ``absent`` (no manifest entry) per archive.

    ``manifest`` holds ``path, body``; only digests are joined, never the contents.
    """
    digests = archives.select("path", F.sha2("content", 256).alias("sha256"))
    joined = digests.join(manifest.select("path", checksum_of(F.col("body")).alias("_want")), "path", "left")
    status = F.when(F.col("_want").isNull(), "absent").when(F.col("_want") == F.col("sha256"), "verified").otherwise("mismatch")
    return joined.select("path", "sha256", status.alias("status"))


def merge_periods(rows: DataFrame, keys: Sequence[str], seq: str = "file_seq", time: str = "open_time") -> DataFrame:
    """One row per series and open time: that of the latest file."""
    return keep_last(rows, [*keys, time], [seq])


def to_bars(klines: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    return klines.select(*[v.alias(k) for k, v in keys.items()], F.timestamp_millis("open_time").alias("ts"),
                         "open", "high", "low", "close", "volume")
