"""CSV at the ingest edge: encodings, missing tokens, row ordinals, export."""

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.functions.text import clean_header, null_csv_tokens
from snapmart.operators.rows import normalize_key, union_all

ENCODINGS = ("utf-8", "gb18030", "windows-1252")
ORDER = "ord_"


def can_read(spark: SparkSession, path: str) -> bool:
    """Does anything exist at ``path``? Resolved by the scan itself, so any file system works."""
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def _decodes(encoding: str):
    def lines_ok(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = {}
            for path, line in zip(batch["path"], batch["line"], strict=True):
                if good.get(path, True):
                    try:
                        bytes(line).decode(encoding)
                        good[path] = True
                    except UnicodeDecodeError:
                        good[path] = False
            yield pd.DataFrame({"path": list(good), "ok": list(good.values())}, columns=["path", "ok"])
    return lines_ok


def detect_encodings(spark: SparkSession, path, encodings=ENCODINGS, multi_line: bool = False) -> dict[str, list[str]]:
    """``{encoding: files}``: for each file the first encoding in which every line decodes; whole texts are checked.

    UTF-8 is checked by a built-in expression. Only for files that are not UTF-8 are the other codecs tried, on
    line bytes in Arrow batches that return one flag a file. A file with an odd number of quotes in a line has records
    that go over several lines, and is an error without ``multi_line``.
    """
    file = F.col("_metadata.file_path").alias("path")
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1
    found = (spark.read.text(path).select(file, F.is_valid_utf8("value").alias("utf8"), odd.alias("odd"))
             .groupBy("path").agg(F.min("utf8").alias("utf8"), F.max("odd").alias("odd")).collect())
    broken = [r["path"] for r in found if r["odd"]]
    if broken and not multi_line:
        raise ValueError(f"records with line breaks inside quotes (read with multi_line=True): {', '.join(sorted(broken)[:5])}")
    out: dict[str, list[str]] = {}
    left = []
    for r in found:
        if "utf-8" in encodings and r["utf8"]:
            out.setdefault("utf-8", []).append(r["path"])
        else:
            left.append(r["path"])
    for encoding in (e for e in encodings if e != "utf-8"):
        if not left:
            break
        lines = spark.read.text(left).select(file, F.col("value").cast("binary").alias("line"))
        checked = lines.mapInPandas(_decodes(encoding), "path string, ok boolean").groupBy("path").agg(F.min("ok").alias("ok"))
        good = sorted(r["path"] for r in checked.collect() if r["ok"])
        if good:
            out[encoding] = good
        left = sorted(set(left) - set(good))
    if left:
        raise ValueError(f"cannot be decoded as any of {', '.join(encodings)}: {', '.join(left[:5])}")
    return out


def detect_encoding(spark: SparkSession, path: str, encodings=ENCODINGS) -> str:
    """The encoding of a path whose files all have the same one."""
    found = detect_encodings(spark, path, encodings) or {encodings[0]: []}
    if len(found) > 1:
        raise ValueError(f"{path} has files of several encodings: {', '.join(found)}")
    return next(iter(found))


def read_csv_any(spark: SparkSession, path, encodings=ENCODINGS, order: str | None = ORDER, multi_line: bool = False,
                 extra: dict[str, Column] | None = None) -> DataFrame:
    """All columns as text, with clean headers, NULL for missing tokens and a row ordinal.

    Each file is read in its own encoding, by one scan for each encoding that occurs. The ordinal (file, block start,
    running number) follows the order of the rows in each file and is unique; store it with the first layer. ``extra``
    adds columns made of file metadata. Encodings other than UTF-8 need the session
    setting ``spark.sql.legacy.javaCharsets``, which is switched on when one is found.
    """
    found = detect_encodings(spark, path, encodings, multi_line)
    if set(found) - {"utf-8"}:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    scans = [_scan(spark, files, encoding, order, multi_line, extra or {}) for encoding, files in found.items()]
    if not scans:
        scans = [_scan(spark, path, "utf-8", order, multi_line, extra or {})]
    return union_all(scans)


def _scan(spark: SparkSession, path, encoding: str, order: str | None, multi_line: bool, extra: dict[str, Column]) -> DataFrame:
    raw = spark.read.csv(path, header=True, inferSchema=False, encoding=encoding, quote='"', escape='"', enforceSchema=False,
                         multiLine=multi_line)
    names = [clean_header(c) for c in raw.columns]
    more = dict(extra)
    if order is not None:
        more[order] = F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                               F.monotonically_increasing_id().alias("row"))
    cells = [null_csv_tokens(F.col(f"`{c}`")).alias(c) for c in names]
    kept = [n for n in more if n not in names] if order is None else list(more)
    return raw.select("*", *[more[n].alias(n) for n in kept]).toDF(*names, *kept).select(*cells, *kept)


def read_csv_if_ready(spark: SparkSession, path: str, key: str, **options) -> DataFrame | None:
    """The table with its key stripped, or None when the path or the key column is missing."""
    if not can_read(spark, path):
        return None
    df = read_csv_any(spark, path, **options)
    return normalize_key(df, key) if key in df.columns else None


def write_csv(df: DataFrame, path: str, encoding: str = "utf-8") -> None:
    if encoding != "utf-8":
        df.sparkSession.conf.set("spark.sql.legacy.javaCharsets", "true")
    df.write.mode("overwrite").option("header", True).option("encoding", encoding).csv(path)
