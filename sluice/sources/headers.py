"""Folders of CSV files that don't all have the same header (SRC-4).

Spark gives every file of a read the column names of one of them, so a file with its columns in another order loads
into the wrong names, unflagged. Here each file's own first line decides:

1. one pass finds the first line of every file (needed only where headers differ: ``scan_csv`` first lets Spark's own
   header check, which costs nothing, tell whether they do);
2. files are grouped by that line, and each group is read with its own names: the tolerant scan of ``sources.csv``;
3. columns are mapped by name to the table's columns. A header with the table's columns in another order, or without
   some optional ones (NULL), loads; a header with other names, repeated names or without a required column is
   unknown, and every line below it is a corrupt line, for the gate and the quarantine.

Headers are told apart on the driver: one row a file, as in the file listing that any scan makes there.
"""

from __future__ import annotations

import csv
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from sluice.sources.csv import CORRUPT, read_raw_csv

log = logging.getLogger(__name__)

#: How a header relates to the table: the same, in another order, without optional columns, or unknown.
SAME, REORDERED, SHORT, UNKNOWN = "same", "reordered", "short", "unknown"
FILE = "_source_path"
BOM = "\ufeff"


@dataclass
class HeaderGroup:
    """Files that share one header line."""

    line: str
    names: list[str]
    files: list[str]
    kind: str = UNKNOWN
    reason: str | None = None
    mapping: dict[str, str] = field(default_factory=dict)  # table column -> name in these files


def first_lines(spark: SparkSession, paths: str | Sequence[str], options: Mapping[str, str] | None = None) -> DataFrame:
    """(path, line): the first line of every file that has one. One pass over the lines, combined per file before the
    shuffle; no operator stops a file's scan after one row, and a job per file would be a loop on the driver."""
    opts = {k: v for k, v in (options or {}).items() if k in ("encoding", "lineSep", "pathGlobFilter", "recursiveFileLookup")}
    lines = spark.read.options(**opts).text(paths if isinstance(paths, str) else list(paths))
    # ids grow in reading order within the split that starts the file
    starts = lines.filter(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("at"))
    return starts.groupBy("path").agg(F.min_by("value", "at").alias("line"))


def header_names(line: str, options: Mapping[str, str] | None = None) -> list[str]:
    """The names in a header line (quotes and a byte order mark removed)."""
    opts = {k.lower(): v for k, v in (options or {}).items()}
    sep = opts.get("sep") or opts.get("delimiter") or ","
    quote = opts.get("quote", '"') or None
    return next(csv.reader([line.lstrip(BOM)], delimiter=sep, quotechar=quote,
                           quoting=csv.QUOTE_MINIMAL if quote else csv.QUOTE_NONE))


def header_groups(spark: SparkSession, paths, options: Mapping[str, str] | None = None) -> list[HeaderGroup]:
    """Files grouped by header line: most files first, then by line."""
    found: dict[str, list[str]] = {}
    for path, line in first_lines(spark, paths, options).collect():
        found.setdefault(line.lstrip(BOM).rstrip("\r"), []).append(path)
    return [HeaderGroup(line, header_names(line, options), sorted(files))
            for line, files in sorted(found.items(), key=lambda x: (-len(x[1]), x[0]))]


def classify(group: HeaderGroup, columns: Sequence[str], required: Sequence[str] = ()) -> HeaderGroup:
    """Set how the group's header relates to ``columns``. Names match in any case; blanks around them don't count."""
    wanted = {c.lower(): c for c in columns}
    names = [n.strip() for n in group.names]
    lower = [n.lower() for n in names]
    if len(set(lower)) < len(lower):
        group.reason = "repeated column names"
    elif extra := [n for n in names if n.lower() not in wanted]:
        group.reason = "unknown columns: " + ",".join(extra)
    elif missing := [c for c in required if c.lower() not in lower]:
        group.reason = "missing columns: " + ",".join(missing)
    else:
        group.mapping = {wanted[n.lower()]: own for n, own in zip(names, group.names, strict=True)}
        order = [c for c in columns if c.lower() in lower]
        if len(lower) < len(columns):
            group.kind = SHORT
        else:
            group.kind = SAME if [wanted[n] for n in lower] == order else REORDERED
    return group


def _unknown_lines(spark: SparkSession, files: list[str], options: Mapping[str, str] | None) -> DataFrame:
    """The lines below the headers of ``files``, each as one field."""
    kept = {k: v for k, v in (options or {}).items() if k in ("encoding", "lineSep")}
    raw = (spark.read.options(**kept).schema(f"line string, {CORRUPT} string").option("header", "true").option("sep", "\u0001")
           .option("quote", "").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
           .option("columnPruning", "false").csv(files))
    return raw.select(F.coalesce(CORRUPT, "line").alias(CORRUPT), F.col("_metadata.file_path").alias(FILE))


def read_csv_by_header(spark: SparkSession, paths, columns: Sequence[str] | None = None, required: Sequence[str] = (),
                       options: Mapping[str, str] | None = None, with_file: bool = False) -> tuple[DataFrame, list[HeaderGroup]]:
    """All-string rows of files with differing headers, mapped by name, with ``_corrupt_record`` (lazy), and the groups.

    ``columns`` are the table's; without them the header that most files share (ties: the longest, then the first in
    order) is the table's. A column that a file lacks is NULL. Lines below an unknown header are corrupt records. With
    ``with_file`` the column ``_source_path`` names each row's file. Without any line in any file there is no header:
    the frame has ``columns`` only, or raises when none are given.
    """
    groups = header_groups(spark, paths, options)
    if columns is None:
        if not groups:
            raise ValueError(f"no header line found under {paths}")
        most = len(groups[0].files)
        best = min((g for g in groups if len(g.files) == most), key=lambda g: (-len(g.names), g.line))
        columns = [n.strip() for n in best.names]
    columns = list(columns)
    parts = []
    for g in groups:
        classify(g, columns, required)
        if g.kind == UNKNOWN:
            log.warning("%d files with an unknown header (%s) go to the quarantine: %s", len(g.files), g.reason, g.line)
            rows = _unknown_lines(spark, g.files, options)
            part = rows.select(*[F.lit(None).cast("string").alias(c) for c in columns], CORRUPT, FILE)
        else:
            at = {own: f"c{i}" for i, own in enumerate(g.names)}  # positions: names may hold dots or blanks
            rows = read_raw_csv(spark, g.files, [at[n] for n in g.names], options)
            part = rows.select(*[(F.col(at[g.mapping[c]]) if c in g.mapping else F.lit(None).cast("string")).alias(c) for c in columns],
                               CORRUPT, F.col("_metadata.file_path").alias(FILE))
        parts.append(part)
    if not parts:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, CORRUPT, FILE]])
        parts = [spark.createDataFrame([], schema)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return (out if with_file else out.drop(FILE)), groups


def header_report(spark: SparkSession, groups: Sequence[HeaderGroup]) -> DataFrame:
    """One row a file: path, header, kind, reason."""
    rows = [(f, g.line, g.kind, g.reason) for g in groups for f in g.files]
    return spark.createDataFrame(rows, "path string, header string, kind string, reason string")
