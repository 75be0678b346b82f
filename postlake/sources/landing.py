"""JSON Lines landing files (SRC-2, SNK-7)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.operators.filters import CORRUPT
from postlake.sinks.ledger import FILE, MODIFIED, with_file
from postlake.sources.registry import load_schema


def day_path(root: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/year={day:%Y}/month={day:%m}/day={day:%d}"


def whole_rows(parsed: DataFrame, *keep: str) -> DataFrame:
    """Rows of a JSON source, each parsed whole whatever columns are used later.

    A file source parses only the columns that are asked for, and which lines are corrupt
    depends on them.  Nothing is pruned or pushed below a generator, so the parsed and the
    unparsable rows above this one always add up.
    """
    fields = [F.col(f"`{name}`") for name in parsed.columns if name not in keep]
    return parsed.select(*keep, F.inline(F.array(F.struct(*fields))))


def json_lines(reader, schema: T.StructType | str):
    """A reader, of a table or a stream, for JSON Lines: fixed schema, nothing inferred;
    unparsable lines fill the corrupt column."""
    return reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str, *, files: bool = False) -> DataFrame:
    """JSON Lines of a path; ``files`` adds which file a row is from."""
    rows = json_lines(spark.read, schema).json(path)
    return whole_rows(with_file(rows), FILE, MODIFIED) if files else whole_rows(rows)


def read_landing(
    spark: SparkSession, root: str, source: str, day: dt.date, schema_dir: str | None = None, *, files: bool = False
) -> DataFrame:
    """SRC-2: one source's file (or directory of files) of one day."""
    path = f"{day_path(root, day)}/{source}_jobs.json"
    return read_json_lines(spark, path, load_schema(source, schema_dir), files=files)


def write_landing(df: DataFrame, root: str, source: str, day: dt.date) -> str:
    """SNK-7: a day's rows as JSON Lines where ``read_landing`` looks for them.

    A rerun replaces the day.  NULL fields are written, text stays UTF-8, and
    every task writes its own part below the source's name.
    """
    path = f"{day_path(root, day)}/{source}_jobs.json"
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path
