"""Table sources and sinks: path tables in shared storage, catalog tables (a
name rather than a path), and JDBC tables (``fmt="jdbc"`` and its options, with
the driver's jar on the classpath).

Path tables that are written here have a log (``tablelog``): a replacement is
one new version of it, so readers through ``scan`` find the old rows or the new
ones and never a missing table.  A plain folder of files is a table too; it gets
its log with the first replacement or compaction.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import schemas as S
from quarry.functions.ids import assign_ids
from quarry.session import ensure_checkpoint_dir
from quarry.sources.tablelog import KEEP_SECONDS, Files, TableLog


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def scan(spark: SparkSession, target: str, fmt: str = "parquet", **options) -> DataFrame:
    """Full table scan (columns and filters applied later are pushed down)."""
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(dbtable=target, **options).load()
    if _is_path(target):
        log = TableLog(spark, target)
        state = log.state() if fmt == "parquet" else None
        return log.scan(state) if state and state["schema"] else spark.read.format(fmt).options(**options).load(target)
    return spark.table(target)


def create_raw_table(spark: SparkSession, target: str) -> None:
    """Create the landing table with the raw schema if it does not exist."""
    empty = spark.createDataFrame([], S.RAW)
    if not _is_path(target):
        empty.write.mode("ignore").saveAsTable(target)
    elif not _plain_files(log := TableLog(spark, target)) and not _logged(log):
        log.append(empty)


def _logged(log: TableLog) -> bool:
    """Whether a path table has its rows in the log's folders (a log may also
    just hold reserved ids so far)."""
    state = log.state()
    return bool(state and state["schema"])


def _plain_files(log: TableLog) -> list[str]:
    return [n for n, _ in log.files.names(log.table) if not n.startswith((".", "_"))]


def _write(df: DataFrame, target: str, mode: str, fmt: str = "parquet", **options) -> None:
    w = df.write.mode(mode)
    if fmt == "jdbc":
        w.format("jdbc").options(dbtable=target, **options).save()
    elif _is_path(target):
        w.format(fmt).options(**options).save(target)
    else:
        w.format(fmt).saveAsTable(target)


PREVIOUS = "quarry.previous"  # table property: the location before the last replacement


def _location(spark: SparkSession, name: str) -> tuple[str | None, str | None]:
    """(location, location before the last replacement) of a catalog table."""
    rows = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return rows.get("Location"), properties.get(PREVIOUS)


def _replace_catalog(df: DataFrame, name: str, fmt: str) -> None:
    """The rows are written to a fresh location; then the table's location is
    switched, one change in the catalog.  The location before stays until the
    next replacement, for queries that read it.  A table with other columns
    cannot be switched so in Spark's session catalog; it is overwritten."""
    spark = df.sparkSession
    fresh = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}.versions/{uuid.uuid4().hex}"
    if not spark.catalog.tableExists(name):
        df.write.format(fmt).option("path", fresh).saveAsTable(name)
        return
    same = [(f.name, f.dataType) for f in spark.table(name).schema.fields] == [(f.name, f.dataType) for f in df.schema.fields]
    if not same:
        _write(df, name, "overwrite", fmt)
        return
    location, before = _location(spark, name)
    df.write.format(fmt).save(fresh)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{fresh}'")
    spark.catalog.refreshTable(name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PREVIOUS}' = '{location}')")
    if before:
        Files(spark, before).delete(before)


def replace_table(df: DataFrame, target: str, fmt: str = "parquet", keep_seconds: float = KEEP_SECONDS, **options) -> None:
    """Replace a table's rows and schema.

    The new rows are written first, beside the old ones; then one step makes
    them the table (a version of a path table's log, the location of a catalog
    table).  A write that fails leaves the old table as it was, and there is no
    moment without a table.  The old rows' files stay ``keep_seconds`` longer.
    JDBC tables and other path formats than Parquet are overwritten."""
    spark = df.sparkSession
    if fmt == "jdbc" or (_is_path(target) and fmt != "parquet"):
        _write(df, target, "overwrite", fmt, **options)
    elif not _is_path(target):
        _replace_catalog(df, target, fmt)
    else:
        log = TableLog(spark, target)
        plain = _plain_files(log)
        log.replace(df, keep_seconds)
        for name in plain:  # of a folder that had no log
            log.files.delete(f"{log.table}/{name}")


def append_table(df: DataFrame, target: str, fmt: str = "parquet", **options) -> None:
    """Add rows; a path table without a log stays a plain folder."""
    if fmt == "parquet" and _is_path(target):
        log = TableLog(df.sparkSession, target)
        if _logged(log) or not _plain_files(log):
            log.append(df)
            return
    _write(df, target, "append", fmt, **options)


#: Where a landing row came from; null where the source does not say.
SOURCE = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("topic", T.StringType()),
                       T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())])


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema, in its order and types; null where ``df`` has none."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def ledger_of(spark: SparkSession, target: str, ledger: str | None) -> str:
    """The path whose log tells which batches a table has: its own path, or for
    catalog and JDBC tables a folder of that name beside the checkpoints."""
    if ledger or _is_path(target):
        return ledger or target
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-ledgers/{target}"


def append_raw(decoded: DataFrame, target: str, batch_id: int | None = None, writer: str = "append", ledger: str | None = None,
               schema: T.StructType = S.RAW, fmt: str = "parquet", **options) -> bool:
    """Append decoded rows to a landing table in its columns and types; False
    if they are a batch that the table has already.

    Rows without an ``id`` column get fresh ones from the ledger.  With a
    ``batch_id`` the batch of that ``writer`` is added exactly once, however
    often it is tried: a path table commits rows and batch in one step.  For
    catalog and JDBC tables the rows are staged with their ids first; a try that
    follows a broken one appends just the staged rows whose ids are missing."""
    spark = decoded.sparkSession
    direct = fmt == "parquet" and _is_path(target)
    log = TableLog(spark, ledger_of(spark, target, ledger))
    who = writer if batch_id is not None else None
    if who is not None and log.covers(who, batch_id):
        return False
    if direct:
        return log.append(typed(_with_ids(decoded, log, who, batch_id), schema), who, batch_id)

    def least() -> int:  # a table that had rows before its ledger
        last = scan(spark, target, fmt, **options).agg(F.max("id")).first()[0]
        return 0 if last is None else last + 1

    if who is None:  # nothing to resume
        _write(typed(_with_ids(decoded, log, least=least), schema), target, "append", fmt, **options)
        return True
    staged = log.folder(f"staged-{uuid.uuid4().hex}")
    if log.note(f"{who}/staged", batch_id) is None:
        typed(_with_ids(decoded, log, who, batch_id, least), schema).write.parquet(staged)
        log.reserve(0, f"{who}/staged", batch_id, staged=staged)
    staged = log.note(f"{who}/staged", batch_id)["staged"]
    rows = spark.read.schema(schema).parquet(staged)
    span = rows.agg(F.min("id"), F.max("id")).first()
    if span[0] is not None:
        there = scan(spark, target, fmt, **options).where(F.col("id").between(*span)).select("id")
        _write(rows.join(there, "id", "left_anti").select(*schema.names), target, "append", fmt, **options)
    log.cover(who, batch_id)
    log.cover(f"{who}/staged", batch_id)
    log.files.delete(staged)
    return True


def _with_ids(decoded: DataFrame, log: TableLog, writer: str | None = None, batch_id: int | None = None,
              least: Callable[[], int] = lambda: 0) -> DataFrame:
    if "id" in decoded.columns:
        return decoded
    return assign_ids(decoded, lambda n: log.reserve(n, writer, batch_id, least=0 if log.state() else least())[0])


def register_views(spark: SparkSession, raw: str | DataFrame | None = None,
                   cleaned: str | DataFrame | None = None, **others) -> list[str]:
    """Expose tables as session views ``raw_data`` / ``cleaned_data`` (and any
    ``name=path_or_df``), so SQL written against the landing and cleaned
    tables runs unchanged through ``spark.sql``."""
    named = dict(others)
    if raw is not None:
        named["raw_data"] = raw
    if cleaned is not None:
        named["cleaned_data"] = cleaned
    for name, src in named.items():
        df = scan(spark, src) if isinstance(src, str) else src
        df.createOrReplaceTempView(name)
    return sorted(named)
