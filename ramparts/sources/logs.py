"""Decision logs as hour-partitioned gzip JSON lines: scan, sinks, retention, tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ramparts.sources.deliveries import counted, published, within
from ramparts.sources.schema import CONTRACT, CORRUPT, PARTITION_FIELDS, PARTITIONS, WIRE, contract_name

# The years that a scan of delivered logs shows and a sink accepts, unless it is told others.
YEARS = (2020, 2030)
# A scan over more days than this lists by month instead of by day.
LISTED_DAYS = 400


# The line as a VARIANT while its columns are taken out of it.
LINE = "_line"


def _parsed(lines: DataFrame, line: str, *extra: str) -> DataFrame:
    """Each line that is not blank, parsed once as a VARIANT in ``_line``; NULL there if it is no JSON object.

    Unpacked from an array of one, the VARIANT counts as a stored value: a filter on it is not rewritten into one that
    parses the line once more.
    """
    parsed = F.when(F.ltrim(line).startswith("{"), F.try_parse_json(line))
    return lines.filter(F.trim(line) != "").select(line, *extra, F.explode(F.array(parsed)).alias(LINE))


def _is_record() -> Column:
    """Whether ``_line`` is a JSON object whose time, if it has one, is a number. Whichever columns are read, this alone
    decides whether a line is a row."""
    said, time = (F.try_variant_get(LINE, "$.timestamp", kind) for kind in ("string", "bigint"))
    return F.col(LINE).isNotNull() & (said.isNull() | time.isNotNull())


def _column(field: T.StructField, contract: T.StructField) -> Column:
    """A column of the contract out of ``_line``. Keys are spelled as on the wire or all in lower case; a value of
    another type is NULL."""
    value = F.try_variant_get(LINE, f"$.{field.name}", field.dataType.simpleString()).cast(contract.dataType)
    if field.name != field.name.lower():
        lower = F.try_variant_get(LINE, f"$.{field.name.lower()}", contract.dataType.simpleString())
        value = F.coalesce(value, lower)
    return value.alias(contract.name)


def _to_contract(parsed: DataFrame, *extra: str) -> DataFrame:
    return parsed.select(*[_column(f, c) for f, c in zip(WIRE, CONTRACT)], *extra)


def _to_wire(logs: DataFrame, *extra: str) -> DataFrame:
    columns = [F.col(contract_name(f.name)).cast(f.dataType).alias(f.name) for f in WIRE]
    return logs.select(*columns, *extra)


def to_lines(logs: DataFrame, *extra: str) -> DataFrame:
    """One JSON object per row in column ``value``, beside any ``extra`` columns."""
    wire = _to_wire(logs, *extra)
    return wire.select(F.to_json(F.struct(*WIRE.names)).alias("value"), *extra)


def parse_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Parse JSON text into the contract columns, batch or stream.

    ``_corrupt_record`` holds the text of a line that is no record and is NULL otherwise. Blank lines are left out.
    """
    return _to_contract(_parsed(lines, line), F.when(~_is_record(), F.col(line)).alias(CORRUPT))


def error_records(parsed: DataFrame, moment: Column | None = None, years: tuple[int, int] = YEARS) -> DataFrame:
    """Text of the lines that did not parse, and of the records without a time inside the years, as JSON."""
    out = parsed.filter(refused(parsed, moment, years))
    record = F.to_json(F.struct(*[F.col(contract_name(f.name)).cast(f.dataType).alias(f.name) for f in WIRE]))
    return out.select((F.coalesce(CORRUPT, record) if CORRUPT in parsed.columns else record).alias("value"))


def visible_partitions(logs: DataFrame, years: tuple[int, int] = YEARS) -> DataFrame:
    """Keep the declared partition domain; plain comparisons, so the scan prunes by them."""
    first, last = years
    return logs.filter(
        F.col("year").between(f"{first:04d}", f"{last:04d}")
        & F.col("month").between("01", "12")
        & F.col("day").between("01", "31")
        & F.col("hour").between("00", "23")
    )


def event_time(ts_ms: Column, years: tuple[int, int] = YEARS) -> Column:
    """Timestamp of epoch milliseconds; NULL without one and outside the years, however far."""
    first, after = (datetime(year, 1, 1, tzinfo=timezone.utc) for year in (years[0], years[1] + 1))
    inside = (ts_ms >= int(first.timestamp()) * 1000) & (ts_ms < int(after.timestamp()) * 1000)
    return F.timestamp_millis(F.when(inside, ts_ms))


def refused(parsed: DataFrame, moment: Column | None = None, years: tuple[int, int] = YEARS) -> Column:
    """Whether a row has no place in the log: its line did not parse, or no hour can be told for it."""
    when = event_time(F.col("ts_ms"), years) if moment is None else moment
    return F.col(CORRUPT).isNotNull() | when.isNull() if CORRUPT in parsed.columns else when.isNull()


def _tuple_bound(values: tuple[str, ...], at_least: bool) -> Column:
    """(year, month, day, hour) >= values, or <=, as plain comparisons of the partition columns."""
    *head, last = zip(PARTITIONS, values)
    name, value = last
    bound = F.col(name) >= value if at_least else F.col(name) <= value
    for name, value in reversed(head):
        beyond = F.col(name) > value if at_least else F.col(name) < value
        bound = beyond | ((F.col(name) == value) & bound)
    return bound


def _hour_values(moment: datetime) -> tuple[str, ...]:
    return tuple(moment.strftime("%Y-%m-%d-%H").split("-"))


def _listing(start: datetime | None, end: datetime | None) -> str:
    """Glob below the root that lists only folders the range can touch."""
    if start is None or end is None:
        return "year=*"
    days = [start.date() + timedelta(n) for n in range((end.date() - start.date()).days + 1)]
    form = "year=%Y/month=%m/day=%d" if len(days) <= LISTED_DAYS else "year=%Y/month=%m"
    folders = dict.fromkeys(day.strftime(form) for day in days)
    return "{" + ",".join(folders) + "}"


def read_logs(
    spark: SparkSession,
    root: str,
    start: datetime | None = None,
    end: datetime | None = None,
    with_corrupt: bool = False,
    years: tuple[int, int] = YEARS,
) -> DataFrame:
    """Scan delivered logs as the contract columns plus year, month, day, hour.

    ``start`` and ``end`` (UTC, both inclusive) choose delivery hours. When both are
    given, only those days' folders are listed, which matters in a bucket with
    millions of objects. ``errors/`` is never read, nor are files of deliveries that are not published. A line
    that is a record is a row, whatever columns are read; ``with_corrupt`` keeps the other lines too, with their text
    in ``_corrupt_record``.
    """
    schema = T.StructType([T.StructField("value", T.StringType()), *PARTITION_FIELDS])
    root = root.rstrip("/")
    if start is not None and end is not None and end < start:
        raise ValueError("end is before start")
    first, last = ("".join(_hour_values(m)) if m is not None else None for m in (start, end))
    tags = [delivery.tag for delivery in within(published(spark, root), first, last)]
    try:
        lines = spark.read.schema(schema).option("basePath", root).text(f"{root}/{_listing(start, end)}").filter(counted(tags))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], schema)
    lines = visible_partitions(lines, years)
    if start is not None:
        lines = lines.filter(_tuple_bound(_hour_values(start), at_least=True))
    if end is not None:
        lines = lines.filter(_tuple_bound(_hour_values(end), at_least=False))
    parsed = _parsed(lines, "value", *PARTITIONS)
    if with_corrupt:
        return _to_contract(parsed, F.when(~_is_record(), F.col("value")).alias(CORRUPT), *PARTITIONS)
    return _to_contract(parsed.filter(_is_record()), *PARTITIONS)


def with_hour_partition(
    logs: DataFrame, moment: Column | None = None, years: tuple[int, int] = YEARS
) -> DataFrame:
    """Add zero-padded year, month, day, hour strings (UTC).

    ``moment`` is the event time unless given. A record without a time inside the years has NULL there.
    """
    if moment is None:
        moment = event_time(F.col("ts_ms"), years)
    forms = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return logs.withColumns({name: F.date_format(moment, form) for name, form in forms.items()})


def append_hours(
    logs: DataFrame, root: str, mode: str = "append", in_time_order: bool = False, file_names: str | None = None
) -> None:
    """Write contract rows that carry their hour partition as gzip JSON lines.

    The rebalance gathers each hour's rows, splits an hour too big for one file and
    merges small ones, all by measured size; without it every task would
    write a file for every hour it meets. Rows that come in time order, each task's in few
    hours, need no such shuffle. ``file_names`` is what names begin with; tasks then place their own files, as such files
    count only when published (see ``deliveries``), and the driver does not go through them at the end.
    """
    wire = _to_wire(logs, *PARTITIONS)
    if not in_time_order:
        wire = wire.hint("rebalance", *PARTITIONS)
    writer = wire.write.mode(mode).partitionBy(*PARTITIONS).option("compression", "gzip")
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if file_names:
        writer = writer.option("mapreduce.output.basename", file_names)
        writer = writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.option("ignoreNullFields", "true").json(root)


def write_errors(
    parsed: DataFrame,
    errors_root: str,
    mode: str = "append",
    moment: Column | None = None,
    years: tuple[int, int] = YEARS,
) -> None:
    error_records(parsed, moment, years).write.mode(mode).option("compression", "gzip").text(errors_root)


def write_logs(
    df: DataFrame,
    root: str,
    errors_root: str | None = None,
    mode: str = "append",
    in_time_order: bool = False,
    years: tuple[int, int] = YEARS,
) -> None:
    """Hourly gzip sink. Rows with ``_corrupt_record``, and rows without a time inside ``years``, go to
    ``errors_root`` as text.

    The input is read once for each of the two sinks. ``mode="overwrite"`` replaces only the hours that occur in
    ``df``. ``in_time_order`` spares a shuffle when each task's rows already lie in few hours. Without
    ``errors_root`` a row that belongs there fails the write.
    """
    if CORRUPT in df.columns and errors_root is None:
        raise ValueError("errors_root is needed for rows with _corrupt_record")
    bad = F.col("hour").isNull() if "hour" in df.columns else refused(df, years=years)
    if errors_root is None:
        good = df.filter(F.when(bad, F.raise_error(F.lit("a record has no time inside the years")).cast("boolean")).otherwise(True))
    else:
        good = df.filter(~bad)
    good = good.drop(CORRUPT)
    append_hours(good if "hour" in good.columns else with_hour_partition(good, years=years), root, mode, in_time_order)
    if errors_root is not None:
        write_errors(df, errors_root, mode, years=years)


def compact_logs(logs: DataFrame, path: str, mode: str = "append") -> None:
    """Convert once to Parquet, sorted by time within a file, for columnar reads.

    Later scans then read only their columns and skip row groups by ``ts_ms``.
    """
    (
        logs.hint("rebalance", *PARTITIONS)
        .sortWithinPartitions(*PARTITIONS, "ts_ms")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def read_compacted(spark: SparkSession, path: str) -> DataFrame:
    """Everything in the copy; what a scan shows was decided when it was made."""
    return spark.read.schema(T.StructType([*CONTRACT.fields, *PARTITION_FIELDS])).parquet(path)


def retain(df: DataFrame, as_of: date | datetime, days: int = 90) -> DataFrame:
    """Keep partitions dated within ``days`` before ``as_of``; decided by partition columns alone."""
    oldest = (as_of.date() if isinstance(as_of, datetime) else as_of) - timedelta(days)
    values = (*oldest.strftime("%Y-%m-%d").split("-"), "00")
    return df.filter(_tuple_bound(values, at_least=True))


def write_retained(spark: SparkSession, path: str, target: str, as_of: date | datetime, days: int = 90) -> None:
    """Copy a compacted log to ``target`` without its expired partitions, which are not even read.

    Dynamic overwrite makes a rerun replace what an interrupted run left.
    """
    compact_logs(retain(read_compacted(spark, path), as_of, days), target, mode="overwrite")


def register_logs(spark: SparkSession, root: str, view: str = "waf_logs") -> DataFrame:
    """Temporary view of the log under its contract names."""
    logs = read_logs(spark, root)
    logs.withColumnRenamed("ts_ms", "timestamp").createOrReplaceTempView(view)
    return logs


def register_log_table(spark: SparkSession, root: str, table: str = "waf_analytics.waf_logs") -> None:
    """External partitioned table over ``root``, unless it exists, with the partitions that stand there now.

    Columns keep the wire spelling that the JSON reader needs; SQL resolves names
    without regard to case, so lower-case queries work. Folders that are no partition,
    such as ``errors``, are not part of the table. Call again to take up new hours.
    """
    database, _, _ = table.rpartition(".")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*WIRE.fields, *PARTITION_FIELDS])
    location = root.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING json "
        f"PARTITIONED BY ({', '.join(PARTITIONS)}) LOCATION '{location}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
