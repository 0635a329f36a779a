"""ST1/ST3/ST5/S1/S6: landing files -> bronze and quarantine, by one file stream that loses nothing.

The file source remembers processed files in its checkpoint, so a restarted or re-triggered query (``availableNow``)
only reads new files. One query reads the landing folder and writes two sinks in ``foreachBatch``, each under the
micro-batch's id (``epoch``): a replayed micro-batch overwrites what it wrote before, and ``clean_source`` may remove files,
as nobody else still has to read them.

Records are parsed to VARIANT. Malformed ones go to the quarantine. Fields that the schema doesn't name, and values of
another type than it names, are kept in the ``_rescued`` column. Fields that come up in a micro-batch with one scalar
type become columns of bronze (a stored schema that only grows, :func:`grown`); values that don't fit their
column stay in ``_rescued``. Rows with rescued values that bronze would drop go to the quarantine whole.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import BRONZE_DROP_EXPECTATIONS, expect_or_drop, expectations
from ..operators.quality import observe_expectations
from ..operators.upsert import read_table
from ..schemas import BRONZE_BARS_SCHEMA, RAW_BAR_SCHEMA
from ..sources.landing import BATCH_FROM_FILE, to_bronze

CORRUPT, RESCUED, RAW, EPOCH = "_corrupt_record", "_rescued", "_raw_record", "epoch"
NEW_COLUMNS = 100       # fields that a micro-batch may turn into columns; more of them stay in _rescued

#: Column type -> the types of JSON values that it takes without loss.
TAKES = {"string": ("STRING",), "bigint": ("BIGINT",), "double": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "boolean": ("BOOLEAN",)}


def _json_type(value: Column) -> Column:
    """BIGINT, DECIMAL, STRING, ... of a VARIANT, without precision."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _fits(name: Column, value: Column, columns: dict[str, str]) -> Column:
    """Whether a field goes into its column as it is (JSON null goes into any)."""
    fits = F.lit(False)
    for kind, json_types in TAKES.items():
        named = [c for c, k in columns.items() if k == kind]
        if named:
            fits = fits | (name.isin(named) & (F.is_variant_null(value) | _json_type(value).isin(*json_types)))
    return fits


def _taken(fields: Column, columns: dict[str, str]) -> tuple[list[Column], Column]:
    """From a map of fields: the typed columns, and the fields left over as a VARIANT (null if none is)."""
    typed = []
    for name, kind in columns.items():
        value = F.try_element_at(fields, F.lit(name))
        typed.append(F.when(_fits(F.lit(name), value, {name: kind}), F.try_variant_get(value, "$", kind)).alias(name))
    left = F.map_filter(fields, lambda k, v: ~_fits(k, v, columns))
    return typed, F.when(F.size(left) > 0, F.to_variant_object(left)).alias(RESCUED)


def _fields(variant: Column) -> Column:
    return F.try_variant_get(variant, "$", "map<string,variant>")


def parsed(text: DataFrame, array_files: bool = False) -> DataFrame:
    """Landing text (value, _metadata) as raw bars: their fields, batch_id, _rescued, _corrupt_record and _raw_record.

    ``_raw_record`` is the record's text, but null where nothing was rescued.
    """
    path = F.col("_metadata.file_path")
    batch = F.regexp_extract(path, BATCH_FROM_FILE if array_files else r"batch_id=([^/]*)/", 1)
    batch = F.when(batch != "__HIVE_DEFAULT_PARTITION__", batch)
    rows = text.select("value", batch.alias("batch_id")).filter(F.trim("value") != "")
    whole = F.try_parse_json("value")
    if array_files:
        each = F.coalesce(F.try_variant_get(whole, "$", "array<variant>"), F.array(whole))
        rows = rows.select("batch_id", F.explode(each).alias("v"), "value")
        rows = rows.select("batch_id", "v", F.coalesce(F.to_json("v"), F.col("value")).alias("value"))
    else:
        rows = rows.select("batch_id", whole.alias("v"), "value")
    rows = rows.select("batch_id", "value", _fields(F.col("v")).alias("fields"))
    typed, rescued = _taken(F.col("fields"), {f.name: f.dataType.simpleString() for f in RAW_BAR_SCHEMA.fields})
    rows = rows.select(*typed, "batch_id", rescued, F.when(F.col("fields").isNull(), F.col("value")).alias(CORRUPT), "value")
    return rows.withColumn(RAW, F.when(F.col(RESCUED).isNotNull(), F.col("value"))).drop("value")


def read_bars_stream(spark: SparkSession, path: str, array_files: bool = False,
                     max_files_per_trigger: int | None = None, max_bytes_per_trigger: str | None = None,
                     clean_source: str | None = None, archive_dir: str | None = None) -> DataFrame:
    """Incremental discovery of landing files, as :func:`parsed` rows.

    ``array_files=True``: external pretty-printed ``bars_YYYYMMDD.json`` array files (read whole; batch id from the file
    name). Otherwise the ``batch_id=YYYYMMDD/`` JSON-lines layout written by ``write_landing``; the
    partition value fills ``batch_id``. ``max_files_per_trigger`` / ``max_bytes_per_trigger`` bound a micro-batch;
    ``clean_source`` archives or deletes files once their batch is committed (one query a landing folder).
    """
    # text() would set wholetext back; with its type stated a batch id needn't look like those before it
    r = spark.readStream.format("text").schema("value string" if array_files else "value string, batch_id string")
    if array_files:
        r = r.option("wholetext", True).option("pathGlobFilter", "bars_*.json")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if clean_source:
        # "archive" (to archive_dir) or "delete": keeps the landing listing and the
        # source's seen-files log from growing with every file ever ingested
        r = r.option("cleanSource", clean_source)
        if archive_dir:
            r = r.option("sourceArchiveDir", archive_dir)
    return parsed(r.load(path), array_files)


def bronze_from_stream(raw: DataFrame, ingestion_ts=None) -> tuple[DataFrame, DataFrame]:
    """P4 + P7 on raw bars: ``(bronze_rows, quarantined_rows)``; bronze rows carry ``_rescued``."""
    good = raw.filter(F.col(CORRUPT).isNull())
    rescued = F.struct(RESCUED, RAW)
    bronze = to_bronze(good, ingestion_ts, batch_col=F.col("batch_id"), carried={"_r": rescued})
    drop = expectations(BRONZE_DROP_EXPECTATIONS)
    fails = reduce(or_, [~F.coalesce(met, F.lit(False)) for met in drop.values()])
    lost = bronze.filter(fails & F.col(f"_r.{RESCUED}").isNotNull())
    now = F.current_timestamp().cast("timestamp_ntz").alias("quarantined_at")
    bad = raw.filter(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("raw_record"), F.col("batch_id").alias("source"), "symbol", now)
    bad = bad.unionByName(lost.select(F.col(f"_r.{RAW}").alias("raw_record"), F.col("batch_id").alias("source"), "symbol", now))
    kept = expect_or_drop(bronze, drop)
    return kept.select(*BRONZE_BARS_SCHEMA.names, F.col(f"_r.{RESCUED}").alias(RESCUED)), bad


# ---------------------------------------------------------------- a schema that only grows
def stored_schema(spark: SparkSession, path: str, before: int | None = None) -> dict[str, str]:
    """The columns that bronze at ``path`` has grown (name -> type), or had before an epoch, oldest first."""
    found = read_table(spark, f"{path.rstrip('/')}/_schema")
    if found is None:
        return {}
    if before is not None:
        found = found.filter(F.col(EPOCH) < before)
    return {r.name: r.type for r in found.orderBy(EPOCH, "name").collect()}      # a row per grown column


def grown(spark: SparkSession, bronze: DataFrame, path: str, epoch: int) -> dict[str, str]:
    """The stored schema with the new fields of a micro-batch that have one scalar type in it.

    A field's type is ``schema_of_variant_agg`` over its values; whole numbers become bigint, other numbers double. Names
    that differ from a column's in case only, or that a path can't hold, stay in ``_rescued``.
    """
    known = stored_schema(spark, path, before=epoch)
    taken = {c.lower() for c in [*BRONZE_BARS_SCHEMA.names, *known, RESCUED, EPOCH, CORRUPT, RAW]}
    fields = bronze.filter(F.col(RESCUED).isNotNull()).select(F.explode(_fields(F.col(RESCUED))).alias("name", "value"))
    new = fields.filter(~F.lower("name").isin(*taken) & F.col("name").rlike(r"^[^'\"\\\\=/]+$") & ~F.is_variant_null("value"))
    new = new.groupBy("name").agg(F.regexp_extract(F.schema_of_variant_agg("value"), "^[A-Z]+", 0).alias("json"))
    found = new.orderBy("name").limit(NEW_COLUMNS).collect()
    more, names = {}, set()
    for r in found:
        kind = next((k for k in ("bigint", "string", "boolean", "double") if r.json in TAKES[k]), None)
        if kind and r.name.lower() not in names:
            names.add(r.name.lower())
            more[r.name] = kind
    if more:
        rows = spark.createDataFrame([(n, k, epoch) for n, k in more.items()], f"name string, type string, {EPOCH} int")
        _put(rows.coalesce(1), f"{path.rstrip('/')}/_schema")
    return known | more


def evolved(bronze: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``bronze`` with grown columns, taken out of ``_rescued``."""
    if not columns:
        return bronze
    typed, rescued = _taken(_fields(F.col(RESCUED)), columns)
    return bronze.select(*BRONZE_BARS_SCHEMA.names, *typed, rescued)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The bronze table with all columns that it has grown; rows of before have nulls there (no footers are merged)."""
    schema = T.StructType([*BRONZE_BARS_SCHEMA.fields])
    for name, kind in stored_schema(spark, path).items():
        schema = schema.add(name, {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}.get(kind, T.StringType()))
    return spark.read.schema(schema.add(RESCUED, T.VariantType()).add(EPOCH, T.IntegerType())).parquet(path)


def _put(rows: DataFrame, path: str) -> None:
    """Write an epoch's rows in place of what a first try of it may have left."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(EPOCH).parquet(path))


def write_epoch(bronze: DataFrame, bad: DataFrame, bronze_path: str, quarantine_path: str, epoch: int) -> None:
    """Both sinks of a micro-batch, the same if it is replayed."""
    columns = grown(bronze.sparkSession, bronze, bronze_path, epoch)
    number = F.lit(epoch).cast("int")
    _put(bad.withColumn(EPOCH, number), quarantine_path)
    _put(evolved(bronze, columns).withColumn(EPOCH, number), bronze_path)


def _trigger(writer, trigger: str | None):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger:
        return writer.trigger(processingTime=trigger)
    return writer          # ST2: continuous micro-batches, as soon as the previous one ends


def start_bronze_stream(spark: SparkSession, landing: str, bronze_path: str, checkpoint: str,
                        trigger: str | None = "availableNow", ingestion_ts=None,
                        array_files: bool = False, quarantine_path: str | None = None,
                        **limits) -> list[StreamingQuery]:
    """ST1/S6: append the landing stream to a parquet bronze table and a quarantine (default: beside bronze).

    One query, whatever the number of sinks. ``limits`` are those of ``read_bars_stream`` and bound a micro-batch. Each one's
    expectation counts are observed as ``landing_expectations`` (see :mod:`.expectations`).
    """
    quarantine = quarantine_path or f"{bronze_path.rstrip('/')}_quarantine"

    def sinks(rows: DataFrame, epoch: int) -> None:
        rows.persist()      # read and parsed once
        try:
            write_epoch(*bronze_from_stream(rows, ingestion_ts), bronze_path, quarantine, epoch)
        finally:
            rows.unpersist()

    raw, _ = observe_expectations(read_bars_stream(spark, landing, array_files, **limits), "landing_expectations",
                                  {"well_formed": f"{CORRUPT} IS NULL", "nothing_rescued": f"{RESCUED} IS NULL",
                                   **BRONZE_DROP_EXPECTATIONS})
    writer = raw.writeStream.option("checkpointLocation", f"{checkpoint}/bronze").foreachBatch(sinks)
    return [_trigger(writer, trigger).start()]
