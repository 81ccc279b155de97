"""Landed JSON without a given schema: types inferred once, kept in a log, nothing lost.

*Schema log.*  A folder (in the checkpoint of the stream) holds numbered versions of the schema.  Each start of a
stream looks at the files that landed since the last look and writes a new version if they hold fields that the
schema lacks, also inside structs.  A field that is known keeps its type for good, so every version reads the files of all
earlier ones.  Names that differ only in case, and names of the columns added here, are not taken up.

*Rescue.*  During a run the schema is fixed.  What does not fit it goes into one string column, ``_rescued_data``: a JSON object of field
name to the text that stood there (numbers with a fraction as Spark writes doubles), for values of another type (the typed column is null), fields that the schema does not
have, and whole nested values of which any part does not fit or is unknown.  It is null where all fits.  A line that is no JSON
object keeps its text in ``_corrupt_record``.  Blank lines are no records.
"""

from __future__ import annotations

import datetime
from typing import Optional

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sqltext import lit
from .files import FILE_METADATA_COLS

CORRUPT, RESCUED = "_corrupt_record", "_rescued_data"
RESERVED = (CORRUPT, RESCUED, *FILE_METADATA_COLS, "processing_time")
_TEXTS = "map<string,string>"


def _grown(known: T.DataType, seen: T.DataType) -> T.DataType:
    """``known`` with the fields that only ``seen`` has; no type changes."""
    if isinstance(known, T.StructType) and isinstance(seen, T.StructType):
        fields, names = [], {f.name.lower() for f in known.fields}
        new = {f.name: f.dataType for f in seen.fields}
        for f in known.fields:
            fields.append(T.StructField(f.name, _grown(f.dataType, new[f.name]) if f.name in new else f.dataType))
        for f in seen.fields:
            if f.name.lower() not in names:
                names.add(f.name.lower())
                fields.append(T.StructField(f.name, _grown(T.StructType(), f.dataType) if isinstance(f.dataType, T.StructType) else f.dataType))
        return T.StructType(fields)
    if isinstance(known, T.ArrayType) and isinstance(seen, T.ArrayType):
        return T.ArrayType(_grown(known.elementType, seen.elementType))
    return known


def grow(known: T.StructType, seen: T.StructType) -> T.StructType:
    """The schema after a look at records with the schema ``seen``."""
    allowed = [f for f in seen.fields if f.name.lower() not in RESERVED]
    return _grown(known, T.StructType(allowed))


class SchemaLog:
    """Numbered versions of a schema in a folder, with the modification time up to which landed files were looked at."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list:
        """All versions, oldest first: rows of ``version``, ``schema`` (JSON), ``upto`` (microseconds)."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            return []
        return self.spark.read.schema("version int, schema string, upto bigint").json(self.path).orderBy("version", "upto").collect()

    def latest(self) -> tuple[int, T.StructType, Optional[int]]:
        """(version, schema, upto) of the last entry; version 0 is an empty schema."""
        import json

        found = self.versions()
        return (found[-1].version, T.StructType.fromJson(json.loads(found[-1].schema)), found[-1].upto) if found else (0, T.StructType(), None)

    def append(self, version: int, schema: T.StructType, upto: Optional[int]) -> None:
        row = self.spark.range(1).select(F.lit(version).alias("version"), F.lit(schema.json()).alias("schema"), F.lit(upto).cast("bigint").alias("upto"))
        row.coalesce(1).write.mode("append").json(self.path)


def evolve_schema(spark: SparkSession, path: str, log: str, hints: Optional[T.StructType] = None, sampling_ratio: float = 1.0) -> T.StructType:
    """Look at the files landed under ``path`` since the last look, and return the schema of this run.

    ``hints`` names types that are wanted whatever the files say (for fields that the log does not have yet).
    ``sampling_ratio`` is the share of lines whose types are looked at; a field missed that way is rescued, not lost.  Only new
    files are read, by distributed inference.
    """
    entries = SchemaLog(spark, log)
    version, known, upto = entries.latest()
    schema = grow(known, hints) if hints is not None else known
    reader = lambda session: session.read.option("recursiveFileLookup", "true")
    options = {}
    if upto is not None:
        # The second of the last look is looked at again: files may have come later in it.
        since = datetime.datetime.fromtimestamp(upto // 1_000_000 - 1, datetime.timezone.utc)
        options = {"modifiedAfter": since.strftime("%Y-%m-%dT%H:%M:%S"), "timeZone": "UTC"}
    (seen,) = reader(spark).options(**options).text(path).agg(F.unix_micros(F.max("_metadata.file_modification_time"))).first()
    if seen is not None:
        session = spark.newSession()                     # names that differ in case only are told apart here
        session.conf.set("spark.sql.caseSensitive", "true")
        found = reader(session).options(**options).option("samplingRatio", sampling_ratio).option("columnNameOfCorruptRecord", CORRUPT).json(path).schema
        schema = grow(schema, found)
    if not schema.fields:
        raise ValueError("no record has landed yet, and no hints are given")
    if schema != known:
        entries.append(version + 1, schema, seen if seen is not None else upto)
    elif seen is not None and seen != upto:
        entries.append(version, schema, seen)
    return schema


def _unknown(raw: str, dtype: T.DataType, depth: int = 0) -> Optional[str]:
    """SQL: the JSON text ``raw`` has a field, at any depth, that the type lacks (None: it cannot)."""
    name, each = f"f{depth}", f"e{depth}"
    if isinstance(dtype, T.StructType):
        listed = ", ".join(lit(f.name) for f in dtype.fields) or "''"
        inner = [_unknown(f"{name}[{lit(f.name)}]", f.dataType, depth + 1) for f in dtype.fields]
        tests = [f"exists(map_keys({name}), k -> k not in ({listed}))", *filter(None, inner)]
        return f"coalesce(transform(array(from_json({raw}, '{_TEXTS}')), {name} -> {' or '.join(f'coalesce({t}, false)' for t in tests)})[0], false)"
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        inner = _unknown(each, dtype.elementType if isinstance(dtype, T.ArrayType) else dtype.valueType, depth + 1)
        values = f"from_json({raw}, 'array<string>')" if isinstance(dtype, T.ArrayType) else f"map_values(from_json({raw}, '{_TEXTS}'))"
        return inner and f"coalesce(exists({values}, {each} -> {inner}), false)"
    return None


def _fields(line: Column, schema: T.StructType) -> list[Column]:
    """Typed fields of a JSON line ``_typed`` / ``_texts``, the rescued rest, the line if it is no record."""
    bad = F.col("_typed").getField(CORRUPT).isNotNull()
    tests = []
    for f in schema.fields:
        value = F.col("_typed").getField(f.name)
        at = F.col("_texts").getItem(f.name)
        misfit = value.isNull() & at.isNotNull()
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            alone = F.from_json(F.concat(F.lit('{"v":'), at, F.lit("}")), T.StructType([T.StructField("v", f.dataType), T.StructField(CORRUPT, T.StringType())]),
                                {"columnNameOfCorruptRecord": CORRUPT})
            misfit = misfit | (bad & alone.getField(CORRUPT).isNotNull())
            lost = _unknown(f"_texts[{lit(f.name)}]", f.dataType)
            misfit = misfit | F.expr(lost) if lost else misfit
        tests.append(F.when(misfit, F.lit(f.name)))
    names = F.array(*[F.lit(f.name) for f in schema.fields])
    misfits = F.array_compact(F.array(*tests))
    rest = F.map_filter("_texts", lambda k, v: F.array_contains(misfits, k) | (~F.array_contains(names, k) & v.isNotNull()))
    return [
        *[F.col("_typed").getField(f.name).alias(f.name) for f in schema.fields],
        F.when(F.size(rest) > 0, F.to_json(rest)).alias(RESCUED),
        F.when(F.col("_texts").isNull(), line).alias(CORRUPT),
    ]


def parse_json_lines(lines: DataFrame, schema: T.StructType, column: str = "value", keep: tuple = ()) -> DataFrame:
    """JSON lines as the fields of ``schema``, ``_rescued_data`` and ``_corrupt_record``, after the columns ``keep``.

    Batch or stream; one projection, no shuffle.
    """
    line = F.col(column)
    typed = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    read = lines.where(F.length(F.trim(line)) > 0).select(
        *keep, line, F.from_json(line, _TEXTS).alias("_texts"), F.from_json(line, typed, {"columnNameOfCorruptRecord": CORRUPT}).alias("_typed"))
    return read.select(*_fields(line, schema), *keep)


def ingest_json_evolving(spark: SparkSession, path: str, log: str, hints: Optional[T.StructType] = None,
                         max_files: Optional[int] = None, sampling_ratio: float = 1.0) -> DataFrame:
    """JSON directory as a stream with the schema of :func:`evolve_schema`, the rescued rest, file lineage and ``processing_time``.

    Stateless and narrow: a query on it may be restarted from its checkpoint with a grown schema.
    """
    schema = evolve_schema(spark, path, log, hints, sampling_ratio)
    reader = spark.readStream.option("maxFilesPerTrigger", int(max_files)) if max_files else spark.readStream
    lines = reader.text(path).select("value", "_metadata.*")
    return parse_json_lines(lines, schema, keep=FILE_METADATA_COLS).withColumn("processing_time", F.current_timestamp())


def read_evolved(spark: SparkSession, path: str, log: str) -> DataFrame:
    """A hop written from :func:`ingest_json_evolving`, in the last logged schema; fields that a file lacks are null."""
    extra = T.StructType.fromDDL(
        f"{RESCUED} string, {CORRUPT} string, file_path string, file_name string, file_size bigint, file_block_start bigint, "
        "file_block_length bigint, file_modification_time timestamp, processing_time timestamp")
    return spark.read.schema(T.StructType([*SchemaLog(spark, log).latest()[1].fields, *extra.fields])).parquet(path)
