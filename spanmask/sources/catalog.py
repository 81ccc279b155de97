"""Table inventory across catalogs."""

from __future__ import annotations

import json
from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INVENTORY_TYPE = T.StructType(
    [
        T.StructField("table_catalog", T.StringType()),
        T.StructField("table_schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("table_type", T.StringType()),
        T.StructField("created", T.TimestampType()),
        T.StructField("last_altered", T.TimestampType()),
    ]
)


def _created(spark: SparkSession, qualified: str):
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {qualified} AS JSON").first()[0]).get("created_time")


def list_tables(spark: SparkSession, catalogs: Optional[Sequence[str]] = None, created: bool = True) -> DataFrame:
    """``table_catalog, table_schema, table_name, table_type, created, last_altered``.

    Lists every schema of each catalog (default: the current one) plus the
    session's temporary views; VIEW for views and temp views, TABLE for
    everything else; sorted by catalog, schema, name.  The current catalog
    is restored afterwards.  An empty list of catalogs gives no rows.
    The listing is catalog metadata, gathered on the driver; ``created`` costs one call
    for each table and can be left out (null).
    """
    cat = spark.catalog
    current = cat.currentCatalog()
    names = [current] if catalogs is None else list(catalogs)
    rows = []
    try:
        for c in names:
            cat.setCurrentCatalog(c)
            seen = set()
            for db in cat.listDatabases():
                for t in cat.listTables(db.name):
                    schema = db.name if not t.isTemporary else (t.namespace[0] if t.namespace else "")
                    key = (schema, t.name)
                    if key in seen:
                        continue
                    seen.add(key)
                    kind = "VIEW" if (t.isTemporary or (t.tableType or "").upper() == "VIEW") else "TABLE"
                    when = _created(spark, f"`{c}`.`{db.name}`.`{t.name}`") if created and kind == "TABLE" else None
                    rows.append((c, schema, t.name, kind, when, None))
    finally:
        cat.setCurrentCatalog(current)
    df = spark.createDataFrame(
        [(r[0], r[1], r[2], r[3], r[4], r[5]) for r in rows],
        "table_catalog string, table_schema string, table_name string, table_type string, "
        "created string, last_altered string",
    )
    return df.select(
        "table_catalog", "table_schema", "table_name", "table_type",
        F.to_timestamp("created").alias("created"), F.col("last_altered").cast("timestamp").alias("last_altered"),
    ).orderBy(F.col("table_catalog").asc(), F.col("table_schema").asc(), F.col("table_name").asc())
