"""Catalog scans and normalization.

Parquet is the catalog format at rest; CSV is accepted at the edges. A CSV
without a given schema is read as text (no ``inferSchema`` pass over the data)
and then coerced by :func:`normalize`, which is lenient the same way as a
single-process loader: unparseable numbers and times become null, missing
required columns are added as typed nulls, extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.config import CATALOG_SCHEMA
from tremor.functions.numeric import to_double
from tremor.functions.time import to_utc_time
from tremor.sources.csv_files import BrokenCsvError, read_csv_text

_NUMERIC = ("latitude", "longitude", "depth", "mag")


def normalize(df: DataFrame, schema: T.StructType = CATALOG_SCHEMA) -> DataFrame:
    """Coerce the required columns to ``schema``'s types in one projection.

    * numbers: ``try_cast`` to double, NaN → null;
    * ``time``: text/zoned/date → UTC TIMESTAMP_NTZ, unparseable → null;
    * strings: cast to string;
    * missing required columns: appended as typed nulls;
    * other columns: kept as they are, in place.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    updates = {}
    for field in schema.fields:
        name = field.name
        if name not in present:
            updates[name] = F.lit(None).cast(field.dataType)
        elif name == "time":
            updates[name] = to_utc_time(F.col(name), present[name])
        elif name in _NUMERIC:
            updates[name] = to_double(F.col(name), present[name])
        elif isinstance(field.dataType, T.StringType) and not isinstance(present[name], T.StringType):
            updates[name] = F.col(name).cast("string")
    return df.withColumns(updates) if updates else df


def read_catalog(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None,
                 multi_line: bool | None = None) -> DataFrame:
    """Read a catalog and normalize it.

    ``fmt='csv'``: header CSV with quoted fields; a doubled quote inside one is
    a quote. With ``schema`` the columns are read as given; without it every
    column is read as text and typed by :func:`normalize`, which avoids a
    separate inference scan and never guesses a type. Short rows are kept
    (``PERMISSIVE``) with nulls in the missing fields; an empty field, quoted or
    not, is null.

    Files of one folder or glob may have different headers: each is read by its
    own, and they are united by column name. ``multi_line`` says how quoted line
    breaks are met, see :func:`tremor.sources.csv_files.read_csv_text`; by
    default files without any are read in splits, however large.
    """
    if fmt == "parquet":
        reader = spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return normalize(reader.parquet(path))
    if fmt == "csv":
        return normalize(read_csv_text(spark, path, multi_line, schema))
    raise ValueError(f"unsupported catalog format {fmt!r}")


__all__ = ["BrokenCsvError", "normalize", "read_catalog"]
