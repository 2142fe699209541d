"""What the library asks of a session: a shared folder, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows and bytes that a side sent whole to every executor may hold.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
# Copies of the small side in a salted join.
SALT = 32

_own_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.

    The setting ``spark.checkpoint.dir`` comes first, then a folder set on the context.
    Only a session on one machine gets a new local folder if neither is set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = "file:" + tempfile.mkdtemp(prefix="rankspark-")
    return _own_folder[app]


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/rankspark/{label}-{uuid.uuid4().hex}"


def _width(field: T.StructField) -> Column:
    """Bytes of a column's value: counted for what may be long, by the type for the rest."""
    name, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(name), F.lit(0)) + 8
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
        return F.greatest(F.size(name), F.lit(0)) * 8 + 16
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.octet_length(F.to_json(F.struct(name))) + 16
    return F.lit(8)


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True if ``df`` has at most ``max_rows`` rows and about ``BROADCAST_BYTES`` bytes.

    Both are counted by task; no rows are moved.
    """
    width = sum((_width(f).cast("long") for f in df.schema.fields), F.lit(0).cast("long"))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= BROADCAST_BYTES


def keep(df: DataFrame, label: str) -> DataFrame:
    """Writes an intermediate result to the shared folder and reads it back.

    For results that several later steps use: they are computed once, the
    lineage is cut, and a lost executor costs only a re-read.
    """
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    spread: str | None = None,
    small_fits: bool | None = None,
) -> DataFrame:
    """Inner join of a large side with a side that is usually small.

    A small side of at most ``BROADCAST_ROWS`` rows is broadcast, so the large
    side does not move and keeps its layout.  Beyond that both sides are
    shuffled on the keys.  Where a key may hold a large share of the rows,
    ``spread`` names a column of the large side that splits it: its hash gives
    a salt, and the small side is copied ``SALT`` times.  Pass ``small_fits``
    where the answer is already known.
    """
    if fits(small) if small_fits is None else small_fits:
        return big.join(F.broadcast(small), on)
    if spread is None:
        return big.join(small, on)
    salted = big.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(SALT)).cast("int"))
    copies = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return salted.join(copies, [*on, "salt"]).drop("salt")
