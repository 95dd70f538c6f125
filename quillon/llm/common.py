"""Helpers that several operators share: shared storage, word patterns, bounded broadcasts."""

from __future__ import annotations

import ctypes
import gc
import uuid
import weakref
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as the contracts define it.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Only a local session, whose executors are one process, may do without one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "/tmp/checkpoints"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Folders that stored() has written and nothing has deleted yet, with their application; and the tables read from them.
_WRITTEN: dict[str, str] = {}
_FOLDER: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage, survives lost executors."""
    return stored_parts([df], name)


def stored_parts(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """Write tables of one schema, one after the other as they come, and read them back as one."""
    path, schema = "", None
    for df in parts:
        spark, schema = df.sparkSession, schema or df.schema
        if not path:
            path = shared_path(spark, name)
            _WRITTEN[path] = spark.sparkContext.applicationId
        df.write.mode("append").parquet(path)
    out = spark.read.schema(schema).parquet(path)
    _FOLDER[out] = path
    return out


def _folders(df: DataFrame) -> set[str]:
    """What stored() wrote of all that df reads."""
    if df in _FOLDER:
        return {_FOLDER[df]}
    read = {x.rsplit("/", 1)[0] for x in df.inputFiles()}
    return {p for p in _WRITTEN if any(f.endswith(p.split("://", 1)[-1]) for f in read)}


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    _WRITTEN.pop(path, None)


def unstore(df: DataFrame) -> None:
    """Delete what stored() wrote, once nothing reads it any more."""
    for path in _folders(df):
        drop_path(df.sparkSession, path)


def written() -> set[str]:
    """Marks what is stored now, for sweep()."""
    return {*_WRITTEN}


def sweep(spark: SparkSession, before: set[str] = frozenset(), keep: DataFrame | None = None) -> None:
    """Delete all that was stored since a mark, but what keep reads.

    Operators return plans that read what they stored, so their callers sweep once the result is written elsewhere."""
    kept = _folders(keep) if keep is not None else set()
    own = spark.sparkContext.applicationId
    for path in [p for p, app in _WRITTEN.items() if app == own and p not in before and p not in kept]:
        drop_path(spark, path)


def shielded(docs: DataFrame, *needed: str) -> tuple[DataFrame, dict[str, str]]:
    """docs with every column but the needed ones under a name that no operator uses, and the names to restore.

    So no column of a caller can clash with those an operator works with, whatever it is called."""
    hidden = {f"_x{i}": c for i, c in enumerate(docs.columns) if c not in needed}
    return docs.toDF(*[c if c in needed else f"_x{i}" for i, c in enumerate(docs.columns)]), hidden


def unshielded(out: DataFrame, hidden: dict[str, str]) -> DataFrame:
    """The callers' names again. A column that bears the name of one the operator adds is replaced by it."""
    own = {c.lower() for c in out.columns if c not in hidden}
    kept = [c for c in out.columns if c not in hidden or hidden[c].lower() not in own]
    return out.select(*kept).toDF(*[hidden.get(c, c) for c in kept])


def release(spark: SparkSession) -> None:
    """Let the driver forget finished plans, so that their shuffle files are deleted before more are written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def hand_back() -> None:
    """Let a Python worker return what a task no longer needs: idle workers stay, and their memory counts."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def words_of(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def join_small(big: DataFrame, small: DataFrame, on: list[str], most_rows: int = 20_000, how: str = "inner", salts: int = 32) -> DataFrame:
    """Join a table that may have hot keys with a table of one row a key.

    The small side is broadcast only after its rows were counted; beyond most_rows both sides are salted, so that
    no key's rows meet in one task."""
    if small.count() <= most_rows:
        return big.join(F.broadcast(small), on, how)
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    own = big.withColumn("_salt", F.pmod(F.xxhash64(*big.columns), F.lit(salts)).cast("int"))
    return own.join(salted, [*on, "_salt"], how).drop("_salt")


#: A key is hot if it holds more than one in HOT_PARTS of all rows, and more than HOT_ROWS: fewer than HOT_PARTS keys are.
HOT_PARTS, HOT_ROWS = 4096, 64


def hot_of(counts: DataFrame, on: str, n: str) -> DataFrame:
    """The hot keys of counted ones: fewer than HOT_PARTS, whatever the input. counts is read twice."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    return counts.filter(F.col(n) > max(HOT_ROWS, total // HOT_PARTS)).select(on)


def hot_keys(big: DataFrame, on: str) -> DataFrame:
    return hot_of(big.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("_n")), on, "_n")


def join_hot(big: DataFrame, small: DataFrame, on: str, how: str = "inner", hot: DataFrame | None = None) -> DataFrame:
    """Join a table that may have hot keys with one of a row a key; how: inner or left.

    The rows of hot keys meet theirs by broadcast (fewer than HOT_PARTS rows), all others by shuffling. Both sides are
    read twice and should be stored."""
    hot = stored(hot_keys(big, on), "hot") if hot is None else hot
    if not hot.limit(1).count():
        return big.join(small, on, how)
    few = F.broadcast(hot)
    cold = big.join(few, on, "left_anti").join(small, on, how)
    warm = big.join(few, on, "left_semi").join(F.broadcast(small.join(few, on, "left_semi")), on, how)
    return cold.unionByName(warm)
