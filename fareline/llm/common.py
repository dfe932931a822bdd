"""Helpers shared by the text operators: columns, word splitting, written tables."""

from __future__ import annotations

import ctypes
import functools
import gc
import re

import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, remove_path, scratch_path

# ASCII white space: space and the control characters tab .. carriage return.
SPACE = "\\x20\\x09-\\x0D"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole_text(text: Column) -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Array of the maximal runs without ASCII white space (empty for an empty text)."""
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{SPACE}]+")).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: a one-element ``transform``
    binds it, so that a lambda further in does not compute it per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that do not clash with columns of ``df``."""
    have, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in have:
            n = "_" + n
        have.add(n.lower())
        out.append(n)
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a new folder under ``spark.checkpoint.dir`` and
    read it again: cuts the lineage, and the files outlive lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def by_merge(df: DataFrame) -> DataFrame:
    """``df`` as one side of a join that shuffles and merges at every size. For sides that grow with the input: Spark sizes a table by
    its compressed files and not by what an explode makes of a row, so that it would broadcast what the driver cannot hold."""
    return df.hint("merge")


def forget(*dfs: DataFrame) -> None:
    """Remove the folders of ``written`` tables that nothing reads any more."""
    for df in dfs:
        remove_path(df.sparkSession, df._written_path)


def arrow_batches(spark: SparkSession, rows: int = 512) -> None:
    """Small Arrow batches: texts can be long and a batch is held in memory."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def splitter(pattern: str):
    """text -> the matches of ``pattern`` in it. A text of ASCII characters goes to the standard library's faster
    matcher, by the same pattern with its classes of letters, numbers and white space written out for ASCII."""
    general = regex.compile(pattern).findall
    classes = (("\\p{L}", "A-Za-z"), ("\\p{N}", "0-9"), ("\\s", "\\t-\\r "))

    def inside(m: re.Match) -> str:
        return functools.reduce(lambda t, c: t.replace(*c), classes, m.group())

    plain = re.sub(r"\[[^\]]*\]", inside, pattern)
    outside = {"\\p{L}": "[A-Za-z]", "\\p{N}": "[0-9]", "\\s": "[\\t-\\r ]", "\\S": "[^\\t-\\r ]"}
    plain = functools.reduce(lambda t, c: t.replace(*c), outside.items(), plain)
    if re.search(r"\\[^tr]", plain):
        return general          # something else than these classes
    ascii_only = re.compile(plain).findall
    return lambda text: ascii_only(text) if text.isascii() else general(text)


_HELD: list = [None, None]


def release() -> None:
    """For functions without tables of their own: what this worker holds for another operator goes."""
    held(None, lambda: None)


def held(key, make):
    """``make()``, kept in this Python worker until another key is asked for. One
    model or codec at a time: a worker serves every operator of a session, and
    their tables must not add up, so what the last one took goes back to the system."""
    if _HELD[0] != key:
        _HELD[:] = [None, None]
        gc.collect()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # where the C library has it
        if trim is not None:
            trim(0)
        _HELD[:] = [key, make()]
    return _HELD[1]
