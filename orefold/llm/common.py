"""Helpers shared by the text operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Sequence
from functools import wraps
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.session import delete_path, free_shuffles, work_dir

#: A word is a run of characters other than the six ASCII white-space characters (fixed value).
WORD = r"[^\x20\x09-\x0D]+"
#: Columns of the table ``documents``.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns and no others, so that extra columns cannot clash with an operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def own_columns(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For functions that return the columns of the documents they get: columns beside those of the table
    ``documents`` have other names meanwhile, so theirs may clash with any name inside, or hold dots."""
    @wraps(stage)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        names = docs.columns
        hidden = [c if c in DOCUMENT else f"__own_{k}" for k, c in enumerate(names)]
        found = stage(docs.toDF(*hidden), *args, **options)
        return found.select(*[F.col(c) for c in hidden]).toDF(*names)
    return run


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: it is computed once and outlives executors."""
    path = work_dir(df.sparkSession, purpose)
    free_shuffles(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    free_shuffles(df.sparkSession)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[stored] = path
    return stored


def discard(*tables: DataFrame) -> None:
    """Deletes tables as ``materialise`` returned them. Only for those that no result, and no step to come, reads."""
    for table in tables:
        delete_path(table.sparkSession, _FOLDERS.pop(table))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_copy_key(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``text_key``, a digest that equal texts share (null counts as empty)."""
    return df.withColumn("text_key", F.unhex(F.sha2(whole_text(text), 256)))


def field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, True)


def schema(**kinds: T.DataType) -> T.StructType:
    return T.StructType([field(n, k) for n, k in kinds.items()])


def check_columns(df: DataFrame, wanted: Sequence[str]) -> None:
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


#: Byte -> itself for digits, small letters and bytes beyond ASCII, the small letter for A-Z, else a blank.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def lower_words(text: bytes) -> list[bytes]:
    """Maximal runs of digits, letters and characters beyond ASCII in UTF-8, with A-Z (only) in lower case."""
    return text.translate(WORD_BYTES).split()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each application, so that their workers can import it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(), f"orefold-{context.applicationId}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(archive)  # the driver serves its copy
    _SHIPPED.add(context.applicationId)


def arrow_map(df: DataFrame, function: Callable, result) -> DataFrame:
    """``mapInArrow`` with functions of this package, for any column names."""
    ship(df.sparkSession)
    names = df.columns
    if not any("." in n or "`" in n for n in names):
        return df.mapInArrow(function, result)

    def renamed(batches):
        return function(batch.rename_columns(names) for batch in batches)

    return df.toDF(*[f"column_{k}" for k in range(len(names))]).mapInArrow(renamed, result)
