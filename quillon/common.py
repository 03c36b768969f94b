"""Small helpers shared by the operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Prefix of every column an operator makes for itself; inputs must not use it.
PRIVATE = "__q_"

#: White space that counts as an outer blank of a key.
BLANKS = " \t\r\n\u00a0\u2007\u202f"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the test-data layout."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trimmed(c: Column) -> Column:
    """Without outer blanks; an empty text becomes null."""
    return F.nullif(F.btrim(c, F.lit(BLANKS)), F.lit(""))


def clean_key(c: Column) -> Column:
    """Canonical form of an identifier: trimmed, upper case, empty is null."""
    return F.upper(trimmed(c))


def squeezed(c: Column) -> Column:
    """Lower case, inner blanks single, outer blanks gone, empty is null."""
    return F.nullif(F.lower(F.btrim(F.regexp_replace(c, r"[\s\u00a0\u2007\u202f]+", " "))), F.lit(""))


def free_name(df_columns: list[str], wanted: str) -> str:
    """``wanted``, with underscores added until no input column has that name (case ignored)."""
    taken = {c.lower() for c in df_columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else unchanged.

    The count stops one row beyond the bound, so the check itself stays cheap on a large table; a
    larger table is then joined by shuffle.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def shared_folder(spark: SparkSession) -> str:
    """The folder that all nodes see: spark.checkpoint.dir, else the checkpoint folder that the session has.

    Where neither is set, a local session gets a folder of its own; on a cluster that is an error, since the executors
    would write to their own disks.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
    sc._quillon_folder = getattr(sc, "_quillon_folder", None) or tempfile.mkdtemp(prefix="quillon-")
    return sc._quillon_folder


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: survives the loss of executors."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path for staged files in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application.

    Operators that run Python need it there; where it is installed on all nodes this changes nothing.
    """
    sc = spark.sparkContext
    if getattr(sc, "_quillon_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="quillon-ship-")) / "quillon.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))  # the driver serves the file to every executor
    sc._quillon_shipped = True
