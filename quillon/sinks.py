"""Files that the engine writes besides its tables."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.normalize import extension

# Layout of exported Parquet files.
PARQUET = {"compression": "zstd", "parquet.block.size": str(128 * 1024 * 1024), "parquet.page.size": str(8 * 1024)}


def export(df: DataFrame, path: str, year: Column | None = None) -> None:
    """Write Parquet with the export layout; with ``year`` below folders year=YYYY, replacing only those it has."""
    if year is None:
        df.write.mode("overwrite").options(**PARQUET).parquet(path)
        return
    df.withColumn("year", year).write.mode("overwrite").options(**PARQUET).option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def image_files(assets: DataFrame) -> DataFrame:
    """(name, content) of icons and logos; images without a kind are skipped, unknown kinds get the name null."""
    each = F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).alias("content"), F.col(f"{k}_mime").alias("mime")) for k in ("icon", "logo")])
    x = assets.select("composite_figi", F.inline(each)).where("coalesce(mime, '') <> ''")
    ext = F.when(extension(F.col("mime")) != "unknown", extension(F.col("mime")))
    return x.select(F.concat("composite_figi", F.lit("-"), "k", ext).alias("name"), "content")


def write_files(files: DataFrame, root: str) -> None:
    """Write (name, content) rows as files below ``root``, a folder or bucket that all nodes reach.

    ``root`` is a path or an address that Arrow's file systems know (file, hdfs, s3, gs). A file is written beside its
    place and moved there, so a retried task writes it again and nobody reads half of it; of rows with one name any may
    win. Names may have folders. Rows without name or content are left out.
    """

    def put(rows: Iterator) -> None:
        import posixpath

        from pyarrow import fs as arrow

        fs, folder = arrow.FileSystem.from_uri(root) if "://" in root else (arrow.LocalFileSystem(), root)
        for r in rows:
            goal = posixpath.join(folder, r["name"])
            fs.create_dir(posixpath.dirname(goal), recursive=True)
            staged = posixpath.join(posixpath.dirname(goal), f".{posixpath.basename(goal)}.part")
            with fs.open_output_stream(staged) as out:
                out.write(bytes(r["content"]))
            fs.move(staged, goal)

    files.select("name", F.col("content").cast("binary").alias("content")).where("name is not null and content is not null").foreachPartition(put)


def write_images(assets: DataFrame, root: str) -> None:
    """Write the image files of assets below ``root`` (:func:`write_files`)."""
    write_files(image_files(assets), root)
