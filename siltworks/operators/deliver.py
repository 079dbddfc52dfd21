"""Copying what is kept, checking copies against the manifest, and packing an archive.

A delivery is what people or policies have selected, some files out of very many:
it is copied and packed on the driver, a file at a time. Listing, hashing and
reconciling are distributed.
"""

from __future__ import annotations

import shutil
import tarfile
import warnings
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def files(spark: SparkSession, root: str) -> DataFrame:
    """name, sha256 and bytes of the files in a folder."""
    found = spark.read.format("binaryFile").load(root)
    return found.select(F.regexp_extract("path", r"[^/]+\z", 0).alias("name"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def clear(spark: SparkSession, root: str) -> None:
    """Remove the plain files at the top of a delivery's folder, and nothing else; make the folder if there is none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    for found in fs.listStatus(path):
        if found.isFile():
            fs.delete(found.getPath(), False)


def copy_kept(manifest: DataFrame, root: str) -> int:
    """Copy the manifest's sources into ``root`` under their kept names; how many. Local file systems and mounts.

    A source that is gone is named in a warning and left out. The kept set is what a human or a policy has selected, so names go to the
    driver, never contents.
    """
    target = Path(root.removeprefix("file://"))
    n = 0
    for source, name in manifest.orderBy("scan_ord").select("source", "kept_as").toLocalIterator():
        if not Path(source).is_file():
            warnings.warn(f"source is gone, left out: {source}", stacklevel=2)
            continue
        shutil.copyfile(source, target / name)  # no link: a change to what is kept must not reach the source
        n += 1
    return n


def reconcile(expected: DataFrame, found: DataFrame) -> DataFrame:
    """name and problem (missing, unexpected, differs) where a manifest and a folder disagree. Both have name and sha256."""
    e, f = expected.select("name", F.col("sha256").alias("want")), found.select("name", F.col("sha256").alias("have"))
    both = e.join(f, "name", "full_outer")
    problem = F.when(F.col("have").isNull(), "missing").when(F.col("want").isNull(), "unexpected").when(F.col("have") != F.col("want"), "differs")
    return both.select("name", problem.alias("problem")).where("problem IS NOT NULL")


def same_members(a: DataFrame, b: DataFrame) -> bool:
    """Whether two one-column frames hold the same rows as often."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def archive(folder: str | Path, out: str | Path) -> Path:
    """Pack a local folder as .zip or .tar.gz by the suffix, check it by reading it again, then move it into place."""
    folder, out = Path(folder), Path(out)
    staged = out.with_name(f".{out.name}.part")
    names = sorted(p.relative_to(folder).as_posix() for p in folder.rglob("*") if p.is_file())
    if out.name.endswith(".zip"):
        with zipfile.ZipFile(staged, "w", zipfile.ZIP_DEFLATED) as z:
            for n in names:
                z.write(folder / n, n)
        with zipfile.ZipFile(staged) as z:
            packed, broken = sorted(z.namelist()), z.testzip()
    elif out.name.endswith((".tar.gz", ".tgz")):
        with tarfile.open(staged, "w:gz") as t:
            for n in names:
                t.add(folder / n, n)
        with tarfile.open(staged) as t:
            packed, broken = sorted(t.getnames()), None
    else:
        raise ValueError(f"{out}: the suffix must be .zip or .tar.gz")
    if packed != names or broken:
        staged.unlink()
        raise OSError(f"{out}: the archive does not hold the folder's files")
    staged.replace(out)
    return out
