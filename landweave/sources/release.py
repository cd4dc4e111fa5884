"""Release folders: config snapshot, renamed copies by a manifest, optional archive."""

from __future__ import annotations

import shutil
import zipfile
from collections.abc import Iterator
from itertools import groupby
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import held
from . import store


def snapshot_config(path: str | Path, folder: str | Path) -> Path:
    """Makes the version's folder and keeps the run's configuration in it."""
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    return Path(shutil.copy2(path, folder / Path(path).name))


def check_distinct(manifest: DataFrame) -> None:
    """Raises where two files would get one name, as equal dates of a chip would make them."""
    clash = manifest.groupBy("dst").count().where("count > 1").limit(1).collect()
    if clash:
        raise ValueError(f"more than one file would be {clash[0]['dst']}")


def copy_files(manifest: DataFrame, source: str, target: str) -> DataFrame:
    """Copies src to dst for each row, by the tasks; dst and whether its source was there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = store.opened(target)
        where.create_dir(path, recursive=True)
        for batch in batches:
            done = []
            for src, dst in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                there = store.exists(f"{source}/{src}")
                if there:
                    store.put(target, dst, store.blocks(f"{source}/{src}"))
                done.append(there)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(done, pa.bool_())], names=["dst", "copied"])

    return manifest.select("src", "dst").mapInArrow(run, "dst string, copied boolean")


def copy_all(manifest: DataFrame, source: str, target: str) -> int:
    """copy_files() of the whole manifest; how many were copied. Raises where a source is not there."""
    gone = F.when(~F.col("copied"), F.col("dst"))
    n, lacking, one = copy_files(manifest, source, target).agg(F.count("*"), F.count(gone), F.min(gone)).first()
    if lacking:
        raise FileNotFoundError(f"{lacking} of {n} files to release are not in {source}; {one} is one of them")
    return n


#: Bytes of files that go into a volume, about.
VOLUME_BYTES = 4 << 30


class _Ahead:
    """A stream as zipfile takes it: written from front to back."""

    def __init__(self, out):
        self.out, self.at = out, 0

    def write(self, data: bytes) -> int:
        self.out.write(data)
        self.at += len(data)
        return len(data)

    def tell(self) -> int:
        return self.at

    def flush(self) -> None:
        pass


def archive(spark: SparkSession, folder: str, target: str, name: str, volume_bytes: int = VOLUME_BYTES) -> DataFrame:
    """All files below folder as zip files in target, written by the tasks; volume, path and size of each member.

    A release of up to volume_bytes is name.zip; a larger one name-00000.zip and so on, each a whole archive of some of the files. A
    member is read and deflated a block at a time, and a volume is there as a whole or not at all. Files that Spark hides (names with . or _ at
    the front) are left out.
    """
    root = folder.rstrip("/").split(":", 1)[-1].lstrip("/") if ":" in folder else str(Path(folder).absolute()).lstrip("/")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    total = listed.agg(F.sum("length")).first()[0] or 0
    volumes = -(-total // volume_bytes) or 1
    member = F.substr("path", F.instr("path", f"/{root}/") + F.lit(len(root) + 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = store.opened(target)
        where.create_dir(path, recursive=True)
        rows = ((v, p) for batch in batches for v, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        for volume, members in groupby(rows, key=lambda r: r[0]):
            done = []
            with store.writing(target, f"{name}.zip" if volumes == 1 else f"{name}-{volume:05}.zip") as out, zipfile.ZipFile(_Ahead(out), "w", zipfile.ZIP_DEFLATED) as made:
                for _, p in members:
                    size = 0
                    with made.open(zipfile.ZipInfo(p), "w", force_zip64=True) as entry:
                        for part in store.blocks(f"{folder}/{p}"):
                            entry.write(part)
                            size += len(part)
                    done.append((volume, p, size))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in done], pa.int32()), pa.array([r[1] for r in done], pa.string()), pa.array([r[2] for r in done], pa.int64())], names=["volume", "path", "size"])

    volume = F.pmod(F.xxhash64(member), F.lit(volumes)).cast("int")
    dealt = listed.select(volume.alias("volume"), member.alias("path")).repartition(min(volumes, 10_000), "volume").sortWithinPartitions("volume", "path")
    return held(dealt.mapInArrow(run, "volume int, path string, size bigint"), "archive")
