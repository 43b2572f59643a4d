"""What is decoded of a file, kept under the hash of its bytes.

A key is the file's sha256 with the decoder's version and parameters, so other bytes,
another sampling or another decoder never meet an old entry. An entry is written under a
name of its own attempt; a stamp that names it is put in place last, by a rename. So:

* what isn't stamped isn't there: a task that dies half-way leaves nothing that anyone reads;
* two tasks that decode one key both leave whole entries, and all readers take the same one;
* a retried task or a later run finds what was stamped before and decodes the rest only.

Works on any file system that pyarrow opens; the folder must be one that all
executors share.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .raw import opened


@dataclass(frozen=True)
class FrameCache:
    folder: str
    #: The bytes of a file -> its frames.
    decode: Callable[[bytes], pa.Table]
    version: str
    params: dict = field(default_factory=dict)

    def key(self, sha256: str) -> str:
        how = json.dumps([self.version, self.params], sort_keys=True)
        return f"{sha256[:2]}/{sha256}-{hashlib.sha256(how.encode()).hexdigest()[:16]}"

    def _entry(self, sha256: str) -> tuple[pa.fs.FileSystem, str]:
        fs, root = opened(self.folder)
        return fs, f"{root}/{self.key(sha256)}"

    def _stamped(self, fs: pa.fs.FileSystem, entry: str) -> str | None:
        """The attempt that readers take: of the stamped ones the first by name."""
        names = [f.base_name for f in fs.get_file_info(pa.fs.FileSelector(entry, allow_not_found=True))]
        return min((n.removesuffix(".stamp") for n in names if n.endswith(".stamp")), default=None)

    def has(self, sha256: str) -> bool:
        return self._stamped(*self._entry(sha256)) is not None

    def frames(self, sha256: str, content: bytes) -> pa.Table:
        """The file's frames; decoded now if they aren't there."""
        fs, entry = self._entry(sha256)
        attempt = self._stamped(fs, entry)
        if attempt is None:
            made, attempt = self.decode(content), uuid.uuid4().hex
            fs.create_dir(entry, recursive=True)
            pq.write_table(made, f"{entry}/{attempt}.parquet", filesystem=fs, compression="zstd")
            with fs.open_output_stream(f"{entry}/{attempt}.part") as f:
                f.write(json.dumps({"sha256": sha256, "version": self.version, "params": self.params, "rows": made.num_rows}).encode())
            fs.move(f"{entry}/{attempt}.part", f"{entry}/{attempt}.stamp")
            attempt = self._stamped(fs, entry)
        return pq.read_table(f"{entry}/{attempt}.parquet", filesystem=fs)

    def sweep(self, older_s: float = 86_400) -> int:
        """Deletes what no stamp names, if it is so old that no task may still be at
        work on it; returns how many files went."""
        fs, root = opened(self.folder)
        files = [f for f in fs.get_file_info(pa.fs.FileSelector(root, recursive=True, allow_not_found=True)) if f.is_file]
        stamped = {f.path.removesuffix(".stamp") for f in files if f.path.endswith(".stamp")}
        gone = [f for f in files if not f.path.endswith(".stamp") and f.path.rsplit(".", 1)[0] not in stamped and f.mtime.timestamp() < time.time() - older_s]
        for f in gone:
            fs.delete_file(f.path)
        return len(gone)


def prepare(creatives: DataFrame, cache: FrameCache) -> DataFrame:
    """creatives (file_sha256, file_name, content) -> file_sha256, n_frames,
    decoded (now), error: every file of different bytes once, however many creatives have them."""
    first = creatives.groupBy("file_sha256").agg(F.min("file_name").alias("file_name"))
    once = creatives.join(first, ["file_sha256", "file_name"], "left_semi").select("file_sha256", "content")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for sha, content in zip(b.column("file_sha256").to_pylist(), b.column("content"), strict=True):
                new = not cache.has(sha)
                try:
                    out.append((sha, cache.frames(sha, content.as_py()).num_rows, new, None))
                except Exception as e:  # a file that can't be decoded costs its own row only
                    out.append((sha, None, False, f"{type(e).__name__}: {e}"))
            yield pa.RecordBatch.from_pylist([dict(zip(_PREPARED.names, r, strict=True)) for r in out], schema=_PREPARED)

    return once.mapInArrow(fill, "file_sha256 string, n_frames long, decoded boolean, error string")


_PREPARED = pa.schema([("file_sha256", pa.string()), ("n_frames", pa.int64()), ("decoded", pa.bool_()), ("error", pa.string())])


def with_frames(cache: FrameCache, work: Callable[..., dict]) -> Callable[..., dict]:
    """An extractor's function that gets the frames of the cache in place of the bytes."""

    def extract(creative_id: str, content: bytes, *used: dict) -> dict:
        return work(creative_id, cache.frames(hashlib.sha256(content).hexdigest(), content), *used)

    return extract
