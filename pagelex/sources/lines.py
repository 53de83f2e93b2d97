"""Lines of dump files by byte stretches (SRC-1, SRC-2, WIN-2, FLT-1, SRT-3).

A *member* is a plain file or a readable member of an archive: regular files and links to them count, folders and the
like don't; ``file_number`` is 1-based and restarts for each path. Plain files and members of an uncompressed ``.tar`` are
cut into splits of some megabytes, read in parallel at their offsets. A ``.tar.gz`` can only be unpacked in order: one task reads it, in Arrow batches,
and an exchange deals its lines out before anything else is done with them.

``line_index`` counts the lines of each split once. With it the rows of splits outside a line range go before a byte of
them is read; keep it (it is a small table) for files that are sliced again and again.

Every line has a position ``line_id``: the path's number and the line's byte offset in the path's members laid end to end. It
is unique and the same in every run, whatever the splits. Lines end at a line feed; a carriage return before it goes. A line
that isn't UTF-8 has a null ``value`` (``decode_dump_lines`` quarantines it). Paths are local, shared, or URIs of the stores that
``pyarrow.fs`` opens.
"""

from __future__ import annotations

import os
import posixpath
import tarfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .dump import line_address, line_range

SPLIT_BYTES = 32 << 20
BATCH_BYTES = 4 << 20
PATH_BITS = 44  # bytes of one path that have an id of their own: 16 TB
SPLITS = "path_number int, path string, file_number int, begin long, stop long, start long, end long, base long, packed boolean"
LINES = "path_number int, path string, file_number int, line_number long, line_id long, value string"


def open_input(path: str):
    """A seekable file of any store that pyarrow knows; a plain path is local, ``~`` the user's folder."""
    if "://" in path or path.startswith("file:"):
        store, name = fs.FileSystem.from_uri(path)
        return store.open_input_file(name)
    return fs.LocalFileSystem().open_input_file(os.path.expanduser(path))


def members(tar: tarfile.TarFile):
    """(member, the member that holds its bytes) of the readable members, in order: links are followed by name."""
    for m in tar:
        held, seen = m, set()
        while held is not None and (held.islnk() or held.issym()) and held.name not in seen:
            seen.add(held.name)
            name = held.linkname if held.islnk() else posixpath.normpath(posixpath.join(posixpath.dirname(held.name), held.linkname))
            try:
                held = tar.getmember(name)
            except KeyError:
                held = None
        if held is not None and held.isreg():
            yield m, held


def list_splits(paths: list[str], split_bytes: int = SPLIT_BYTES) -> list[tuple]:
    """Rows of SPLITS: each member's bytes ``begin`` to ``stop`` in the path, a split's ``start`` to ``end``, and where the
    member starts in the path's members laid end to end (``base``). Reads headers of archives only."""
    rows = []
    for number, path in enumerate(paths):
        if path.endswith(".tar.gz"):
            rows.append((number, path, None, 0, 0, 0, 0, 0, True))
            continue
        with open_input(path) as f:
            if path.endswith(".tar"):
                with tarfile.open(fileobj=f, mode="r") as tar:
                    found = [(held.offset_data, held.size) for _, held in members(tar)]
            else:
                found = [(0, f.size())]
        base = 0
        for k, (begin, size) in enumerate(found):
            rows += [(number, path, k + 1, begin, begin + size, s, min(s + split_bytes, begin + size), base, False) for s in range(begin, begin + size, split_bytes)]
            base += size
        if base >> PATH_BITS:
            raise ValueError(f"{path} holds more than 2**{PATH_BITS} bytes")
    return rows


def splits(spark: SparkSession, paths: list[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    rows = list_splits(paths, split_bytes)
    return spark.createDataFrame(rows, SPLITS).repartition(max(1, len(rows)))


def _stretch(f, begin: int, stop: int, start: int, end: int) -> tuple[int, np.ndarray]:
    """The bytes of the lines that start in [start, end), and where the first one starts."""
    at = max(begin, start - 1)
    f.seek(at)
    data = f.read(end - at)
    while at + len(data) < stop and not data.endswith(b"\n"):
        more = f.read(min(1 << 20, stop - at - len(data)))
        cut = more.find(b"\n") + 1
        data += more[:cut] if cut else more
    if start > begin:  # up to the first line feed, the line belongs to an earlier split
        first = data.find(b"\n") + 1 or len(data)
        at, data = at + first, data[first:]
    return at, np.frombuffer(data, np.uint8)


def _texts(data: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Where each line starts, and the lines without their ends; null for those that aren't UTF-8."""
    feed = np.flatnonzero(data == 10)
    ends = feed if len(feed) and feed[-1] == len(data) - 1 else np.append(feed, len(data))
    starts = np.append(0, feed + 1)[: len(ends)]
    if not len(data):
        return starts[:0], pa.array([], pa.string())
    back = feed[feed > 0] - 1
    back = back[data[back] == 13]
    keep = np.ones(len(data), bool)
    keep[feed] = keep[back] = False
    before = np.append(0, np.cumsum(keep))
    offsets = before[np.append(starts, len(data))].astype(np.int64)
    text = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[keep].tobytes()))
    try:
        text.validate(full=True)
    except pa.ArrowInvalid:
        raw = data[keep].tobytes()
        text = pa.array([_decoded(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.large_string())
    return starts, text.cast(pa.string())


def _decoded(raw: bytes) -> str | None:
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return None


def _batches(split: dict, number: int, first_line: int | None, ids: np.ndarray, text: pa.Array):
    """Record batches of LINES of some megabytes each."""
    size = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)))
    i = 0
    while i < len(text):
        j = max(i + 1, int(np.searchsorted(size, size[i] + BATCH_BYTES, "right")) - 1)
        n = j - i
        line = pa.nulls(n, pa.int64()) if first_line is None else pa.array(np.arange(first_line + i, first_line + j))
        yield pa.RecordBatch.from_arrays(
            [pa.array([split["path_number"]] * n, pa.int32()), pa.array([split["path"]] * n), pa.array([number] * n, pa.int32()), line,
             pa.array(ids[i:j] + (split["path_number"] << PATH_BITS)), text.slice(i, n)],
            [c.split()[0] for c in LINES.split(", ")],
        )
        i = j


def _unpacked(split: dict, start: tuple[int, int], end: tuple[int, int]):
    """Lines of a packed archive, from the first to the last file and line that are asked for (0: no bound)."""
    with open_input(split["path"]) as f, tarfile.open(fileobj=f, mode="r:gz") as tar:
        base = 0
        for k, (m, held) in enumerate(members(tar)):
            if end[0] and k + 1 > end[0]:
                return
            if k + 1 >= start[0]:
                rest, at, line = b"", 0, 1
                body = tar.extractfile(m)
                while not end[1] or line <= end[1]:
                    block = body.read(BATCH_BYTES)
                    data = rest + block
                    cut = data.rfind(b"\n") + 1 if block else len(data)
                    starts, text = _texts(np.frombuffer(data[:cut], np.uint8))
                    yield from _batches(split, k + 1, line, base + at + starts, text)
                    rest, at, line = data[cut:], at + cut, line + len(text)
                    if not block:
                        break
            base += held.size


def _rows(batches):
    for batch in batches:
        yield from batch.to_pylist()


def line_index(files: DataFrame) -> DataFrame:
    """The splits with ``first_line``, the number of their first line in its member, and ``n_lines``; both null for packed archives."""

    def run(batches):
        for split in _rows(batches):
            n = None
            if not split["packed"]:
                with open_input(split["path"]) as f:
                    at = max(split["begin"], split["start"] - 1)
                    f.seek(at)
                    n = int(split["start"] == split["begin"])
                    while at < split["end"] - 1:
                        block = f.read(min(BATCH_BYTES, split["end"] - 1 - at))
                        n += block.count(b"\n")
                        at += len(block)
            yield pa.RecordBatch.from_arrays([*(pa.array([split[c]], t) for c, t in kinds), pa.array([n], pa.int64())], [*(c for c, _ in kinds), "n_lines"])

    arrow = {"int": pa.int32(), "string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    kinds = [(c.split()[0], arrow[c.split()[1]]) for c in SPLITS.split(", ")]
    counted = files.mapInArrow(run, SPLITS + ", n_lines long")
    before = Window.partitionBy("path_number", "file_number").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    first = F.when(~F.col("packed"), 1 + F.coalesce(F.sum("n_lines").over(before), F.lit(0)))
    return counted.withColumn("first_line", first)


def in_range(index: DataFrame, start: str = "1:1", end: str | None = None) -> DataFrame:
    """The splits of an index that hold a line of the range (FLT-1: the line bounds hold in every file of the file range)."""
    (sf, sl), (ef, el) = line_address(start), line_address(end) if end else (0, 0)
    keep = (F.col("file_number") >= sf) & (F.col("first_line") + F.col("n_lines") > sl) & (F.col("n_lines") > 0)
    if ef:
        keep = keep & (F.col("file_number") <= ef)
    if el:
        keep = keep & (F.col("first_line") <= el)
    return index.where(F.col("packed") | keep)


def read_splits(files: DataFrame, start: str = "1:1", end: str | None = None) -> DataFrame:
    """LINES of the given splits; ``line_number`` is null where no index gives a split's first line."""
    bounds = line_address(start), line_address(end) if end else (0, 0)
    known = "first_line" in files.columns

    def run(batches):
        for split in _rows(batches):
            if split["packed"]:
                yield from _unpacked(split, *bounds)
                continue
            with open_input(split["path"]) as f:
                at, data = _stretch(f, split["begin"], split["stop"], split["start"], split["end"])
            starts, text = _texts(data)
            yield from _batches(split, split["file_number"], split["first_line"] if known else None, split["base"] + at - split["begin"] + starts, text)

    return files.mapInArrow(run, LINES)


def read_lines(spark: SparkSession, paths: list[str], start: str = "1:1", end: str | None = None, index: DataFrame | None = None, numbered: bool = False,
               split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """LINES of plain files and archives, of the line range ``start`` to ``end`` (``file:line``, inclusive).

    A range, or ``numbered``, needs an index: the given one, or one that is counted first. Without either only the splits are read, once, and
    ``line_number`` is null outside packed archives.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    sliced = line_address(start) != (1, 1) or bool(end)
    files = index if index is not None else splits(spark, paths, split_bytes)
    if index is None and (numbered or sliced):
        files = line_index(files)
    files = in_range(files, start, end) if sliced else files
    plain, packed = files.where("not packed"), files.where("packed")
    out = read_splits(plain.repartition(F.col("path_number"), F.col("start")) if "first_line" in files.columns else plain, start, end)
    if any(p.endswith(".tar.gz") for p in paths) or index is not None:
        # an archive that one task unpacks is dealt out before its lines are decoded and tokenized
        dealt = read_splits(packed, start, end).repartition("path_number", "file_number", F.expr("line_number div 64"))
        out = out.unionByName(dealt)
    return out.where(line_range(start, end)) if sliced else out
