"""FASTQ as a Spark data source.

``spark.read.format("fastq").load(dir)`` gives one row per read and one partition per file; with the option
``pairs`` one partition per chunk, which reads both mates side by side, so pairing needs no shuffle. A file is
framed by line count, some thousand reads at a time, which go to Spark as Arrow batches.

``read_fastq`` also splits plain files by bytes and blocked gzip (whose members give their sizes) by members. One job counts the records of every
range, each finding its first record by shape; prefix sums of the counts give ordinals, show where a mate's records lie, and cut a read budget to
what each partition may read. Other gzip can't be split.

``spark.readStream.format("fastq")`` follows a folder: every batch reads the chunks that have come since.
"""

from __future__ import annotations

import gzip
import io
import json
import os
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice, zip_longest

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from seqloom.functions.scalars import FILE_NAME, SHEET_NUMBER

_NAME = re.compile(FILE_NAME)
READS = "path string, sample string, lane string, read string, chunk string, ord bigint, header string, seq string, qual string"
PAIRS = "sample string, is_undetermined boolean, chunk_key string, ord bigint, h1 string, s1 string, q1 string, h2 string, s2 string, q2 string"


@dataclass(frozen=True)
class FastqFile:
    """A demultiplexed file and what its name says."""

    path: str
    sample: str
    lane: str
    read: str
    chunk: str

    @property
    def key(self) -> str:
        return f"{self.sample}|{self.lane}|{self.chunk}"

    @property
    def label(self) -> str:
        return f"{self.sample}:{self.read}:{self.lane or '-'}:{self.chunk or '-'}"

    @property
    def undetermined(self) -> bool:
        return self.sample.lower().startswith("undetermined")


def parse_name(path: str) -> FastqFile | None:
    m = _NAME.match(os.path.basename(path))
    if not m:
        return None
    read = (m[3] or m[5]).upper()
    return FastqFile(path, re.sub(SHEET_NUMBER, "", m[1] or ""), m[2] or "", read if len(read) == 2 else f"R{read}", m[4] or m[6] or "")


@dataclass(frozen=True)
class Chunk:
    """The files of one sample, lane and chunk, by read."""

    key: str
    sample: str
    undetermined: bool
    files: dict[str, str]


def located(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and its name there; a path without a scheme is local."""
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def discover(root: str) -> tuple[list[Chunk], list[FastqFile], list[str]]:
    """(chunks: assigned samples first, all recognised files, warnings). Of two files for one read the last is used.

    ``root`` is a folder or a URI that Arrow opens (file, hdfs, s3, gs); it is looked through with its subfolders.
    """
    files, warnings = [], []
    store, base = located(root)
    for info in sorted(store.get_file_info(pafs.FileSelector(base, recursive=True)), key=lambda i: i.path.split("/")):
        if not info.is_file or not re.search(r"\.(fastq|fq)(\.gz)?$", info.path, re.I):
            continue
        found = parse_name(root.rstrip("/") + info.path[len(base.rstrip("/")) :])
        if found is None:
            warnings.append(f"name not recognised: {info.base_name}")
        else:
            files.append(found)
    chunks: dict[str, Chunk] = {}
    for f in files:
        c = chunks.setdefault(f.key, Chunk(f.key, f.sample, f.undetermined, {}))
        if f.read in c.files:
            warnings.append(f"second {f.read} file for {f.key}: {f.path}")
        c.files[f.read] = f.path
    return sorted(chunks.values(), key=lambda c: (c.undetermined, c.sample, c.key)), files, warnings


def open_text(path: str) -> io.TextIOWrapper:
    store, name = located(path)
    raw = store.open_input_stream(name, compression=None)
    return io.TextIOWrapper(gzip.GzipFile(fileobj=raw) if path.lower().endswith(".gz") else raw, encoding="utf-8", errors="replace")


# A member of blocked gzip, from its magic number to its extra field, which gives the member's size.
_MEMBER = re.compile(rb"\x1f\x8b\x08\x04.{6}(..)(?:.{0,64}?)BC\x02\x00(..)", re.S)
_MOST_MEMBER = 1 << 16
#: Bytes of a plain file that are read at once.
STEP = 1 << 20
#: Bytes of a partition, and the most partitions that planning aims at.
SPLIT_BYTES, MOST_SPLITS = 128 << 20, 20_000


def _member_size(head: bytes) -> int | None:
    """Bytes of the blocked gzip member that begins here; None if none does."""
    m = _MEMBER.match(head)
    return int.from_bytes(m[2], "little") + 1 if m and m.end() <= 12 + int.from_bytes(m[1], "little") else None


def is_blocked(path: str) -> bool:
    store, name = located(path)
    with store.open_input_file(name) as f:
        return _member_size(f.read(128)) is not None


def _next_member(f: pa.NativeFile, at: int, size: int) -> int:
    """Where the first member at or after ``at`` begins: a header whose size leads to another header or the end."""
    if at == 0:
        return 0
    f.seek(at)
    data = f.read(2 * _MOST_MEMBER + 128)
    for m in re.finditer(rb"\x1f\x8b\x08\x04", data):
        n = _member_size(data[m.start() :])
        if n is not None and (at + m.start() + n == size or _member_size(data[m.start() + n : m.start() + n + 128]) is not None):
            return at + m.start()
    return size


def blocks(path: str, start: int, step: int = STEP) -> Iterator[tuple[int, bytes]]:
    """(offset, text) of the pieces of a plain file from ``start``, or of the members of blocked gzip from the first one there. Other gzip is read from its start."""
    store, name = located(path)
    with store.open_input_file(name) as f:
        size = f.size()
        if not path.lower().endswith(".gz"):
            while start < size:
                f.seek(start)
                yield start, f.read(step)
                start += step
            return
        if _member_size(f.read(128)) is None:  # one stream, which can't be entered in its middle
            f.seek(0)
            with gzip.GzipFile(fileobj=f) as stream:
                while text := stream.read(step):
                    yield 0, text
            return
        start = _next_member(f, start, size)
        while start < size:
            f.seek(start)
            raw = f.read(_MOST_MEMBER)
            n = _member_size(raw)
            if n is None or len(raw) < n:
                raise ValueError(f"{path}: no whole gzip member at byte {start}")
            yield start, gzip.decompress(raw[:n])
            start += n


@dataclass(frozen=True)
class Place:
    """A record's first byte: offset of a block and bytes into its text."""

    block: int = 0
    inner: int = 0


def _lines(path: str, start: int, step: int) -> Iterator[tuple[Place, bytes]]:
    """Lines with their places from a range's start on. A line belongs to the block that holds the line end before it, the first line of a file to its first block."""
    held, place, known = b"", Place(), start == 0
    for offset, text in blocks(path, start, step):
        at = 0
        while (end := text.find(b"\n", at)) >= 0:
            if known:
                yield place, (held + text[at:end]).rstrip(b"\r")
            held, known, at = b"", True, end + 1
            place = Place(offset, at)
        if known:
            held += text[at:]
    if known and held:
        yield place, held.rstrip(b"\r")


def _check(path: str, n: int, head: str | bytes, seq: str | bytes, mark: str | bytes, qual: str | bytes | None) -> None:
    if qual is None:
        raise ValueError(f"{path}: record {n} is cut off")
    if head[:1] not in ("@", b"@") or mark[:1] not in ("+", b"+"):
        raise ValueError(f"{path}: record {n} doesn't start with @ or lacks its +")
    if len(seq) != len(qual):
        raise ValueError(f"{path}: record {n} has {len(seq)} bases and {len(qual)} qualities")


def survey(path: str, start: int, end: int, limit: int | None = None, step: int = STEP) -> tuple[Place | None, int, Place | None]:
    """(first record's place, records, place after the last) of the records that begin in a range of a file.

    A range in the middle of a file finds its first record by shape: a line with @, two lines on one with +, and as many qualities as
    bases. A quality line that begins with @ doesn't pass, since two lines on is a sequence. ``limit`` ends the count early; the last place is then None, as at the file's end.
    """
    lines = _lines(path, start, step)
    window = list(islice(lines, 4))
    if start:
        while len(window) == 4 and window[0][0].block < end and not (window[0][1][:1] == b"@" and window[2][1][:1] == b"+" and len(window[1][1]) == len(window[3][1])):
            window = [*window[1:], *islice(lines, 1)]
        if len(window) < 4:
            return None, 0, None
    if not window or window[0][0].block >= end:
        return None, 0, None
    first, n = window[0][0], 0
    while window:
        if window[0][0].block >= end:
            return first, n, window[0][0]
        if n == limit:
            return first, n, None
        _check(path, n + 1, *(window[k][1] if k < len(window) else b"" for k in range(3)), window[3][1] if len(window) == 4 else None)
        n += 1
        window = list(islice(lines, 4))
    return first, n, None


class _Text(io.RawIOBase):
    """The text of a file from a place on, block by block."""

    def __init__(self, path: str, place: Place):
        self.parts = (text[place.inner :] if offset == place.block else text for offset, text in blocks(path, place.block))
        self.rest = b""

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while not self.rest:
            part = next(self.parts, None)
            if part is None:
                return 0
            self.rest = part
        n = min(len(into), len(self.rest))
        into[:n], self.rest = self.rest[:n], self.rest[n:]
        return n


def _opened(path: str, place: Place) -> io.TextIOWrapper:
    if place == Place():
        return open_text(path)
    if not path.lower().endswith(".gz"):
        place = Place(place.block + place.inner)
    return io.TextIOWrapper(io.BufferedReader(_Text(path, place), 1 << 17), encoding="utf-8", errors="replace")


#: Reads that are checked and handed on together.
READS_AT_ONCE = 5000


def batches(path: str, limit: int | None = None, place: Place = Place(), skip: int = 0) -> Iterator[tuple[list[str], list[str], list[str]]]:
    """(headers, upper-case sequences, qualities) of some thousand records at a time; malformed files raise ValueError.

    From ``place`` on, without the first ``skip`` records, ``limit`` at most.
    """
    done = 0
    with _opened(path, place) as lines:
        for _ in islice(lines, 4 * skip):
            pass
        while limit is None or done < limit:
            some = READS_AT_ONCE if limit is None else min(READS_AT_ONCE, limit - done)
            block = [x.rstrip("\r\n") for x in islice(lines, 4 * some)]
            if not block:
                return
            heads, seqs, plus, quals = (block[k::4] for k in range(4))
            for n, record in enumerate(zip_longest(heads, seqs, plus, quals), done + 1):
                _check(path, n, *(x or "" for x in record[:3]), record[3])
            yield heads, [x.upper() for x in seqs], quals
            done += len(heads)


def records(path: str) -> Iterator[tuple[str, str, str]]:
    """(header, upper-case sequence, qualities) of each record."""
    for columns in batches(path):
        yield from zip(*columns, strict=True)


@dataclass
class Part(InputPartition):
    """Records of a file, or of both mates' files: from ``places``, after ``skips``, ``take`` at most. ``first`` is the first one's ordinal."""

    files: tuple[FastqFile, ...]
    places: tuple[Place, ...]
    skips: tuple[int, ...]
    first: int
    take: int | None


def _whole(files: tuple[FastqFile, ...], take: int | None) -> Part:
    return Part(files, (Place(),) * len(files), (0,) * len(files), 0, take)


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options
        self.pairs = options.get("pairs", "false").lower() == "true"

    def partitions(self) -> list[InputPartition]:
        if "plan" in self.options:
            found = [_part(p) for p in json.loads(self.options["plan"])]
        else:
            limit = int(self.options["limit"]) if self.options.get("limit") else None
            found = [_whole(files, limit) for files in wanted(self.options["path"], self.options)]
        return found or [Part((), (), (), 0, None)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        return _rows(partition, self.pairs)


def _rows(part: Part, pairs: bool) -> Iterator[pa.RecordBatch]:
    """The records of a part as batches, with their ordinals."""
    if not part.files:
        return
    first, *more = part.files
    names = [x.split()[0] for x in (PAIRS if pairs else READS).split(", ")]
    kinds = {"ord": pa.int64(), "is_undetermined": pa.bool_()}
    done = part.first
    for mates in zip_longest(*[batches(f.path, part.take, p, s) for f, p, s in zip(part.files, part.places, part.skips, strict=True)]):
        n = len(mates[0][0]) if mates[0] else 0
        if any(m is None or len(m[0]) != n for m in mates):
            raise ValueError(f"{first.key}: the mates' files differ in their number of reads")
        order, same = list(range(done, done + n)), lambda x: [x] * n  # noqa: B023
        if pairs:
            two = mates[1] if more else (same(None),) * 3
            columns = [same(first.sample), same(first.undetermined), same(first.key), order, *mates[0], *two]
        else:
            columns = [same(first.path), same(first.sample), same(first.lane), same(first.read), same(first.chunk), order, *mates[0]]
        yield pa.RecordBatch.from_arrays([pa.array(c, kinds.get(k, pa.string())) for k, c in zip(names, columns, strict=True)], names)
        done += n


class _StreamReader(DataSourceStreamReader):
    """A stream's offset is the list of chunks that are there whole: a chunk once all of ``mates`` have a file, a file by itself without ``pairs``.

    A batch reads the chunks that its start doesn't list, so files may be removed once they are read. Files have to appear whole, as by a move.
    """

    def __init__(self, options: dict[str, str]):
        self.options = options
        self.pairs = options.get("pairs", "false").lower() == "true"

    def _there(self) -> dict[str, tuple[FastqFile, ...]]:
        need = len(self.options.get("mates", "R1,R2").split(",")) if self.pairs else 1
        return {g[0].key if self.pairs else g[0].path: g for g in wanted(self.options["path"], self.options) if len(g) == need}

    def initialOffset(self) -> dict:
        return {"seen": ""}

    def latestOffset(self) -> dict:
        return {"seen": "\n".join(sorted(self._there()))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        new = sorted(set(end["seen"].split("\n")) - set(start["seen"].split("\n")))
        there = self._there()
        gone = [k for k in new if k and k not in there]
        if gone:
            raise FileNotFoundError(f"files of {gone[0]} went before they were read")
        return [_whole(there[k], None) for k in new if k] or [Part((), (), (), 0, None)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        return _rows(partition, self.pairs)

    def commit(self, end: dict) -> None:
        pass


class FastqSource(DataSource):
    """Options: path, pairs (true: mates side by side), mates (R1,R2), reads (R1,R2,I1,I2), only (paths, a line each), limit (reads of each file), plan (of ``read_fastq``)."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return PAIRS if self.options.get("pairs", "false").lower() == "true" else READS

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(dict(self.options))


def wanted(root: str, options: dict[str, str]) -> list[tuple[FastqFile, ...]]:
    """The files that are read, those of mates together, in the order of their samples and chunks."""
    chunks, files, _ = discover(root)
    if options.get("pairs", "false").lower() != "true":
        reads, only = set(options.get("reads", "R1,R2,I1,I2").upper().split(",")), options.get("only")
        return [(f,) for f in files if f.read in reads and (only is None or f.path in only.split("\n"))]
    found = [tuple(parse_name(c.files[r]) for r in options.get("mates", "R1,R2").split(",") if r in c.files) for c in chunks]
    return [m for m in found if m]


SURVEYED = "file int, split int, block long, inner long, n long, next_block long, next_inner long"


def _surveyed(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_:
        out = []
        for file, split, path, start, end, limit, step in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            first, n, after = survey(path, start, end, limit, step)
            out.append((file, split, *((p.block, p.inner) if p else (None, None) for p in (first,)), n, *((p.block, p.inner) if p else (None, None) for p in (after,))))
        flat = [(a, b, *c, d, *e) for a, b, c, d, e in out]
        kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 5]
        columns = list(zip(*flat, strict=True)) or [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in SURVEYED.split(", ")])


@dataclass
class _Counted:
    """A surveyed file: the place and first ordinal of every split that holds records, and all records."""

    places: list[Place]
    firsts: list[int]
    total: int

    def at(self, ordinal: int) -> tuple[Place, int]:
        """(place, records to skip there) of a record."""
        k = bisect_right(self.firsts, ordinal) - 1
        return (self.places[k], ordinal - self.firsts[k]) if k >= 0 else (Place(), ordinal)


def _count(spark: SparkSession, files: list[FastqFile], split_bytes: int, limit: int | None, step: int) -> list[_Counted]:
    """Records of each file by splits, counted by one job with a task a split; places must follow one another."""
    rows = []
    for i, f in enumerate(files):
        size = max(1, _size(f.path))
        starts = range(0, size, split_bytes) if _splits(f.path) else (0,)
        rows += [(i, k, f.path, a, min(a + split_bytes, size) if len(starts) > 1 else size, limit, step) for k, a in enumerate(starts)]
    splits = spark.createDataFrame(rows, "file int, split int, path string, start long, end long, limit long, step int").repartition(len(rows))
    out, after = [_Counted([], [], 0) for _ in files], {}
    for i, _, block, inner, n, next_block, next_inner in sorted(map(tuple, splits.mapInArrow(_surveyed, SURVEYED).collect()), key=lambda r: r[:2]):
        c = out[i]
        if block is None or limit is not None and c.total >= limit:
            continue
        place = Place(block, inner)
        if c.places and after[i] != place:
            raise ValueError(f"{files[i].path}: the record at byte {block} + {inner} isn't where the one before it ends")
        c.places.append(place)
        c.firsts.append(c.total)
        c.total += n
        after[i] = None if next_block is None else Place(next_block, next_inner)
    return out


def _size(path: str) -> int:
    store, name = located(path)
    return store.get_file_info(name).size


def _splits(path: str) -> bool:
    return not path.lower().endswith(".gz") or is_blocked(path)


def plan(spark: SparkSession, root: str, options: dict[str, str], split_bytes: int = SPLIT_BYTES, per_sample: int | None = None) -> list[Part]:
    """The parts of a scan: files, or byte ranges of those that can be split and hold more than ``split_bytes``; with ``per_sample`` no more reads (or pairs) of a sample,
    in the order of its chunks.

    Records of ranges are counted beforehand, so a part knows its first ordinal and where its mates lie. Files that are read whole and without a budget aren't counted.
    """
    groups = sorted(wanted(root, options), key=lambda g: (g[0].undetermined, g[0].sample, g[0].key)) if per_sample else wanted(root, options)
    sizes = [max(_size(f.path) for f in g) for g in groups]
    split_bytes = max(split_bytes, sum(sizes) // MOST_SPLITS)
    step = min(STEP, split_bytes)
    split_bytes = -(-split_bytes // step) * step
    cut = [size > split_bytes and all(_splits(f.path) for f in g) for g, size in zip(groups, sizes, strict=True)]
    count = [f for g, c in zip(groups, cut, strict=True) for f in (g if c else g[:1] if per_sample else ())]
    counted = dict(zip((f.path for f in count), _count(spark, count, split_bytes, per_sample, step) if count else (), strict=True))
    limit = int(options["limit"]) if options.get("limit") else None
    left: dict[str, int] = {}
    parts = []
    for files, is_cut in zip(groups, cut, strict=True):
        rest = left.get(files[0].sample, per_sample) if per_sample else limit
        if not is_cut:
            take = min(rest, counted[files[0].path].total) if per_sample else rest
            if not per_sample or take:
                parts.append(_whole(files, take))
        else:
            mates = [counted[f.path] for f in files]
            if len({m.total for m in mates}) > 1 and (not per_sample or min(m.total for m in mates) < rest):
                raise ValueError(f"{files[0].key}: the mates' files differ in their number of reads")
            take = mates[0].total if rest is None else min(rest, mates[0].total)
            for first, end in zip(mates[0].firsts, [*mates[0].firsts[1:], mates[0].total], strict=True):
                if first < take:
                    places, skips = zip(*(m.at(first) for m in mates), strict=True)
                    parts.append(Part(files, places, skips, first, min(end, take) - first))
        if per_sample:
            left[files[0].sample] = rest - take
    return parts


def _saved(p: Part) -> list:
    return [[f.path for f in p.files], [[x.block, x.inner] for x in p.places], p.skips, p.first, p.take]


def _part(saved: list) -> Part:
    paths, places, skips, first, take = saved
    return Part(tuple(map(parse_name, paths)), tuple(Place(*x) for x in places), tuple(skips), first, take)


def read_fastq(spark: SparkSession, root: str, split_bytes: int = SPLIT_BYTES, per_sample: int | None = None, **options: str) -> DataFrame:
    """A folder's reads by ``plan``: large files in ranges, and ``per_sample`` reads of each sample at most."""
    spark.dataSource.register(FastqSource)
    parts = plan(spark, root, options, split_bytes, per_sample)
    return spark.read.format("fastq").options(**options, plan=json.dumps([_saved(p) for p in parts])).load(root)
