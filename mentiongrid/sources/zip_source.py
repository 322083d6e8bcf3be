"""A Spark data source for the members of large zip archives on any store.

Planning walks the directory of each archive once, in blocks, and cuts it where the wanted members before the cut fill
a partition. A partition is a stretch of the directory, some bytes long in the plan however many members it lists; its
task reads that stretch and then only the members named there. So partitions are balanced by bytes, no
archive is opened as a whole and no list of members passes through the driver.

    spark.dataSource.register(ZipMembers)
    spark.read.format("zip_members").option("paths", json.dumps(paths)).option("suffixes", "a.xml,b.xml").load()

Members that are damaged, encrypted, compressed in another way than by deflation, or not text have NULL content and a
`read_error`. An archive without a directory is an error of its own.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs  # noqa: F401 - used as pa.fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, member string, content string, read_error string"
PART_BYTES = 128 * 2**20
_BLOCK = 4 * 2**20
_BATCH_BYTES = 8 * 2**20
_ENTRY, _LOCAL = struct.Struct("<4s6H3L5H2L"), struct.Struct("<4s5H3L2H")
_END, _LOCATOR, _END64 = struct.Struct("<4s4H2LH"), struct.Struct("<4sLQL"), struct.Struct("<4sQ2H2L4Q")
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF


class BadArchive(ValueError):
    pass


@dataclass(frozen=True)
class Member:
    name: str
    offset: int
    packed: int
    size: int
    crc: int
    method: int
    flags: int


def open_input(path: str):
    """A seekable file on whatever store holds it; Spark writes some schemes its own way."""
    for spark_scheme, scheme in (("file:/", "file:///"), ("s3a://", "s3://")):
        if path.startswith(spark_scheme) and not path.startswith(scheme):
            path = scheme + path.removeprefix(spark_scheme)
    filesystem, location = pa.fs.FileSystem.from_uri(path)
    return filesystem.open_input_file(location)


def directory_of(source) -> tuple[int, int, int]:
    """Where the directory of an archive starts and ends, and what stands before the archive itself."""
    size = source.size()
    tail_at = max(0, size - _FULL16 - _END.size)
    tail = _read(source, tail_at, size - tail_at)
    at = tail.rfind(b"PK\5\6", 0, len(tail) - _END.size + 4)
    while at >= 0 and at + _END.size + _END.unpack_from(tail, at)[-1] != len(tail):
        at = tail.rfind(b"PK\5\6", 0, at + 3)  # the mark stood in the comment
    if at < 0:
        raise BadArchive("no end of a zip directory")
    _, _, _, _, count, length, offset, _ = _END.unpack_from(tail, at)
    end = tail_at + at
    if count == _FULL16 or _FULL32 in (length, offset):
        where = end - _LOCATOR.size
        mark, _, end64, _ = _LOCATOR.unpack(_read(source, where, _LOCATOR.size))
        if mark == b"PK\6\7":
            mark, *_, length, offset = _END64.unpack(_read(source, end64, _END64.size))
            end = end64
            if mark != b"PK\6\6":
                raise BadArchive("no end of a zip64 directory")
    return end - length, end, end - length - offset


def entries(source, start: int, end: int, shift: int = 0) -> Iterator[tuple[int, Member]]:
    """(place after the entry, member) of a stretch of a directory, read in blocks."""
    held, at = b"", start
    while True:
        pos = 0
        while (entry := _entry(held, pos, shift)) is not None:
            pos, member = entry
            yield at - len(held) + pos, member
        held = held[pos:]
        if at >= end:
            if held:
                raise BadArchive("a zip directory breaks off")
            return
        held += _read(source, at, min(_BLOCK, end - at))
        at += min(_BLOCK, end - at)


def _entry(data: bytes, pos: int, shift: int) -> tuple[int, Member] | None:
    if len(data) - pos < _ENTRY.size:
        return None
    mark, _, _, flags, method, _, _, crc, packed, size, name_len, extra_len, comment_len, _, _, _, offset = _ENTRY.unpack_from(data, pos)
    if mark != b"PK\1\2":
        raise BadArchive("a zip directory is damaged")
    name_at = pos + _ENTRY.size
    extra_at = name_at + name_len
    end = extra_at + extra_len + comment_len
    if len(data) < end:
        return None
    size, packed, offset = _wide(data[extra_at : extra_at + extra_len], size, packed, offset)
    name = data[name_at:extra_at].decode("utf-8" if flags & 0x800 else "cp437")
    return end, Member(name, offset + shift, packed, size, crc, method, flags)


def _wide(extra: bytes, *values: int) -> list[int]:
    """64-bit values of the zip64 field for those that do not fit."""
    found, at = list(values), 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            place = at + 4
            for i, value in enumerate(found):
                if value == _FULL32 and place + 8 <= at + 4 + length:
                    found[i], place = struct.unpack_from("<Q", extra, place)[0], place + 8
        at += 4 + length
    return found


def _read(source, at: int, length: int) -> bytes:
    source.seek(at)
    data = source.read(length)
    if len(data) < length:
        raise BadArchive("an archive breaks off")
    return data


def content_of(source, member: Member) -> str:
    """The text of a member, checked against its size and checksum."""
    if member.flags & 1:
        raise BadArchive("the member is encrypted")
    mark, *_, name_len, extra_len = _LOCAL.unpack(_read(source, member.offset, _LOCAL.size))
    if mark != b"PK\3\4":
        raise BadArchive("the member is not where the directory says")
    data = _read(source, member.offset + _LOCAL.size + name_len + extra_len, member.packed)
    if member.method == 8:
        unpacker = zlib.decompressobj(-15)
        data = unpacker.decompress(data, member.size + 1)
    elif member.method:
        raise BadArchive(f"the member is compressed by method {member.method}")
    if len(data) != member.size or zlib.crc32(data) != member.crc:
        raise BadArchive("the member is damaged")
    return data.decode("utf-8")


def slices(source, suffixes: tuple[str, ...], part_bytes: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, shift) of stretches of the directory whose wanted members have about `part_bytes` each."""
    start, end, shift = directory_of(source)
    held, any_wanted = 0, False
    for after, member in entries(source, start, end, shift):
        if member.name.endswith(suffixes):
            held, any_wanted = held + member.packed, True
        if held >= part_bytes:
            yield start, after, shift
            start, held, any_wanted = after, 0, False
    if any_wanted:
        yield start, end, shift


class ZipMembers(DataSource):
    """Options: `paths` (a JSON list), `suffixes` (comma-separated; empty: all members), `partBytes`."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ZipReader:
        return ZipReader(self.options)


@dataclass
class ZipSlice(InputPartition):
    path: str
    start: int
    end: int
    shift: int


class ZipReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.paths = json.loads(options["paths"])
        self.suffixes = tuple(s for s in options.get("suffixes", "").split(",") if s) or ("",)
        self.part_bytes = int(options.get("partBytes", PART_BYTES))

    def partitions(self) -> list[ZipSlice]:
        found = []
        for path in self.paths:
            with open_input(path) as source:
                try:
                    found += [ZipSlice(path, *s) for s in slices(source, self.suffixes, self.part_bytes)]
                except BadArchive as exc:
                    raise BadArchive(f"{path}: {exc}") from exc
        return found or [ZipSlice("", 0, 0, 0)]

    def read(self, partition: ZipSlice) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        rows, size = [], 0
        with open_input(partition.path) as source:
            for _, member in entries(source, partition.start, partition.end, partition.shift):
                if not member.name.endswith(self.suffixes):
                    continue
                try:
                    text, error = content_of(source, member), None
                except (BadArchive, zlib.error, UnicodeDecodeError, struct.error) as exc:
                    text, error = None, f"{type(exc).__name__}: {exc}"
                rows.append((partition.path, member.name, text, error))
                size += len(text or "")
                if size > _BATCH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["path", "member", "content", "read_error"])
