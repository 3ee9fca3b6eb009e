"""Zip archives by byte ranges: directories from their ends, then each member for itself.

A directory says where members lie, so an archive is never read whole: one task reads its last bytes and its directory, and the members, a row each, are dealt
to all tasks by archive and place. What a worker holds is one member. A bad archive, and a bad member of a good one, are rows with an error.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the format: marks, and the fields after them, little-endian.
END_MARK, WIDE_END_MARK, WIDE_PLACE_MARK, ENTRY_MARK, MEMBER_MARK = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
END, WIDE_END, WIDE_PLACE, ENTRY, MEMBER = (struct.Struct(f) for f in ("<4s4H2LH", "<4sQ2H2L4Q", "<4sLQL", "<4s6H3L5H2L", "<4s5H3L2H"))
WIDE_FIELD, STORED, DEFLATED, ENCRYPTED = 1, 0, 8, 1
LONGEST_COMMENT = (1 << 16) - 1
CHUNK = 1 << 20  # bytes of a directory that are read at once

LISTED = pa.schema([("path", pa.string()), ("name", pa.string()), ("offset", pa.int64()), ("packed", pa.int64()), ("size", pa.int64()), ("method", pa.int32()), ("crc", pa.int64()), ("flags", pa.int32()), ("error", pa.string())])
LISTED_DDL = "path string, name string, offset long, packed long, size long, method int, crc long, flags int, error string"
READ = pa.schema([("path", pa.string()), ("name", pa.string()), ("content", pa.binary()), ("error", pa.string())])
READ_DDL = "path string, name string, content binary, error string"


class BadArchive(ValueError):
    pass


def opened(path: str):
    """A file of any store, for reads at a place."""
    from pyarrow import fs

    uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path
    store, name = fs.FileSystem.from_uri(uri)
    return store.open_input_file(name)


def directory(file) -> tuple[int, int, int]:
    """Where the directory begins, how long it is, and how much lies before the archive's own first byte."""
    size = file.size()
    tail_at = max(0, size - END.size - LONGEST_COMMENT)
    tail = file.read_at(size - tail_at, tail_at)
    at = tail.rfind(END_MARK)
    while at >= 0:
        if len(tail) - at >= END.size and len(tail) - at - END.size >= END.unpack_from(tail, at)[7]:
            break
        at = tail.rfind(END_MARK, 0, at)
    if at < 0:
        raise BadArchive("no end of a directory")
    _, _, _, _, _, length, begin, _ = END.unpack_from(tail, at)
    end_at = tail_at + at
    place_at = end_at - WIDE_PLACE.size
    if place_at >= 0 and (place := file.read_at(WIDE_PLACE.size, place_at))[:4] == WIDE_PLACE_MARK:
        wide_at = WIDE_PLACE.unpack(place)[2]
        wide = file.read_at(WIDE_END.size, wide_at)
        if len(wide) < WIDE_END.size or wide[:4] != WIDE_END_MARK:
            raise BadArchive("no end of a wide directory")
        length, begin = WIDE_END.unpack(wide)[8:10]
        end_at = wide_at
    before = end_at - length - begin
    if before < 0:
        raise BadArchive("the directory is longer than what stands before its end")
    return begin + before, length, before


def entries(file) -> Iterator[tuple]:
    """(name, offset, packed, size, method, crc, flags) of each member, in the order of the directory."""
    at, left, before = directory(file)
    held = b""
    while left or held:
        need = ENTRY.size
        if len(held) >= need:
            if held[:4] != ENTRY_MARK:
                raise BadArchive("an entry without its mark")
            _, _, _, flags, method, _, _, crc, packed, size, names, extras, comments, _, _, _, offset = ENTRY.unpack_from(held)
            need += names + extras + comments
        if len(held) < need:
            if not left:
                raise BadArchive("a directory that ends in an entry")
            more = file.read_at(min(left, max(CHUNK, need - len(held))), at)
            if not more:
                raise BadArchive("a directory that ends in an entry")
            at, left, held = at + len(more), left - len(more), held + more
            continue
        raw, extra = held[ENTRY.size : ENTRY.size + names], held[ENTRY.size + names : ENTRY.size + names + extras]
        size, packed, offset = widened(extra, size, packed, offset)
        name = raw.decode("utf-8" if flags & 0x800 else "cp437", "replace")
        if not name.endswith("/"):
            yield name, offset + before, packed, size, method, crc, flags
        held = held[need:]


def widened(extra: bytes, *numbers: int) -> list[int]:
    """Numbers that don't fit 32 bits, from the entry's extra field, in their order."""
    at, wide = 0, b""
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<2H", extra, at)
        if kind == WIDE_FIELD:
            wide = extra[at + 4 : at + 4 + n]
        at += 4 + n
    out, k = [], 0
    for x in numbers:
        if x == 0xFFFFFFFF and k + 8 <= len(wide):
            x, k = struct.unpack_from("<Q", wide, k)[0], k + 8
        out.append(x)
    return out


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path in b.column(0).to_pylist():
            rows: list[tuple] = []
            try:
                with opened(path) as file:
                    for e in entries(file):
                        rows.append((path, *e, None))
                        if len(rows) == 1000:
                            yield batch_of(rows, LISTED)
                            rows = []
            except (ValueError, OSError, struct.error) as error:
                rows.append((path, *[None] * 7, str(error)))
            if rows:
                yield batch_of(rows, LISTED)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def members(archives: DataFrame) -> DataFrame:
    """archives (path) to (path, name, offset, packed, size, method, crc, flags, error): a row for each member, folders left out, or one with an error. An archive that breaks off has the rows before the break, and one with an error."""
    return archives.select(F.col("path").cast("string")).mapInArrow(_list, LISTED_DDL)


def member(file, offset: int, packed: int, size: int, method: int, crc: int, flags: int) -> bytes:
    if flags & ENCRYPTED:
        raise BadArchive("encrypted")
    head = file.read_at(MEMBER.size, offset)
    if len(head) < MEMBER.size or head[:4] != MEMBER_MARK:
        raise BadArchive("no member where the directory says")
    *_, names, extras = MEMBER.unpack(head)
    raw = file.read_at(packed, offset + MEMBER.size + names + extras)
    if method == DEFLATED:
        inflate = zlib.decompressobj(-15)
        try:
            raw = inflate.decompress(raw, size + 1)
        except zlib.error as error:
            raise BadArchive(str(error)) from error
    elif method != STORED:
        raise BadArchive(f"packed by method {method}")
    if len(raw) != size or zlib.crc32(raw) != crc:
        raise BadArchive("other content than the directory says")
    return raw


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path, file = None, None
    try:
        for b in batches:
            for row in zip(*(b.column(k).to_pylist() for k in range(9)), strict=True):
                content, error = None, row[8]
                if error is None:
                    try:
                        if row[0] != path:
                            if file is not None:
                                file.close()
                            path, file = None, None
                            file = opened(row[0])
                            path = row[0]
                        content = member(file, *row[2:8])
                    except (ValueError, OSError, struct.error) as e:
                        error = str(e)
                yield batch_of([(row[0], row[1], content, error)], READ)
    finally:
        if file is not None:
            file.close()


def contents(listed: DataFrame) -> DataFrame:
    """Members (of `members`, all or some) to (path, name, content, error). They are dealt by place, so a large archive is read by many tasks, each going forward in it."""
    n = int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = listed.select(*LISTED.names).repartitionByRange(n, "path", "offset").sortWithinPartitions("path", "offset")
    return dealt.mapInArrow(_read, READ_DDL)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            file = pa.BufferReader(raw.as_buffer() if raw.is_valid else b"")
            try:
                for name, *place in entries(file):
                    try:
                        yield batch_of([(path, name, member(file, *place), None)], READ)
                    except (ValueError, struct.error) as error:
                        yield batch_of([(path, name, None, str(error))], READ)
            except (ValueError, struct.error) as error:
                yield batch_of([(path, None, None, str(error))], READ)


def held(files: DataFrame) -> DataFrame:
    """(path, content) to (path, name, content, error), for archives that are there as bytes."""
    return files.select("path", "content").mapInArrow(_held, READ_DDL)
