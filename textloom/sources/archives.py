"""Zip archives read by seeking: their lists, and single entries from the places that the lists give."""

from __future__ import annotations

import bz2
import lzma
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from pathlib import Path
from typing import BinaryIO
from urllib.parse import quote

from pyarrow import fs

UNREADABLE = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, NotImplementedError, RuntimeError, EOFError, OSError, ValueError)

# Fixed values of the format: the header in front of an entry's bytes, and its marks.
_HEADER, _HEADER_SIZE = "<4sHHHHHIIIHH", 30
_MARK = b"PK\x03\x04"
_ENCRYPTED, _SIZES_BEHIND = 0x1, 0x8


def opened(path: str) -> BinaryIO:
    """A file for reading and seeking, on any file system that pyarrow knows; a path without scheme is local."""
    if path.startswith("file:") or "://" not in path:
        return open("/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path, "rb")
    system, place = fs.FileSystem.from_uri(quote(path, safe=":/@%?=&"))
    return system.open_input_file(place)


def write_file(path: str, content: bytes) -> None:
    """Write a whole file; folders are made."""
    if path.startswith("file:") or "://" not in path:
        place = Path("/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path)
        place.parent.mkdir(parents=True, exist_ok=True)
        fresh = place.with_name(f".{uuid.uuid4().hex}")  # a task may run twice
        fresh.write_bytes(content)
        fresh.replace(place)
        return
    system, place = fs.FileSystem.from_uri(quote(path, safe=":/@%?=&"))
    system.create_dir(place.rpartition("/")[0])
    with system.open_output_stream(place) as out:
        out.write(content)


def archive_list(path: str) -> Iterator[tuple[str, int, int, int]]:
    """Name, size, place and packed size of every file in an archive; nothing if the archive is damaged.

    Of entries with one name the last counts.
    """
    try:
        with opened(path) as file, zipfile.ZipFile(file) as archive:
            last = {e.filename: e for e in archive.infolist() if not e.is_dir()}
    except UNREADABLE:
        return
    for e in last.values():
        yield e.filename, e.file_size, e.header_offset, e.compress_size


class EntryReader:
    """Reads entries one after the other and keeps the last file open."""

    def __init__(self):
        self.path, self.file = None, None

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.path, self.file = None, None

    def read(self, path: str, at: int, packed: int, size: int) -> bytes | None:
        """Bytes of the entry whose header is at `at`; None if it cannot be read or its checksum is wrong."""
        try:
            if path != self.path:
                self.close()
                self.file, self.path = opened(path), path
            self.file.seek(at)
            mark, _, flags, method, _, _, crc, _, _, name, extra = struct.unpack(_HEADER, self.file.read(_HEADER_SIZE))
            if mark != _MARK or flags & _ENCRYPTED:
                return None
            self.file.seek(at + _HEADER_SIZE + name + extra)
            raw = _unpack(self.file.read(packed), method)
            if flags & _SIZES_BEHIND and not crc:
                crc = self._checksum_behind(at + _HEADER_SIZE + name + extra + packed)
        except (*UNREADABLE, struct.error):
            return None
        return raw if len(raw) == size and zlib.crc32(raw) == crc else None

    def _checksum_behind(self, at: int) -> int:
        self.file.seek(at)
        first, second = struct.unpack("<4sI", self.file.read(8))
        return second if first == b"PK\x07\x08" else struct.unpack("<I", first)[0]


def _unpack(data: bytes, method: int) -> bytes:
    if method == zipfile.ZIP_STORED:
        return data
    if method == zipfile.ZIP_DEFLATED:
        inflate = zlib.decompressobj(-15)
        return inflate.decompress(data) + inflate.flush()
    if method == zipfile.ZIP_BZIP2:
        return bz2.decompress(data)
    if method == zipfile.ZIP_LZMA:  # two bytes of version, the size of the properties, the properties
        length = struct.unpack("<H", data[2:4])[0]
        found = lzma._decode_filter_properties(lzma.FILTER_LZMA1, data[4 : 4 + length])
        return lzma.decompress(data[4 + length :], lzma.FORMAT_RAW, filters=[found])
    raise NotImplementedError(method)
