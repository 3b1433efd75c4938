"""Structure of binary containers: OLE compound files and ODF packages."""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the compound file format: signature, end of chain, largest regular sector.
SIGNATURE, END, LARGEST = bytes.fromhex("D0CF11E0A1B11AE1"), 0xFFFFFFFE, 0xFFFFFFFA
MIMETYPE = "application/vnd.oasis.opendocument."


class CompoundFile:
    """Sectors, directory and streams of an OLE compound file."""

    def __init__(self, content: bytes):
        if content[:8] != SIGNATURE:
            raise ValueError("no compound file")
        self.content = content
        shift, mini_shift = struct.unpack_from("<HH", content, 30)
        self.size, self.mini_size = 1 << shift, 1 << mini_shift
        directory, _, self.cutoff, mini_table, _, difat, difat_count = struct.unpack_from("<IIIIIII", content, 48)
        tables = [s for s in struct.unpack_from("<109I", content, 76) if s <= LARGEST]
        per = self.size // 4
        for _ in range(difat_count):
            if difat > LARGEST:
                break
            *more, difat = struct.unpack(f"<{per}I", self._sector(difat))
            tables += [s for s in more if s <= LARGEST]
        self.table = [x for s in tables for x in struct.unpack(f"<{per}I", self._sector(s))]
        raw = self._chain(directory)
        self.entries = [e for i in range(0, len(raw) - 127, 128) if (e := self._entry(raw[i : i + 128]))]
        root = next((e for e in self.entries if e["kind"] == 5), None)
        self.mini_table = [x for (x,) in struct.iter_unpack("<I", self._chain(mini_table))] if mini_table <= LARGEST else []
        self.mini = self._chain(root["start"])[: root["size"]] if root and root["start"] <= LARGEST else b""

    def _sector(self, number: int) -> bytes:
        at = (number + 1) * self.size
        return self.content[at : at + self.size].ljust(self.size, b"\0")

    def _chain(self, start: int) -> bytes:
        out, seen = [], set()
        while start <= LARGEST:
            if start in seen or start >= len(self.table):
                raise ValueError("broken sector chain")
            seen.add(start)
            out.append(self._sector(start))
            start = self.table[start]
        return b"".join(out)

    @staticmethod
    def _entry(raw: bytes) -> dict | None:
        length, kind = struct.unpack_from("<HB", raw, 64)
        if kind not in (1, 2, 5) or not 2 <= length <= 64:
            return None
        start, size = struct.unpack_from("<IQ", raw, 116)
        return {"name": raw[: length - 2].decode("utf-16-le"), "kind": kind, "start": start, "size": size & 0xFFFFFFFF}

    def read(self, entry: dict) -> bytes:
        """Content of a stream; small ones lie in the mini stream."""
        if entry["size"] >= self.cutoff:
            return self._chain(entry["start"])[: entry["size"]]
        out, at, seen = [], entry["start"], set()
        while at <= LARGEST and len(out) * self.mini_size < entry["size"]:
            if at in seen or at >= len(self.mini_table):
                raise ValueError("broken mini chain")
            seen.add(at)
            out.append(self.mini[at * self.mini_size : (at + 1) * self.mini_size])
            at = self.mini_table[at]
        return b"".join(out)[: entry["size"]]


def compound_streams(content: bytes) -> list[dict]:
    """Name and size of every stream of a compound file, and whether it could be read in full."""
    file = CompoundFile(content)
    return [{"member": e["name"], "size": e["size"], "complete": len(file.read(e)) == e["size"]} for e in file.entries if e["kind"] == 2]


def _readable(archive: zipfile.ZipFile, info: zipfile.ZipInfo) -> bool:
    """Whether a member has its stated size and checksum."""
    size = 0
    try:
        with archive.open(info) as member:
            while chunk := member.read(1 << 20):
                size += len(chunk)
    except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError):
        return False
    return size == info.file_size


def package_members(content: bytes) -> list[dict]:
    """Members of an ODF package with their sizes, and whether each could be read in full; the type must come first and uncompressed, names must be safe and unique."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        infos = archive.infolist()
        first = infos[0] if infos else None
        if first is None or first.filename != "mimetype" or first.compress_type != zipfile.ZIP_STORED:
            raise ValueError("the type isn't the first member, stored")
        if not archive.read(first).decode("ascii", "replace").startswith(MIMETYPE):
            raise ValueError("no ODF type")
        names = [i.filename for i in infos]
        if len(set(names)) != len(names) or any(n.startswith("/") or ".." in n.split("/") for n in names):
            raise ValueError("unsafe or repeated member names")
        if any(i.flag_bits & 1 for i in infos):
            raise ValueError("encrypted member")
        return [{"member": i.filename, "size": i.file_size, "complete": _readable(archive, i)} for i in infos]


def directory_members(content: bytes) -> list[dict]:
    """As :func:`package_members`, by another reader: the central directory and the local headers walked as bytes, each member inflated and summed here.

    A member whose local header names another file, or that has another size
    or checksum than the directory says, isn't complete.
    """
    end = content.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of a central directory")
    count, at = struct.unpack_from("<H", content, end + 10)[0], struct.unpack_from("<I", content, end + 16)[0]
    made: list[dict] = []
    for number in range(count):
        signature, flags, method, crc, packed, size, names, extra, comment, start = struct.unpack_from("<I4xHH4xIIIHHH8xI", content, at)
        if signature != 0x02014B50:
            raise ValueError("broken central directory")
        raw = content[at + 46 : at + 46 + names]
        name = raw.decode("utf-8" if flags & 0x800 else "cp437")
        at += 46 + names + extra + comment
        if flags & 1:
            raise ValueError("encrypted member")
        local, local_method, local_names, local_extra = struct.unpack_from("<I4xH16xHH", content, start)
        body = start + 30 + local_names + local_extra
        data = content[body : body + packed]
        if number == 0 and (name != "mimetype" or method or not data.decode("ascii", "replace").startswith(MIMETYPE)):
            raise ValueError("the type isn't the first member, stored")
        if name.startswith("/") or ".." in name.split("/") or any(m["member"] == name for m in made):
            raise ValueError("unsafe or repeated member names")
        fits = local == 0x04034B50 and content[start + 30 : start + 30 + local_names] == raw and local_method == method and len(data) == packed
        try:
            plain = data if method == 0 else zlib.decompressobj(-15).decompress(data) if method == 8 else None
        except zlib.error:
            plain = None
        made.append({"member": name, "size": size, "complete": fits and plain is not None and len(plain) == size and zlib.crc32(plain) == crc})
    if not made:
        raise ValueError("the type isn't the first member, stored")
    return made


def reviewed_containers(files: DataFrame) -> DataFrame:
    """Members on which the two readers of packages disagree: ``path, member`` and what each says, nulls where one has none."""
    one = inspect_containers(files, package_members).select("path", "member", F.struct("size", "complete").alias("first"), F.col("error").isNotNull().alias("first_failed"))
    two = inspect_containers(files, directory_members).select("path", "member", F.struct("size", "complete").alias("second"), F.col("error").isNotNull().alias("second_failed"))
    both = one.join(two, one.path.eqNullSafe(two.path) & one.member.eqNullSafe(two.member), "full_outer")
    both = both.select(F.coalesce(one.path, two.path).alias("path"), F.coalesce(one.member, two.member).alias("member"), "first", "second", "first_failed", "second_failed")
    return both.where(~F.col("first").eqNullSafe(F.col("second")) | ~F.col("first_failed").eqNullSafe(F.col("second_failed")))


def inspect_containers(files: DataFrame, parser) -> DataFrame:
    """Members of ``(path, content)`` containers; one that can't be read gives one row with ``error``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                error = None
                try:
                    rows = parser(content)
                except (ValueError, struct.error, zipfile.BadZipFile) as problem:
                    rows, error = [{}], f"{type(problem).__name__}: {problem}"
                columns = [pa.array([path] * len(rows)), pa.array([error] * len(rows), pa.string())]
                columns += [pa.array([r.get(n) for r in rows], t) for n, t in (("member", pa.string()), ("size", pa.int64()), ("complete", pa.bool_()))]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "error", "member", "size", "complete"])

    return files.select("path", "content").mapInArrow(run, "path string, error string, member string, size bigint, complete boolean")


def deterministic_tar(members: dict[str, bytes]) -> bytes:
    """A tar archive that depends on the members' names and contents alone."""
    import tarfile

    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=tarfile.USTAR_FORMAT) as archive:
        for name in sorted(members):
            info = tarfile.TarInfo(name)
            info.size, info.mode, info.mtime = len(members[name]), 0o644, 0
            archive.addfile(info, io.BytesIO(members[name]))
    return out.getvalue()
