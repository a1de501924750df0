"""Range reads of files from tasks, through the cluster's file system.

Spark's own readers carry the bulk of the data.  What they cannot do -- read the first record
of a file and no more, go on past the end of a split, read a range of fixed-length records
-- is done here with small ranged reads on any file system that Arrow knows (local and mounted
paths, HDFS, S3, GCS, Azure).
"""

from __future__ import annotations

import functools
import re
from urllib.parse import unquote

from pyarrow import fs

_URI = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)", re.S)
STEP = 1 << 16


@functools.lru_cache(maxsize=64)
def _file_system(scheme: str, authority: str):
    if scheme == "file":
        return fs.LocalFileSystem(), ""
    found, root = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return found, root.rstrip("/")


def locate(path: str, encoded: bool = True):
    """(file system, path in it) of a path or URI; ``encoded``: as ``_metadata.file_path``
    gives it, with escapes in the path."""
    m = _URI.fullmatch(path)
    if not m:
        return fs.LocalFileSystem(), path
    found, root = _file_system(m[1].lower(), m[2] or "")
    return found, root + (unquote(m[3]) if encoded else m[3])


def read_range(path: str, start: int, length: int, encoded: bool = True) -> bytes:
    found, inner = locate(path, encoded)
    with found.open_input_file(inner) as f:
        f.seek(start)
        return f.read(length)


def blocks(path: str, start: int = 0, step: int = STEP, encoded: bool = True):
    """A file's bytes from ``start`` on, block by block; compressed text is unpacked."""
    found, inner = locate(path, encoded)
    if re.search(r"\.(gz|bz2|lz4|zst)$", inner):
        with found.open_input_stream(inner, compression="detect") as f:
            f.read(start)
            while data := f.read(step):
                yield data
        return
    with found.open_input_file(inner) as f:
        f.seek(start)
        while data := f.read(step):
            yield data


def lines(path: str, start: int = 0, step: int = STEP):
    """Lines from ``start`` on, without their ends (LF, CRLF or CR, as Spark's text source cuts)."""
    rest = b""
    for data in blocks(path, start, step):
        rest += data
        if rest.endswith(b"\r"):      # its LF may come with the next block
            held, rest = rest[-1:], rest[:-1]
        else:
            held = b""
        *whole, last = re.split(rb"\r\n|\n|\r", rest)
        yield from whole
        rest = last + held
    if rest:
        yield from rest.splitlines()


def last_line_start(path: str, size: int, step: int = STEP) -> int:
    """Offset at which a file's last line begins."""
    end, tail = size, b""
    while end > 0:
        start = max(0, end - step)
        tail = read_range(path, start, end - start) + tail
        body = tail[:-2] if tail.endswith(b"\r\n") else tail[:-1] if tail.endswith((b"\n", b"\r")) else tail
        at = max(body.rfind(b"\n"), body.rfind(b"\r"))
        if at >= 0:
            return start + at + 1
        end = start
    return 0


def listed(path: str, suffix: str) -> list[tuple[str, int]]:
    """(path, size) of the files of a folder, a file or a glob whose names end with
    ``suffix``, as URIs where the path is one; hidden files are left out."""
    m = _URI.fullmatch(path)
    prefix = path[:len(path) - len(m[3])] if m else ""
    found, inner = locate(path, encoded=False)
    parts = inner.split("/")
    wild = next((i for i, p in enumerate(parts) if re.search(r"[*?\[]", p)), None)
    base = inner if wild is None else "/".join(parts[:wild]) or "/"
    info = found.get_file_info(base)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    files = [info] if info.type == fs.FileType.File else found.get_file_info(fs.FileSelector(base, recursive=True))
    match = None
    if wild is not None:
        import fnmatch
        match = re.compile("/".join(fnmatch.translate(p)[4:-3] if p else "" for p in parts).replace(".*", "[^/]*") + "(/.*)?")
    root = locate(prefix + "/", encoded=False)[1].rstrip("/") if m else ""
    out = []
    for f in files:
        if f.type != fs.FileType.File or not f.path.lower().endswith(suffix.lower()):
            continue
        below = f.path[len(base):].split("/")
        if any(p.startswith((".", "_")) and "=" not in p for p in below if p):
            continue
        if match is not None and not match.fullmatch(f.path):
            continue
        out.append((prefix + f.path[len(root):], f.size))
    return sorted(out)
