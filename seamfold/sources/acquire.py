"""Getting match documents to where Spark reads them: a folder, an archive or a download.

This runs on the driver, once, before any job; what it returns is a list of paths. The
network is behind `fetch`, so that tests need none.
"""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import zipfile
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path, PurePosixPath
from urllib import parse, request

from seamfold.errors import SourceError, UnsafeArchive

PIECE = 1 << 16
MARKER = ".acquired.json"
MAX_DOWNLOAD, MAX_UNPACKED, MAX_ENTRIES = 200 << 20, 2 << 30, 50_000

Fetch = Callable[[str], Iterable[bytes]]


@dataclass(frozen=True)
class Acquired:
    files: list[Path]
    folder: Path | None = None
    archive: Path | None = None
    sha256: str | None = None
    from_cache: bool = False


def check_url(url: str, hosts: Iterable[str]) -> str:
    """The url itself if it is https and its host is listed."""
    parts = parse.urlsplit(url)
    if parts.scheme != "https":
        raise SourceError(f"only https is allowed, not {url!r}")
    if parts.hostname not in set(hosts):
        raise SourceError(f"{parts.hostname!r} is not among {sorted(hosts)}")
    return url


class _Redirects(request.HTTPRedirectHandler):
    """Follows a redirect only to where a first request could have gone."""

    def __init__(self, hosts: Iterable[str]) -> None:
        self.hosts = frozenset(hosts)

    def redirect_request(self, req, fp, code, msg, headers, newurl):
        return super().redirect_request(req, fp, code, msg, headers, check_url(newurl, self.hosts))


def https_fetch(hosts: Iterable[str], timeout: float = 60.0) -> Fetch:
    """A fetch over the network that checks every redirect."""
    opener = request.build_opener(_Redirects(hosts))

    def fetch(url: str) -> Iterator[bytes]:
        with opener.open(url, timeout=timeout) as answer:
            yield from iter(lambda: answer.read(PIECE), b"")

    return fetch


def file_sha256(path: Path) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def download(url: str, to: Path, hosts: Iterable[str], max_bytes: int = MAX_DOWNLOAD, fetch: Fetch | None = None) -> Path:
    """Write what url holds to a file; nothing is left behind if it is too much or fails."""
    check_url(url, hosts)
    to.parent.mkdir(parents=True, exist_ok=True)
    part, left = to.with_name(to.name + ".part"), max_bytes
    try:
        with open(part, "wb") as out:
            for piece in (fetch or https_fetch(hosts))(url):
                left -= len(piece)
                if left < 0:
                    raise SourceError(f"{url!r} holds more than {max_bytes} bytes")
                out.write(piece)
        os.replace(part, to)
    except OSError as e:
        raise SourceError(f"{url!r} could not be read: {e}") from e
    finally:
        part.unlink(missing_ok=True)
    return to


def entry_path(folder: Path, name: str) -> Path:
    """Where an archive's entry goes; only ever below the folder."""
    inner = PurePosixPath(name.replace("\\", "/"))
    if inner.is_absolute() or ".." in inner.parts or (inner.parts and inner.parts[0].endswith(":")):
        raise UnsafeArchive(f"{name!r} leaves the archive's folder")
    whole = (folder / inner).resolve()
    if not whole.is_relative_to(folder.resolve()):
        raise UnsafeArchive(f"{name!r} leaves the archive's folder")
    return whole


def unpack(archive: Path, folder: Path, max_bytes: int = MAX_UNPACKED, max_entries: int = MAX_ENTRIES) -> list[Path]:
    """The files of a zip archive; sizes are checked as stated and again as they come out."""
    folder.mkdir(parents=True, exist_ok=True)
    try:
        with zipfile.ZipFile(archive) as z:
            entries = z.infolist()
            if len(entries) > max_entries:
                raise UnsafeArchive(f"{len(entries)} entries, more than {max_entries}")
            if sum(e.file_size for e in entries) > max_bytes:
                raise UnsafeArchive(f"more than {max_bytes} bytes unpacked")
            # all names are checked before anything is written
            places = [(e, entry_path(folder, e.filename)) for e in entries]
            out, left = [], max_bytes
            for e, place in places:
                if e.is_dir():
                    place.mkdir(parents=True, exist_ok=True)
                    continue
                place.parent.mkdir(parents=True, exist_ok=True)
                with z.open(e) as source, open(place, "wb") as to:
                    for piece in iter(lambda: source.read(PIECE), b""):  # noqa: B023
                        left -= len(piece)
                        if left < 0:
                            raise UnsafeArchive(f"more than {max_bytes} bytes unpacked")
                        to.write(piece)
                out.append(place)
            return out
    except zipfile.BadZipFile as e:
        raise UnsafeArchive(f"{archive} is no zip archive") from e


def read_marker(path: Path) -> str | None:
    """The hash of the archive that was unpacked last; an unreadable marker is none."""
    try:
        return json.loads(path.read_text(encoding="utf-8"))["sha256"]
    except (OSError, ValueError, KeyError, TypeError):
        return None


def write_marker(path: Path, sha256: str, n_files: int) -> None:
    path.write_text(json.dumps({"n_files": n_files, "sha256": sha256}), encoding="utf-8")


def documents(folder: Path) -> list[Path]:
    return sorted(folder.rglob("*.json"))


def acquire(to: Path, folder: Path | None = None, archive: Path | None = None, url: str | None = None, hosts: Iterable[str] = (), max_download: int = MAX_DOWNLOAD, max_unpacked: int = MAX_UNPACKED, max_entries: int = MAX_ENTRIES, fetch: Fetch | None = None) -> Acquired:
    """Match documents from a folder, else an archive, else a url; the same archive is unpacked once."""
    if folder is not None:
        return Acquired(documents(Path(folder)), from_cache=True)
    if archive is None and url is None:
        raise SourceError("a folder, an archive or a url is needed")
    to = Path(to)
    to.mkdir(parents=True, exist_ok=True)
    archive = Path(archive) if archive is not None else download(url, to / "archive.zip", hosts, max_download, fetch)
    sha256, unpacked, marker = file_sha256(archive), to / "extracted", to / MARKER
    if read_marker(marker) == sha256 and (found := documents(unpacked) if unpacked.is_dir() else []):
        return Acquired(found, unpacked, archive, sha256, from_cache=True)
    if unpacked.is_dir():
        shutil.rmtree(unpacked)
    unpack(archive, unpacked, max_unpacked, max_entries)
    found = documents(unpacked)
    write_marker(marker, sha256, len(found))
    return Acquired(found, unpacked, archive, sha256)
