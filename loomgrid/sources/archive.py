"""Archiving recordings: verified copies or moves, with a manifest that is rewritten around each one.

Files of one recording are copied by the driver, as its local disk holds them; inventories of what is archived at
scale are compared as tables (``operators.inventory``).
"""

from __future__ import annotations

import hashlib
import os
import shutil
import uuid
from pathlib import Path

from loomgrid.sources.datasets import write_json


def local_inventory(root: Path, digests: bool = True) -> dict[str, tuple[int, str | None]]:
    """Relative path: (size, SHA-256) of all files; symbolic links are refused."""
    out: dict[str, tuple[int, str | None]] = {}
    for path in sorted(root.rglob("*")):
        if path.is_symlink():
            raise ValueError(f"symbolic link: {path}")
        if path.is_file():
            digest = None
            if digests:
                with path.open("rb") as file:
                    digest = hashlib.file_digest(file, "sha256").hexdigest()
            out[path.relative_to(root).as_posix()] = (path.stat().st_size, digest)
    return out


def destinations(bags: list[tuple[str, str | None]], archive: str) -> list[tuple[Path, Path]]:
    """(source, destination): below the archive, under the collection's name where there is one. Equal or nested ones are refused."""
    out = []
    for path, collection in bags:
        source, base = Path(path), Path(archive)
        inside = Path(source.name) if collection is None or Path(collection) == source else Path(Path(collection).name) / source.relative_to(collection)
        out.append((source, base / inside))
    places = sorted(d for _, d in out)
    for before, after in zip(places, places[1:], strict=False):
        if before == after or before in after.parents:
            raise ValueError(f"destinations overlap: {before} and {after}")
    for source, place in out:
        if source == place or source in place.parents or place in source.parents:
            raise ValueError(f"{source} and {place} overlap")
        if source == Path(archive) or Path(archive) in source.parents:
            raise ValueError(f"{source} lies in the archive {archive} already")
    return out


def archive_recordings(bags: list[tuple[str, str | None]], archive: str, move: bool = False, verify_existing: bool = False, digests: bool = True, manifest: str | None = None) -> dict:
    """Copy (or move) each recording and compare inventories before it gets its name; a source goes only after that.

    An existing destination is an error, or with ``verify_existing`` must equal the source. Returns the manifest:
    mode, verification, status, and source, destination, bytes and status of each recording.
    """
    plan = destinations(bags, archive)
    stock = {source: local_inventory(source, digests) for source, _ in plan}
    size = {source: sum(n for n, _ in files.values()) for source, files in stock.items()}
    os.makedirs(archive, exist_ok=True)
    needed = sum(size[s] for s, d in plan if not d.exists())
    if needed > shutil.disk_usage(archive).free:
        raise OSError(f"{needed} bytes don't fit in {archive}")
    rows = [{"source": str(s), "destination": str(d), "bytes": size[s], "status": "pending"} for s, d in plan]
    document = {"version": "1.0", "archive_directory": archive, "mode": "move" if move else "copy", "verification": "sha256" if digests else "size", "bags": rows, "status": "running"}

    def save() -> None:
        if manifest:
            write_json(document, manifest)

    save()
    try:
        for row, (source, place) in zip(rows, plan, strict=True):
            if place.exists():
                if not verify_existing or local_inventory(place, digests) != stock[source]:
                    raise FileExistsError(str(place))
                row["status"] = "verified"
            else:
                staging = place.parent / f".{place.name}.partial-{uuid.uuid4().hex}"
                place.parent.mkdir(parents=True, exist_ok=True)
                try:
                    shutil.copytree(source, staging)
                    if local_inventory(staging, digests) != stock[source]:
                        raise OSError(f"the copy of {source} differs")
                    staging.rename(place)
                finally:
                    shutil.rmtree(staging, ignore_errors=True)
                row["status"] = "archived"
            if move:
                shutil.rmtree(source)
            save()
        document["status"] = "complete"
    except BaseException:
        document["status"] = "failed"
        raise
    finally:
        save()
    return document
