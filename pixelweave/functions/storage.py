"""Files as seen from inside a task."""

from __future__ import annotations

import re

import pyarrow.fs as pafs

_LOCATION = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)", re.DOTALL)


class Storage:
    """The file systems of one task, each opened once."""

    def __init__(self):
        self._known: dict[tuple[str, str], tuple[pafs.FileSystem, str]] = {}

    def locate(self, location: str) -> tuple[pafs.FileSystem, str]:
        """File system and path of a location.

        What follows scheme and authority is taken as it stands: Spark lists names
        unescaped, so a percent sign or a blank is part of the name.
        """
        match = _LOCATION.fullmatch(location)
        scheme, authority, path = match.groups() if match else ("file", "", location)
        place = scheme.lower(), authority or ""
        if place not in self._known:
            if place[0] == "file":
                self._known[place] = pafs.LocalFileSystem(), ""
            else:
                filesystem, base = pafs.FileSystem.from_uri(f"{scheme}://{place[1]}/")
                self._known[place] = filesystem, base.rstrip("/")
        filesystem, base = self._known[place]
        return filesystem, base + path

    def read(self, location: str | None) -> tuple[bytes | None, str | None]:
        """Bytes of a file, or the reason why it cannot be read."""
        if location is None:
            return None, "no path"
        try:
            filesystem, path = self.locate(location)
            # Not by its name's ending: the bytes are wanted as they are.
            with filesystem.open_input_stream(path, compression=None) as file:
                return file.read(), None
        except FileNotFoundError:
            return None, "not found"
        except OSError:
            return None, "unreadable"


def locate(location: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of one location."""
    return Storage().locate(location)
