"""Landed payload files as a Spark data source.

Fetchers drop each response as one file ``<path>/<source>/<fetch_key>/<ord>.<any>``. This reads them as
the ``(source, fetch_key, payload, ord)`` rows the normalisers take:

    spark.dataSource.register(LandedPayloads)
    spark.read.format("landed_payloads").load("/landing/2024-01-31")

A partition is a lot of files of bounded size. The options ``sources`` and ``fetch_keys`` (comma lists)
prune folders before any file is listed below them. They are options, not pushed filters: Spark keeps
one pushed state per loaded frame, so two branches with different filters would read each other's
files. A file that is not
UTF-8 gives a row with replacement characters; a name without a number gives a null ``ord``.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyarrow import fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "source string, fetch_key string, payload string, ord bigint"
LOT_BYTES = 32 << 20
_NUMBER = re.compile(r"(\d+)")


class Lot(InputPartition):
    """Files of one task: ``(path, source, fetch_key)``."""

    def __init__(self, files: list):
        super().__init__(files)
        self.files = files


def _store(path: str):
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))


class LandedReader(DataSourceReader):
    def __init__(self, path: str, lot_bytes: int, only: dict[str, set] | None = None):
        self.path, self.lot_bytes, self.only = path.rstrip("/"), lot_bytes, only or {}

    def _folders(self, store, base: str, column: str):
        for info in store.get_file_info(pafs.FileSelector(base)):
            name = unquote(info.base_name)
            if info.type == pafs.FileType.Directory and not name.startswith(("_", ".")) and name in self.only.get(column, {name}):
                yield info.path, name

    def partitions(self):
        store, base = _store(self.path)
        lots, files, held = [], [], 0
        for folder, source in sorted(self._folders(store, base, "source")):
            for inner, key in sorted(self._folders(store, folder, "fetch_key")):
                for info in sorted(store.get_file_info(pafs.FileSelector(inner)), key=lambda i: i.path):
                    if info.type != pafs.FileType.File or info.base_name.startswith(("_", ".")):
                        continue
                    files.append((info.path, source, key))
                    held += info.size or 0
                    if held >= self.lot_bytes:
                        lots.append(Lot(files))
                        files, held = [], 0
        return lots + [Lot(files)] if files or not lots else lots

    def read(self, partition):
        store, _ = _store(self.path)
        for path, source, key in partition.files:
            with store.open_input_stream(path) as f:
                text = f.read().decode("utf-8", "replace")
            number = _NUMBER.match(path.rsplit("/", 1)[-1])
            yield source, key, text, int(number[1]) if number else None


class LandedPayloads(DataSource):
    """``format("landed_payloads")``; options ``path`` (or ``load(path)``), ``lot_bytes``, ``sources``, ``fetch_keys``."""

    @classmethod
    def name(cls) -> str:
        return "landed_payloads"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LandedReader:
        only = {column: {x.strip() for x in self.options[option].split(",")}
                for option, column in (("sources", "source"), ("fetch_keys", "fetch_key")) if option in self.options}
        return LandedReader(self.options["path"], int(self.options.get("lot_bytes", LOT_BYTES)), only)
