"""`serp`: a Python data source over landed search answers (JSON lines), scanned one file a task."""

from __future__ import annotations

import json
from collections.abc import Iterator
from io import TextIOWrapper

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        super().__init__(path)


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        import pyarrow.fs as fs

        store, path = self._store()
        found = store.get_file_info(fs.FileSelector(path, recursive=True))
        return [_File(f.path) for f in found if f.is_file and f.extension in ("json", "jsonl")]

    def _store(self):  # noqa: ANN202
        """The file system of the path's scheme, on the driver and on each executor."""
        import pyarrow.fs as fs

        path = self.options["path"]
        return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        most = int(self.options.get("results", "20"))
        with self._store()[0].open_input_stream(partition.value) as lines:
            for line in TextIOWrapper(lines, encoding="utf-8"):
                page = json.loads(line)
                if page.get("error"):
                    raise RuntimeError(f"search service: {page['error']}")
                for i, hit in enumerate(page.get("organic_results", [])[:most]):
                    yield page.get("query"), i + 1, hit.get("title"), hit.get("snippet"), hit.get("link")


class SerpSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "serp"

    def schema(self) -> str:
        return "query string, position int, title string, snippet string, link string"

    def reader(self, schema: StructType) -> DataSourceReader:
        if "path" not in self.options:
            raise ValueError("the serp source needs a path of landed answers")
        return _Reader(dict(self.options))
