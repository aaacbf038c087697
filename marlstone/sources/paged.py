"""A data source over a ledger of fetched pages: one partition per page, so a fetch can be replayed without the network."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class _Page(InputPartition):
    def __init__(self, path: str, number: int) -> None:
        self.path, self.number = path, number


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.folder, self.items = options["path"], options.get("items", "items")

    def partitions(self) -> list[_Page]:
        pages = sorted(Path(self.folder).glob("page-*.json"))
        numbers = [int(p.stem.split("-")[1]) for p in pages]
        if numbers != list(range(1, len(numbers) + 1)):
            raise ValueError("the ledger has gaps in its pages")
        return [_Page(str(p), n) for p, n in zip(pages, numbers, strict=True)]

    def read(self, partition: _Page):
        for place, item in enumerate(json.loads(Path(partition.path).read_text())[self.items]):
            yield partition.number, place, json.dumps(item, ensure_ascii=False, sort_keys=True)


class PageLedger(DataSource):
    """spark.dataSource.register(PageLedger); spark.read.format("page_ledger").option("items", "results").load(folder)."""

    @classmethod
    def name(cls) -> str:
        return "page_ledger"

    def schema(self) -> str:
        return "page int, place int, item string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def append_page(folder: str, number: int, body: dict) -> bool:
    """Writes page `number` once; the same body again is a replay (False), another body raises."""
    path = Path(folder) / f"page-{number:06d}.json"
    text = json.dumps(body, ensure_ascii=False, sort_keys=True)
    if path.exists():
        if path.read_text() != text:
            raise ValueError(f"page {number} came back with another content")
        return False
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_suffix(".part")
    part.write_text(text)
    part.rename(path)
    return True
