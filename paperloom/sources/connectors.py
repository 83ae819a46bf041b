"""Document connectors as Python data sources; systems without a client here are named but refuse to run."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "id string, name string, uri string, content binary"


class Connector(DataSource):
    """Base of all connectors: rows of (id, name, uri, content)."""

    def schema(self) -> str:
        return SCHEMA


class _Files(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.root, self.prefix = options["path"], options.get("prefix", "")

    def partitions(self) -> list[InputPartition]:
        names = sorted(os.path.join(d, f) for d, _, files in os.walk(self.root) for f in files if f.lower().endswith((".pdf", ".docx", ".txt")) and f.startswith(self.prefix))
        return [InputPartition(n) for n in names]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        path = partition.value
        with open(path, "rb") as f:
            yield os.path.relpath(path, self.root), os.path.basename(path), path, f.read()


class LocalDocuments(Connector):
    """Files of a folder that every worker sees; for object stores use ``files.list_documents``."""

    @classmethod
    def name(cls) -> str:
        return "local_documents"

    def reader(self, schema) -> DataSourceReader:
        return _Files(self.options)


def _unavailable(system: str) -> type[Connector]:
    class Unavailable(Connector):
        @classmethod
        def name(cls) -> str:
            return system

        def reader(self, schema) -> DataSourceReader:
            raise NotImplementedError(f"no client for {system}: supply a connector of that name")

    return Unavailable


SharePoint, Confluence, GoogleDrive, Salesforce = map(_unavailable, ("sharepoint", "confluence", "gdrive", "salesforce"))


def register(spark: SparkSession) -> None:
    for source in (LocalDocuments, SharePoint, Confluence, GoogleDrive, Salesforce):
        spark.dataSource.register(source)
