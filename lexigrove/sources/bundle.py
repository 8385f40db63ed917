"""Bundles as a Spark data source: one folder per book, published when all its files stand.

    register(spark)
    write_bundles(entries, path)
    spark.read.format("bundle").load(path)

A bundle has a markdown file per entry, optional passages and regions, ``index.md``, ``toc.md``,
``metadata.json`` with the manifest and the tree of entries, and ``run-manifest.json``.  Readers go by
``metadata.json``, so a bundle whose write failed is not seen, and one that is written anew is the
old one until the commit.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

#: Entries of books; `rag_text` and `spatial` (JSON of its pages) may be null.
ENTRY = "book string, seq int, entry_id string, kind string, level int, parent_id string, title string, page_label string, output_path string, text string, rag_text string, spatial string"
PUBLISHED = ("index.md", "toc.md", "run-manifest.json", "metadata.json")  # readers go by the last one
#: Columns whose equality with values reaches the reader.
PUSHED = ("book", "entry_id", "kind")
#: Books that one task reads.
BOOKS_A_TASK = 16


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    system, root = fs.FileSystem.from_uri(path)
    return system, root.rstrip("/")


def _put(system: fs.FileSystem, path: str, text: str) -> None:
    """Writes a file aside and moves it into place, so that a task that runs twice leaves a whole one."""
    system.create_dir(path.rpartition("/")[0], recursive=True)
    aside = f"{path}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(aside, compression=None) as out:
        out.write(text.encode())
    system.move(aside, path)


def _get(system: fs.FileSystem, path: str) -> str:
    with system.open_input_stream(path, compression=None) as file:
        return file.read().decode()


def _dump(value: object) -> str:
    return json.dumps(value, indent=2, ensure_ascii=False) + "\n"


def tree(entries: list[dict]) -> list[dict]:
    """The entries of one book under their parents, in order; entries of an unknown parent are roots."""
    nodes = {e["entry_id"]: {k: e[k] for k in ("entry_id", "kind", "title", "page_label", "output_path")} | {"children": []} for e in entries}
    roots = []
    for e in entries:
        above = nodes.get(e["parent_id"])
        (above["children"] if above else roots).append(nodes[e["entry_id"]])
    return roots


def contents(entries: list[dict]) -> str:
    """The table of contents as a markdown list, indented by level."""
    lines = [f"{'  ' * max((e['level'] or 1) - 1, 0)}- [{e['title']}]({e['output_path']}) ({e['page_label'] or '?'})" for e in entries]
    return "\n".join(["# Table of Contents", "", *lines]).rstrip() + "\n"


def index(book: str, entries: list[dict]) -> str:
    some = lambda c: sum(bool(e[c]) for e in entries)
    lines = [f"# {book}", "", "## Bundle Contents", "", "- Metadata: [metadata.json](metadata.json)", "- Table of contents: [toc.md](toc.md)", f"- File count: {len(entries)}"]
    return "\n".join([*lines, f"- RAG linearized leaf exports: {some('rag_output_path')}", f"- Spatial sidecars: {some('spatial_output_path')}"]) + "\n"


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: the books, and the name under which their published files wait."""

    attempt: str
    books: list[str]


class BundleWriter(DataSourceArrowWriter):
    """Writes whole books: a task gets all rows of its books, in order."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        attempt, books = uuid.uuid4().hex, []
        try:
            self._write(iterator, attempt, books)
        except BaseException:
            self.abort([Written(attempt, books)])
            raise
        return Written(attempt, books)

    def _write(self, iterator: Iterator[pa.RecordBatch], attempt: str, books: list[str]) -> None:
        system, root = _opened(self.path)
        entries, book = [], None
        for batch in iterator:
            for row in batch.to_pylist():
                if not row["book"] or "/" in row["book"] or row["book"].startswith("."):
                    raise ValueError(f"a book's name must be that of a folder: {row['book']!r}")
                if row["book"] != book:
                    self._finish(system, root, attempt, book, entries)
                    if row["book"] in books:
                        raise ValueError(f"the entries of {row['book']} don't stand together: use write_bundles")
                    book, entries = row["book"], []
                    books.append(book)
                entries.append(self._entry(system, f"{root}/{book}", row))
        self._finish(system, root, attempt, book, entries)

    @staticmethod
    def _entry(system: fs.FileSystem, folder: str, row: dict) -> dict:
        """Writes an entry's files and returns its line of the manifest."""
        path = row["output_path"]
        if not path or path.startswith("/") or ".." in path.split("/") or path in PUBLISHED:
            raise ValueError(f"no path within a bundle: {path!r}")
        stem = path.removesuffix(".md")
        others = {"rag_output_path": ("rag_text", f"rag/{stem}.md"), "spatial_output_path": ("spatial", f"spatial/{stem}.json")}
        _put(system, f"{folder}/{path}", row["text"] or "")
        out = {k: row[k] for k in ("seq", "entry_id", "kind", "level", "parent_id", "title", "page_label", "output_path")}
        out["sha256"] = hashlib.sha256((row["text"] or "").encode()).hexdigest()
        for name, (column, target) in others.items():
            out[name] = target if row[column] is not None else None
            if row[column] is not None:
                _put(system, f"{folder}/{target}", row[column])
        return out

    @staticmethod
    def _finish(system: fs.FileSystem, root: str, attempt: str, book: str | None, entries: list[dict]) -> None:
        """Leaves a book's published files under the attempt's name."""
        if book is None:
            return
        digest = hashlib.sha256("".join(e["sha256"] for e in entries).encode()).hexdigest()
        metadata = {"book_id": book, "toc": tree(entries), "file_manifest": entries}
        run = {"book_id": book, "files": len(entries), "content_sha256": digest, "run": attempt}
        texts = {"index.md": index(book, entries), "toc.md": contents(entries), "run-manifest.json": _dump(run), "metadata.json": _dump(metadata)}
        for name, text in texts.items():
            _put(system, f"{root}/{book}/.{name}.{attempt}", text)

    def commit(self, messages: list[Written | None]) -> None:
        """Publishes all books; a book that two tasks wrote is an error, and nothing is published then."""
        system, root = _opened(self.path)
        seen: set[str] = set()
        written = [m for m in messages if m is not None]
        for m in written:
            twice = seen & set(m.books)
            if twice:
                self.abort(messages)
                raise ValueError(f"several tasks wrote {sorted(twice)[0]}: use write_bundles")
            seen |= set(m.books)
        for m in written:
            for book in m.books:
                for name in PUBLISHED:
                    system.move(f"{root}/{book}/.{name}.{m.attempt}", f"{root}/{book}/{name}")

    def abort(self, messages: list[Written | None]) -> None:
        """Removes what waits to be published; files of entries that nothing names stay and are written over."""
        system, root = _opened(self.path)
        for m in messages:
            for book in m.books if m is not None else ():
                for name in PUBLISHED:
                    path = f"{root}/{book}/.{name}.{m.attempt}"
                    if system.get_file_info(path).type != fs.FileType.NotFound:
                        system.delete_file(path)


@dataclass
class Books(InputPartition):
    names: list[str]


class BundleReader(DataSourceReader):
    """Reads the published bundles of a folder; filters on `PUSHED` columns spare files, those on `book` whole books."""

    def __init__(self, path: str, names: list[str], texts: bool):
        self.path, self.names, self.texts = path, names, texts
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if column in PUSHED:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted.get(column, values) & values
            else:
                yield f

    def partitions(self) -> list[Books]:
        system, root = _opened(self.path)
        found = sorted(i.base_name for i in system.get_file_info(fs.FileSelector(root)) if i.type == fs.FileType.Directory)
        books = [b for b in found if b in self.wanted.get("book", {b})]
        return [Books(books[i : i + BOOKS_A_TASK]) for i in range(0, len(books), BOOKS_A_TASK)] or [Books([])]

    def read(self, partition: Books) -> Iterator[tuple]:
        system, root = _opened(self.path)
        for book in partition.names:
            path = f"{root}/{book}/metadata.json"
            if system.get_file_info(path).type == fs.FileType.NotFound:
                continue
            for e in json.loads(_get(system, path))["file_manifest"]:
                if any(e[c] not in values for c, values in self.wanted.items() if c != "book"):
                    continue
                row = {"book": book, **e, "text": None, "rag_text": None, "spatial": None}
                for column, where in (("text", "output_path"), ("rag_text", "rag_output_path"), ("spatial", "spatial_output_path")):
                    if self.texts and e[where]:
                        row[column] = _get(system, f"{root}/{book}/{e[where]}")
                yield tuple(row[name] for name in self.names)


class BundleSource(DataSource):
    """``format("bundle")``.  Option ``texts`` ("false": columns of texts are null) reads manifests alone."""

    @classmethod
    def name(cls) -> str:
        return "bundle"

    def schema(self) -> str:
        return ENTRY

    def reader(self, schema: StructType) -> BundleReader:
        return BundleReader(self.options["path"], schema.fieldNames(), self.options.get("texts", "true").lower() != "false")

    def writer(self, schema: StructType, overwrite: bool) -> BundleWriter:
        return BundleWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    """Makes ``format("bundle")`` known to a session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BundleSource)


def write_bundles(entries: DataFrame, path: str) -> None:
    """Write ``entries`` (columns of `ENTRY`) as bundles, a folder of ``path`` for each book.

    A book's rows go to one task, which writes them in order.  All bundles are published when all
    tasks are done; those of other books in the folder stay.
    """
    names = [part.split()[0] for part in ENTRY.split(", ")]
    kinds = dict(part.split() for part in ENTRY.split(", "))
    typed = entries.select(*(entries[c].cast(kinds[c]).alias(c) for c in names))
    typed.repartition("book").sortWithinPartitions("book", "seq", "entry_id").write.format("bundle").mode("append").save(path)
