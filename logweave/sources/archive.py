"""SRC7 and SNK3 as Python data sources: text archives written and replayed batch by batch.

``text_archive`` (reader) replays ``root/<folder>/<file>`` in the order of folder and file
names, numbers inside names by value (``Tweets_2`` before ``Tweets_10``), whatever the file
times.  The stream's offset is the name of the last replayed file, so a restart goes on with
the one after it, and folders that are added later follow.  The reader hands out file names
only; the lines are read by the tasks.  Empty files give no batch.

``text_batches`` (writer) puts each non-empty micro-batch into ``root/<prefix><padded id>`` as
one file per task.  Tasks write to a staging folder and report what they wrote; the commit
moves the files, then writes ``_manifest.json`` with their names.  A batch that runs again
replaces its folder; files of a failed batch are removed.

Files are reached through ``pyarrow.fs`` (local, HDFS, S3, GCS paths), since data source code
runs outside the JVM; a store that only Spark can open does not work here.
"""

from __future__ import annotations

import fnmatch
import json
import posixpath
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, SimpleDataSourceStreamReader, WriterCommitMessage

MANIFEST = "_manifest.json"
_BLOCK = 1 << 20


def _fs(path: str):
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)
    return system, inner.rstrip("/")


def natural_key(name: str) -> list:
    """Sort key of a path: text by code point, runs of digits by value."""
    return [[(1, int(p), p) if p.isdigit() else (0, 0, p) for p in re.split(r"([0-9]+)", part)] for part in name.split("/")]


def archive_files(root: str, dir_glob: str, file_glob: str) -> list[str]:
    """``folder/file`` of the archive's non-empty files in replay order; a folder with a manifest has the files it names."""
    from pyarrow import fs

    system, base = _fs(root)
    out = []
    for d in system.get_file_info(fs.FileSelector(base, allow_not_found=True)):
        if d.type != fs.FileType.Directory or not fnmatch.fnmatchcase(d.base_name, dir_glob):
            continue
        files = {f.base_name: f for f in system.get_file_info(fs.FileSelector(d.path)) if f.type == fs.FileType.File}
        names = list(files)
        if MANIFEST in files:
            with system.open_input_stream(f"{d.path}/{MANIFEST}") as f:
                names = [n for n in json.loads(f.read())["files"] if n in files]
        out += [f"{d.base_name}/{n}" for n in names if files[n].size and fnmatch.fnmatchcase(n, file_glob)]
    return sorted(out, key=natural_key)


def text_lines(stream):
    """Lines of a byte stream, ended by LF, CR LF or CR, block by block."""
    rest, cr = b"", False
    while block := stream.read(_BLOCK):
        if cr and block.startswith(b"\n"):
            block = block[1:]
        cr = block.endswith(b"\r")
        parts = re.split(rb"\r\n|\n|\r", rest + block)
        rest = parts.pop()
        yield from parts
    if rest:
        yield rest


class _Files(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.root = options["path"]
        self.globs = options.get("dirGlob", "Tweets_*"), options.get("fileGlob", "part-*")
        self.per_batch = int(options.get("filesPerBatch", 1))

    def _after(self, name: str) -> list[str]:
        return [f for f in archive_files(self.root, *self.globs) if not name or natural_key(f) > natural_key(name)]

    def initialOffset(self) -> dict:
        return {"after": ""}

    def read(self, start: dict):
        files = self._after(start["after"])[:self.per_batch]
        return iter([(f,) for f in files]), {"after": files[-1]} if files else start

    def readBetweenOffsets(self, start: dict, end: dict):
        return iter([(f,) for f in self._after(start["after"]) if end["after"] and natural_key(f) <= natural_key(end["after"])])

    def commit(self, end: dict) -> None:
        pass


class TextArchive(DataSource):
    @classmethod
    def name(cls) -> str:
        return "text_archive"

    def schema(self) -> str:
        return "file string"

    def simpleStreamReader(self, schema):
        return _Files(self.options)


def _read_lines(root: str):
    def run(batches):
        import pandas as pd

        system, base = _fs(root)
        for pdf in batches:
            for name in pdf["file"]:
                lines = []
                with system.open_input_stream(f"{base}/{name}") as f:
                    for line in text_lines(f):
                        lines.append(line.decode("utf-8", "replace"))
                        if len(lines) == 4096:
                            yield pd.DataFrame({"value": lines, "file": name})
                            lines = []
                if lines:
                    yield pd.DataFrame({"value": lines, "file": name})
    return run


def replay(spark: SparkSession, root: str, dir_glob: str = "Tweets_*", file_glob: str = "part-*",
           files_per_batch: int = 1) -> DataFrame:
    """SRC7: lines (value, file) of an archive, ``files_per_batch`` files a micro-batch, in name order."""
    spark.dataSource.register(TextArchive)
    files = (spark.readStream.format("text_archive").option("path", root).option("dirGlob", dir_glob)
             .option("fileGlob", file_glob).option("filesPerBatch", files_per_batch).load())
    if files_per_batch > 1:
        files = files.repartition("file")
    return files.mapInPandas(_read_lines(root), "value string, file string")


@dataclass
class _Part(WriterCommitMessage):
    path: str
    task: int
    rows: int


class _Batches(DataSourceStreamWriter):
    def __init__(self, options):
        self.root, self.prefix, self.width = options["path"], options.get("prefix", "Tweets_"), int(options.get("width", 10))

    def write(self, iterator):
        from pyspark import TaskContext

        system, base = _fs(self.root)
        path, rows, out = f"_staging/{uuid.uuid4().hex}", 0, None
        for row in iterator:
            if out is None:
                system.create_dir(f"{base}/_staging", recursive=True)
                out = system.open_output_stream(f"{base}/{path}")
            out.write(((row[0] or "") + "\n").encode())
            rows += 1
        if out is not None:
            out.close()
        return _Part(path if rows else "", TaskContext.get().partitionId(), rows)

    def commit(self, messages, batchId: int) -> None:
        parts = sorted((m for m in messages if m and m.rows), key=lambda m: m.task)
        system, base = _fs(self.root)
        from pyarrow import fs
        folder = f"{base}/{self.prefix}{batchId:0{self.width}d}"
        if system.get_file_info(folder).type != fs.FileType.NotFound:
            system.delete_dir(folder)
        if not parts:
            return
        system.create_dir(folder, recursive=True)
        names = [f"part-{i:05d}" for i in range(len(parts))]
        for m, n in zip(parts, names):
            system.move(f"{base}/{m.path}", f"{folder}/{n}")
        with system.open_output_stream(f"{folder}/{MANIFEST}") as f:
            f.write(json.dumps({"batch": batchId, "rows": sum(m.rows for m in parts), "files": names}).encode())

    def abort(self, messages, batchId: int) -> None:
        system, base = _fs(self.root)
        for m in messages:
            if m and m.path:
                try:
                    system.delete_file(posixpath.join(base, m.path))
                except FileNotFoundError:
                    pass


class TextBatches(DataSource):
    @classmethod
    def name(cls) -> str:
        return "text_batches"

    def schema(self) -> str:
        return "value string"

    def streamWriter(self, schema, overwrite: bool):
        return _Batches(self.options)


def text_batches(df: DataFrame, root: str, prefix: str = "Tweets_"):
    """SNK3 + F4: a stream writer that keeps the first column's texts, one folder per non-empty batch."""
    df.sparkSession.dataSource.register(TextBatches)
    return (df.select(df[df.columns[0]].cast("string").alias("value")).writeStream.format("text_batches")
            .option("path", root).option("prefix", prefix).outputMode("append"))
