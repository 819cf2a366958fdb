"""Topics kept as a log of Parquet segments: a Spark data source to read and write, batch or stream.

A task writes its records of each topic as a segment under a name of its own. The driver
then writes one manifest that gives the segments their places in their topics; only what a
manifest lists exists for readers. So a task or job that breaks off leaves nothing visible,
and a batch that is committed already is not committed again. A manifest carries the ends of
all topics, so the newest one tells how far each topic reaches, and a reader goes back only as
far as the manifests it has not read.

The folder may be on any file system that Arrow knows and all executors reach. One job
commits to a log at a time. Options: ``path``; reading: ``topics``, by comma (default: all);
writing: ``writer`` and, outside a stream, ``batch``, by which repeats are told: a writer's
batches are numbered upwards.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter,
    DataSourceStreamReader, InputPartition, WriterCommitMessage)

FORMAT = "cardweave_topics"
SCHEMA = "key string, value string, topic string, headers array<struct<key:string,value:binary>>"
ARROW = pa.schema([
    ("key", pa.string()), ("value", pa.string()), ("topic", pa.string()),
    ("headers", pa.list_(pa.struct([("key", pa.string()), ("value", pa.binary())])))])
NOTHING = {"number": 0, "ends": {}, "done": {}, "segments": []}


class Log:
    """Manifests and segments below a folder."""

    def __init__(self, path: str) -> None:
        self.path = path

    def place(self, *parts: str) -> tuple[pafs.FileSystem, str]:
        files, root = pafs.FileSystem.from_uri(self.path)
        return files, "/".join([root.rstrip("/"), *parts])

    def manifest(self, number: int) -> dict:
        if not number:
            return NOTHING
        files, name = self.place("manifests", f"{number:012d}.json")
        with files.open_input_stream(name) as stream:
            return json.loads(stream.read())

    def newest(self) -> dict:
        files, folder = self.place("manifests")
        found = files.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        numbers = [int(f.base_name[:12]) for f in found if f.base_name.endswith(".json")]
        return self.manifest(max(numbers, default=0))

    def between(self, start: dict[str, int], end: dict[str, int]) -> list[Segment]:
        """Segments of the topics of ``end`` that lie between the two offsets, which fall on segment ends."""
        out, at = [], self.newest()
        while any(at["ends"].get(t, 0) > start.get(t, 0) for t in end):
            out += [Segment(*s) for s in at["segments"]
                    if s[0] in end and start.get(s[0], 0) <= s[2] and s[2] + s[3] <= end[s[0]]]
            at = self.manifest(at["number"] - 1)
        return sorted(out, key=lambda s: (s.topic, s.first))

    def commit(self, written: list[tuple[str, str, int]], writer: str, batch: int) -> bool:
        """Make segments (topic, file, rows) visible; False where the writer's batch is there already."""
        last = self.newest()
        if batch <= last["done"].get(writer, -1):
            return False
        ends, segments = dict(last["ends"]), []
        for topic, file, rows in sorted(written):
            segments.append([topic, file, ends.get(topic, 0), rows])
            ends[topic] = ends.get(topic, 0) + rows
        number = last["number"] + 1
        whole = {"number": number, "ends": ends, "done": {**last["done"], writer: batch}, "segments": segments}
        files, name = self.place("manifests", f"{number:012d}.json")
        files.create_dir(name.rsplit("/", 1)[0])
        draft = f"{name}.{uuid.uuid4().hex}.part"
        with files.open_output_stream(draft) as stream:
            stream.write(json.dumps(whole).encode())
        files.move(draft, name)
        return True


@dataclass
class Segment(InputPartition):
    """``rows`` records of a topic, the first of which has the offset ``first``."""

    topic: str
    file: str
    first: int
    rows: int


@dataclass
class Written(WriterCommitMessage):
    """Segments of one task as (topic, file, rows)."""

    segments: list[tuple[str, str, int]]


class _Reading:
    def __init__(self, options: dict[str, str]) -> None:
        self.log = Log(options["path"])
        named = options.get("topics")
        self.topics = [t.strip() for t in named.split(",")] if named else None

    def ends(self) -> dict[str, int]:
        ends = self.log.newest()["ends"]
        return {t: ends.get(t, 0) for t in self.topics} if self.topics else dict(ends)

    def read(self, partition: Segment | None) -> Iterator[pa.RecordBatch]:
        if partition is None:       # Spark's one partition of a read that has none
            return
        files, name = self.log.place("segments", partition.file)
        with pq.ParquetFile(name, filesystem=files) as segment:
            for batch in segment.iter_batches(batch_size=10_000):
                yield batch.cast(ARROW)


class TopicReader(_Reading, DataSourceReader):
    def partitions(self) -> list[Segment]:
        return self.log.between({}, self.ends())


class TopicStreamReader(_Reading, DataSourceStreamReader):
    """The offset of a stream is the number of records read, for each topic."""

    def initialOffset(self) -> dict[str, int]:
        return {t: 0 for t in self.topics or []}

    def latestOffset(self) -> dict[str, int]:
        return self.ends()

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[Segment]:
        return self.log.between(start, end)


class _Writing:
    def __init__(self, options: dict[str, str]) -> None:
        self.log = Log(options["path"])
        self.writer, self.batch = options.get("writer", "stream"), options.get("batch")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One segment for each topic of the task; memory holds one Arrow batch and a row group a topic."""
        task, open_segments, rows = uuid.uuid4().hex, {}, {}
        try:
            for batch in iterator:
                table = pa.Table.from_batches([batch]).select(ARROW.names).cast(ARROW)
                for topic in pc.unique(table["topic"]).to_pylist():
                    if topic is None:
                        raise ValueError("a record without a topic cannot be published")
                    part = table.filter(pc.equal(table["topic"], topic))
                    if topic not in open_segments:
                        files, name = self.log.place("segments", f"{task}-{len(open_segments)}.parquet")
                        files.create_dir(name.rsplit("/", 1)[0])
                        open_segments[topic] = (name.rsplit("/", 1)[1], pq.ParquetWriter(name, ARROW, filesystem=files))
                    open_segments[topic][1].write_table(part)
                    rows[topic] = rows.get(topic, 0) + part.num_rows
        finally:
            for _, segment in open_segments.values():
                segment.close()
        return Written([(topic, file, rows[topic]) for topic, (file, _) in open_segments.items()])

    def finish(self, messages: list[Written | None], batch: int) -> None:
        written = [s for m in messages if m for s in m.segments]
        if not self.log.commit(written, self.writer, batch):
            self.forget(messages)

    def forget(self, messages: list[Written | None]) -> None:
        """Delete segments that no manifest lists."""
        for message in messages:
            for _, file, _ in message.segments if message else []:
                files, name = self.log.place("segments", file)
                files.delete_file(name)


class TopicWriter(_Writing, DataSourceArrowWriter):
    def commit(self, messages: list[Written | None]) -> None:
        self.finish(messages, int(self.batch))

    def abort(self, messages: list[Written | None]) -> None:
        self.forget(messages)


class TopicStreamWriter(_Writing, DataSourceStreamArrowWriter):
    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self.finish(messages, batchId)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self.forget(messages)


class TopicSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TopicReader:
        return TopicReader(self.options)

    def streamReader(self, schema) -> TopicStreamReader:
        return TopicStreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> TopicWriter:
        if overwrite or self.options.get("batch") is None:
            raise ValueError("a log is appended to, under the option batch")
        return TopicWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> TopicStreamWriter:
        return TopicStreamWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to a session; executors need nothing installed but pyarrow."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(TopicSource)


def read_log(spark: SparkSession, path: str, topics: list[str] | None = None,
             streaming: bool = False) -> DataFrame:
    """Records of some topics or of all: key, value, topic, headers."""
    register(spark)
    source = (spark.readStream if streaming else spark.read).format(FORMAT).option("path", path)
    return (source.option("topics", ",".join(topics)) if topics else source).load()


def as_records(rows: DataFrame) -> DataFrame:
    """The four columns of the log; headers may be absent."""
    headers = F.col("headers") if "headers" in rows.columns else F.lit(None)
    kind = "array<struct<key:string,value:binary>>"
    return rows.select("key", "value", "topic", headers.cast(kind).alias("headers"))


def publish_log(rows: DataFrame, path: str, writer: str, batch: int) -> None:
    """Append records to the topics they name; a batch that the writer has published already adds nothing."""
    register(rows.sparkSession)
    as_records(rows).write.format(FORMAT).mode("append").option("path", path).option(
        "writer", writer).option("batch", str(batch)).save()
