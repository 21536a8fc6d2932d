"""A sink for mapping edges that checks them as it writes.

``guarded_edges`` is a Spark data source. Each task checks its edges and writes them to a
draft folder; only when every task has ended well are the files named in a commit, which is
what readers go by. A task that meets a forbidden edge leaves a mark beside its draft and
says so in its message; no task checks or writes more once it sees the mark, the commit fails,
and the drafts go. The task itself doesn't fail, since Spark would abort the write while other
tasks still run, which could leave drafts behind.
Endpoints are joined on before (``write_edges``), so that the sink sees, for each edge, what
its ends are.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from stelae.runtime import ship_package

EDGE = "type string, from_id string, to_id string, properties map<string,array<string>>"
#: What the sink sees beside an edge: the source of the node it leaves, and the labels of the node it enters.
SEEN = EDGE + ", from_source string, to_labels array<string>"


@dataclass(frozen=True)
class Rules:
    """Edge types and property names that may occur, those that must, the source that edges
    must leave (None: any) and the label that their target must have."""

    types: tuple[str, ...]
    allowed: tuple[str, ...]
    required: tuple[str, ...] = ()
    source: str | None = None
    target_label: str | None = None

    def refusal(self, edge: dict) -> str | None:
        """Why an edge can't be written, or None."""
        held = dict(edge["properties"] or [])
        if edge["type"] not in self.types:
            return "a type that isn't declared"
        if edge["from_source"] is None:
            return "no node where it begins"
        if edge["to_labels"] is None:
            return "no node where it ends"
        if self.source is not None and edge["from_source"] != self.source:
            return "it begins in another source"
        if self.target_label is not None and self.target_label not in edge["to_labels"]:
            return "its end isn't labelled as a target"
        for name in self.required:
            if not held.get(name):
                return f"no {name}"
        for name, values in held.items():
            if name not in self.allowed:
                return f"{name} isn't declared"
            # Properties are part of an edge's identity; nulls would merge what differs.
            if values is None or None in values:
                return f"a null in {name}"
        return None


def _place(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    edges: int
    refused: str | None = None
    stopped: bool = False


class GuardedEdgeWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.draft = options["path"].rstrip("/"), options["draft"]
        self.rules = Rules(**{k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(options["rules"]).items()})

    def _refused(self, batch) -> str | None:
        for edge in batch.to_pylist():
            why = self.rules.refusal(edge)
            if why:
                return f"edge {edge['type']} {edge['from_id']} -> {edge['to_id']}: {why}"
        return None

    def write(self, iterator) -> Written:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        system, base = _place(self.path)
        name, out, n, refused = f"{uuid.uuid4().hex}.parquet", None, 0, None
        mark, stopped = f"{base}/drafts/{self.draft}/refused", False
        system.create_dir(f"{base}/drafts/{self.draft}", recursive=True)
        try:
            for batch in iterator:  # to its end: Spark goes on sending
                stopped = stopped or system.get_file_info(mark).type != fs.FileType.NotFound
                if stopped:
                    continue
                refused = self._refused(batch)
                if refused:
                    stopped = True
                    system.open_output_stream(mark).close()
                    continue
                kept = pa.Table.from_batches([batch]).drop_columns(["from_source", "to_labels"])
                if out is None:
                    stream = system.open_output_stream(f"{base}/drafts/{self.draft}/{name}")
                    out = pq.ParquetWriter(stream, kept.schema)
                out.write_table(kept)
                n += len(batch)
        finally:
            if out is not None:
                out.close()
                stream.close()
        return Written(name if out is not None else None, n, refused, stopped)

    def commit(self, messages) -> None:
        stopped = [m.refused for m in messages if m is not None and m.stopped]
        if stopped:
            raise ValueError(next(filter(None, stopped), "an edge was refused"))
        system, base = _place(self.path)
        done = [m for m in messages if m is not None and m.file]
        system.create_dir(f"{base}/edges", recursive=True)
        for m in done:
            system.move(f"{base}/drafts/{self.draft}/{m.file}", f"{base}/edges/{m.file}")
        self._clear(system, base)
        # Files count from here on: readers take those that commits name.
        system.create_dir(f"{base}/commits", recursive=True)
        text = json.dumps({"files": [m.file for m in done], "edges": sum(m.edges for m in done)})
        with system.open_output_stream(f"{base}/drafts-{self.draft}.json") as stream:
            stream.write(text.encode())
        system.move(f"{base}/drafts-{self.draft}.json", f"{base}/commits/{self.draft}.json")

    def abort(self, messages) -> None:
        self._clear(*_place(self.path))

    def _clear(self, system, base) -> None:
        from pyarrow import fs

        folder = f"{base}/drafts/{self.draft}"
        if system.get_file_info(folder).type != fs.FileType.NotFound:
            system.delete_dir(folder)


class GuardedEdges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "guarded_edges"

    def schema(self) -> str:
        return SEEN

    def writer(self, schema, overwrite: bool) -> GuardedEdgeWriter:
        if overwrite:
            raise ValueError("edges are only added")
        return GuardedEdgeWriter(self.options)


def write_edges(edges: DataFrame, nodes: DataFrame, path: str, rules: Rules) -> None:
    """edges (type, from_id, to_id, properties), nodes (stable_id, source, labels): all
    edges are written, or none."""
    spark = edges.sparkSession
    ship_package(spark)
    spark.dataSource.register(GuardedEdges)
    begin = nodes.select(F.col("stable_id").alias("from_id"), F.col("source").alias("from_source"))
    end = nodes.select(F.col("stable_id").alias("to_id"), F.coalesce("labels", F.array().cast("array<string>")).alias("to_labels"))
    seen = edges.join(begin, "from_id", "left").join(end, "to_id", "left").select(*[c.split()[0] for c in SEEN.split(", ")])
    text = json.dumps({f: getattr(rules, f) for f in Rules.__dataclass_fields__})
    seen.write.format("guarded_edges").option("path", path).option("draft", uuid.uuid4().hex).option("rules", text).mode("append").save()


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """The edges of all commits."""
    commits = spark.read.schema("files array<string>, edges long").json(f"{path}/commits")
    files = [f"{path}/edges/{r['file']}" for r in commits.select(F.explode("files").alias("file")).collect()]
    return spark.read.schema(EDGE).parquet(*files) if files else spark.createDataFrame([], EDGE)
