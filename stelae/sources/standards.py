"""Published standards as nodes and edges: OpenAPI, XSD, RDF/XML, XLSX."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stelae.operators.compare import record_hash


def openapi_graph(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """documents (name, json) -> nodes (id, role), edges (type, from_id, to_id). Schemas
    are classes, their members properties, an enum an option set of values; a ``$ref``,
    direct or of a list's items, references the class that it names."""
    schemas = documents.select(
        "name", F.explode(F.from_json(F.get_json_object("json", "$.components.schemas"), "map<string,string>")).alias("schema", "body")
    )
    schemas = schemas.withColumn("id", F.concat_ws(":", "name", "schema"))
    members = schemas.select("name", F.col("id").alias("owner"), F.explode(F.from_json(F.get_json_object("body", "$.properties"), "map<string,string>")).alias("member", "body"))
    members = members.withColumn("id", F.concat_ws(".", "owner", "member"))
    values = members.select("id", F.explode(F.from_json(F.get_json_object("body", "$.enum"), "array<string>")).alias("value"))
    values = values.select(F.col("id").alias("owner"), F.concat_ws("=", "id", "value").alias("id"))
    target = F.coalesce(F.get_json_object("body", "$['$ref']"), F.get_json_object("body", "$.items['$ref']"))
    refs = members.select("id", "name", target.alias("ref")).where("ref is not null")
    refs = refs.select("id", F.concat_ws(":", "name", F.element_at(F.split("ref", "/"), -1)).alias("target"))
    node = lambda rows, role: rows.select("id", F.lit(role).alias("role"))
    edge = lambda rows, kind, a, b: rows.select(F.lit(kind).alias("type"), F.col(a).alias("from_id"), F.col(b).alias("to_id"))
    nodes = node(schemas, "class").unionByName(node(members, "property")).unionByName(node(values, "optionValue"))
    edges = edge(members, "HAS_PROPERTY", "owner", "id").unionByName(edge(values, "HAS_VALUE", "owner", "id"))
    return nodes, edges.unionByName(edge(refs, "REFERENCES", "id", "target"))


XSD_TYPE = "_name string, `xs:sequence` struct<`xs:element`:array<struct<_name:string,_type:string,_minOccurs:string,_maxOccurs:string>>>"


def xsd_elements(spark: SparkSession, path: str) -> DataFrame:
    """type, element, element_type, ordinal, optional of named complex types."""
    types = spark.read.format("xml").option("rowTag", "xs:complexType").schema(XSD_TYPE).load(path)
    rows = types.select(F.col("_name").alias("type"), F.posexplode("`xs:sequence`.`xs:element`").alias("ordinal", "e"))
    optional = F.coalesce(F.col("e._minOccurs") == "0", F.lit(False)).alias("optional")
    return rows.select("type", F.col("e._name").alias("element"), F.col("e._type").alias("element_type"), "ordinal", optional)


def rdf_classes(spark: SparkSession, path: str) -> DataFrame:
    """iri, label, parent of RDF/XML classes."""
    schema = "`_rdf:about` string, `rdfs:label` string, `rdfs:subClassOf` struct<`_rdf:resource`:string>"
    rows = spark.read.format("xml").option("rowTag", "rdfs:Class").schema(schema).load(path)
    return rows.select(F.col("`_rdf:about`").alias("iri"), F.col("`rdfs:label`").alias("label"), F.col("`rdfs:subClassOf`.`_rdf:resource`").alias("parent"))


_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _cells(raw: bytes) -> list[tuple[str, str, str]]:
    """(sheet, cell, text) of a workbook; numbers stay as they are written."""
    with zipfile.ZipFile(io.BytesIO(raw)) as book:
        names = set(book.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")):
                shared.append("".join(t.text or "" for t in item.iter(f"{_SHEET}t")))
        out = []
        for part in sorted(n for n in names if re.fullmatch(r"xl/worksheets/[^/]+\.xml", n)):
            for cell in ElementTree.fromstring(book.read(part)).iter(f"{_SHEET}c"):
                value = cell.find(f"{_SHEET}v")
                if cell.get("t") == "inlineStr":
                    text = "".join(t.text or "" for t in cell.iter(f"{_SHEET}t"))
                elif value is None:
                    continue
                else:
                    text = shared[int(value.text)] if cell.get("t") == "s" else value.text
                out.append((part.rpartition("/")[2].removesuffix(".xml"), cell.get("r"), text))
        return out


def xlsx_cells(spark: SparkSession, path: str) -> DataFrame:
    """file, sheet, cell, text of the workbooks of a folder, one task a workbook."""

    def run(frames):
        for frame in frames:
            rows = [(p, *c) for p, raw in zip(frame["path"], frame["content"], strict=True) for c in _cells(bytes(raw))]
            yield pd.DataFrame(rows, columns=["file", "sheet", "cell", "text"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("path", "content")
    return files.mapInPandas(run, "file string, sheet string, cell string, text string")


def digest_references(shapes: DataFrame, components: DataFrame, parts: list[str]) -> DataFrame:
    """shapes (id, parts), components (name, parts): a shape references the component
    with its digest; several with one digest refer only by an equal title, else it is
    refused (name null)."""
    digest = record_hash([F.col(p) for p in parts]).alias("digest")
    named = components.select("name", digest).distinct()
    held = named.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("only"))
    titled = named.select("digest", F.col("name").alias("title"), F.lit(True).alias("named"))
    found = shapes.select("id", "title", digest).join(held, "digest", "left").join(titled, ["digest", "title"], "left")
    return found.select("id", F.when(F.col("n") == 1, F.col("only")).when(F.col("named"), F.col("title")).alias("name"))
