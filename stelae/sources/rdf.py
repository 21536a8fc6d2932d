"""RDF/XML as statements, and the classes, properties and option sets that they declare."""

from __future__ import annotations

from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stelae.runtime import ship_package, stored

# The vocabularies' namespaces.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
SKOS = "http://www.w3.org/2004/02/skos/core#"
XML = "{http://www.w3.org/XML/1998/namespace}"
#: What makes a node a class, a property, an option set or one of its values.
ROLES = {
    "class": (f"{RDFS}Class", f"{OWL}Class"),
    "property": (f"{RDF}Property", f"{OWL}ObjectProperty", f"{OWL}DatatypeProperty"),
    "optionSet": (f"{SKOS}ConceptScheme",),
    "optionValue": (f"{SKOS}Concept",),
}
STATEMENT = "path string, subject string, predicate string, object string, kind string, lang string, datatype string, place int"


def file_statements(path: str, text: bytes) -> Iterator[tuple]:
    """Statements of one file, in the order of the text. kind: iri, blank or literal; place:
    of a member of a collection. Nodes without a name are ``_:`` and a number, with the
    file's path."""
    root = ElementTree.fromstring(text)
    blanks = 0
    rdf = f"{{{RDF}}}"

    def name(tag: str) -> str:
        return tag[1:].replace("}", "", 1)

    def node(x, base: str, lang: str | None) -> Iterator[tuple]:
        """Statements of a node element; its name comes first."""
        nonlocal blanks
        base, lang = x.get(f"{XML}base", base), x.get(f"{XML}lang", lang)
        if x.get(f"{rdf}about") is not None:
            subject = _absolute(base, x.get(f"{rdf}about"))
        elif x.get(f"{rdf}ID") is not None:
            subject = f"{base.partition('#')[0]}#{x.get(f'{rdf}ID')}"
        elif x.get(f"{rdf}nodeID") is not None:
            subject = f"_:{path}#{x.get(f'{rdf}nodeID')}"
        else:
            blanks += 1
            subject = f"_:{path}#{blanks}"
        yield subject
        if x.tag != f"{rdf}Description":
            yield path, subject, f"{RDF}type", name(x.tag), "iri", None, None, None
        for attribute, value in x.attrib.items():
            if attribute == f"{rdf}type":
                yield path, subject, f"{RDF}type", _absolute(base, value), "iri", None, None, None
            elif not attribute.startswith((rdf, XML)) and attribute.startswith("{"):
                yield path, subject, name(attribute), value, "literal", lang, None, None
        for p in x:
            inner_base, inner_lang = p.get(f"{XML}base", base), p.get(f"{XML}lang", lang)
            said, way = name(p.tag), p.get(f"{rdf}parseType")
            if p.get(f"{rdf}resource") is not None:
                yield path, subject, said, _absolute(inner_base, p.get(f"{rdf}resource")), "iri", None, None, None
            elif p.get(f"{rdf}nodeID") is not None:
                yield path, subject, said, f"_:{path}#{p.get(f'{rdf}nodeID')}", "blank", None, None, None
            elif way == "Literal":
                whole = (p.text or "") + "".join(ElementTree.tostring(c, encoding="unicode") for c in p)
                yield path, subject, said, whole, "literal", None, f"{RDF}XMLLiteral", None
            elif len(p):
                for place, child in enumerate(p):
                    rows = node(child, inner_base, inner_lang)
                    target = next(rows)
                    kind = "blank" if target.startswith("_:") else "iri"
                    yield path, subject, said, target, kind, None, None, place if way == "Collection" else None
                    yield from rows
            else:
                datatype = p.get(f"{rdf}datatype")
                yield path, subject, said, p.text or "", "literal", None if datatype else inner_lang, datatype, None

    base, lang = root.get(f"{XML}base", ""), root.get(f"{XML}lang")
    for x in root if root.tag == f"{rdf}RDF" else [root]:
        rows = node(x, base, lang)
        next(rows)
        yield from rows


def _absolute(base: str, written: str) -> str:
    """What a reference means: one without a scheme belongs to the base."""
    from urllib.parse import urljoin

    return urljoin(base, written) if base and ":" not in written.partition("/")[0] else written


def statements(files: DataFrame) -> DataFrame:
    """files (path, text) -> the statements of all of them; stored."""
    ship_package(files.sparkSession)
    names = [c.split()[0] for c in STATEMENT.split(", ")]

    def run(frames):
        from stelae.sources import rdf

        for frame in frames:
            for path, text in zip(frame["path"], frame["text"], strict=True):
                raw = bytes(text) if isinstance(text, (bytes, bytearray)) else text.encode()
                rows = pd.DataFrame(list(rdf.file_statements(path, raw)), columns=names)
                yield rows.astype({"place": "Int32"})

    return stored(files.select("path", "text").mapInPandas(run, STATEMENT), "statements")


def ontology(said: DataFrame, lang: str = "en") -> tuple[DataFrame, DataFrame]:
    """-> nodes (id, role, label), edges (type, from_id, to_id). A node that is declared in
    several ways takes the first role of class, property, option set, option value; its
    label is that of the language, else one without a language, else the least. Edges:
    SUBCLASS_OF, HAS_PROPERTY (from a property's domain), RANGE, HAS_VALUE (from the
    scheme of a concept)."""
    order, role = F.lit(len(ROLES)), F.lit(None).cast("string")
    for i, (name, kinds) in reversed(list(enumerate(ROLES.items()))):
        order = F.when(F.col("object").isin(*kinds), i).otherwise(order)
        role = F.when(F.col("object").isin(*kinds), name).otherwise(role)
    kinds = said.where(F.col("predicate") == f"{RDF}type").select(F.col("subject").alias("id"), F.struct(order.alias("i"), role.alias("role")).alias("r"))
    kinds = kinds.where("r.role is not null").groupBy("id").agg(F.min("r")["role"].alias("role"))
    rank = F.when(F.col("lang") == lang, 0).when(F.col("lang").isNull(), 1).otherwise(2)
    named = said.where(F.col("predicate").isin(f"{RDFS}label", f"{SKOS}prefLabel") & (F.col("kind") == "literal"))
    named = named.groupBy(F.col("subject").alias("id")).agg(F.min(F.struct(rank, "object"))["object"].alias("label"))
    nodes = kinds.join(named, "id", "left")

    def edge(kind: str, predicate: str, turned: bool = False) -> DataFrame:
        a, b = ("object", "subject") if turned else ("subject", "object")
        rows = said.where((F.col("predicate") == predicate) & (F.col("kind") != "literal"))
        return rows.select(F.lit(kind).alias("type"), F.col(a).alias("from_id"), F.col(b).alias("to_id"))

    edges = edge("SUBCLASS_OF", f"{RDFS}subClassOf").unionByName(edge("HAS_PROPERTY", f"{RDFS}domain", True))
    edges = edges.unionByName(edge("RANGE", f"{RDFS}range")).unionByName(edge("HAS_VALUE", f"{SKOS}inScheme", True))
    return nodes, edges.distinct()
