"""Schema sets, cycles, guarded writes, log blocks and URI routes."""

import json
import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stelae.operators import cycles, routes
from stelae.runtime import new_shared_path
from stelae.sources import edge_writer, log_blocks, schema_sets

# --- schema sets

XS = 'xmlns:xs="http://www.w3.org/2001/XMLSchema"'
FILES = {
    "d/a.xsd": f'<xs:schema {XS} targetNamespace="urn:a" xmlns="urn:a" xmlns:q="urn:b"><xs:include schemaLocation="../c/cham.xsd"/><xs:import namespace="urn:b" schemaLocation="b.xsd"/>'
    '<xs:element name="e" type="q:T"/><xs:element name="f" type="Cham"/><xs:element name="g" type="xs:string"/><xs:element name="h" type="Missing"/></xs:schema>',
    "d/b.xsd": f'<xs:schema {XS} targetNamespace="urn:b"><xs:import namespace="urn:a" schemaLocation="./a.xsd"/><xs:include schemaLocation="../c/cham.xsd"/><xs:include schemaLocation="gone.xsd"/>'
    '<xs:complexType name="T"><xs:sequence><xs:element ref="z:e" xmlns:z="urn:a"/><xs:element name="in" type="xs:int"/></xs:sequence></xs:complexType></xs:schema>',
    "c/cham.xsd": f'<s:schema xmlns:s="http://www.w3.org/2001/XMLSchema"><s:include schemaLocation="deep/../more.xsd"/><s:complexType name="Cham"><s:attribute name="x" type="Own"/></s:complexType></s:schema>',
    "c/more.xsd": f'<xs:schema {XS}><xs:simpleType name="Own"><xs:union memberTypes="Own xs:int"/></xs:simpleType></xs:schema>',
    "d/stray.xsd": f'<xs:schema {XS} targetNamespace="urn:z"/>',
}


def _rows(spark, files=FILES):
    return schema_sets.read_schemas(spark.createDataFrame(list(files.items()), "path string, text string"))


def test_closure_with_a_cycle_and_a_chameleon(spark):
    rows = _rows(spark)
    members, faults = schema_sets.closure(rows, spark.createDataFrame([("d/a.xsd",)], "path string"))
    assert {(r.path, r.namespace) for r in members.collect()} == {
        ("d/a.xsd", "urn:a"), ("d/b.xsd", "urn:b"), ("c/cham.xsd", "urn:a"), ("c/cham.xsd", "urn:b"), ("c/more.xsd", "urn:a"), ("c/more.xsd", "urn:b"),
    }
    assert [(r.path, r.reason) for r in faults.collect()] == [("d/gone.xsd", "not there")]
    assert [r.path for r in schema_sets.unaccounted(rows, members).collect()] == ["d/stray.xsd"]
    names = {(r.path, r.namespace, r.written): (r.target, r.found) for r in schema_sets.resolve_names(rows, members).collect()}
    assert names == {
        ("d/a.xsd", "urn:a", "q:T"): ("d/b.xsd", 1), ("d/a.xsd", "urn:a", "Cham"): ("c/cham.xsd", 1), ("d/a.xsd", "urn:a", "Missing"): (None, 0),
        ("d/b.xsd", "urn:b", "z:e"): ("d/a.xsd", 1), ("c/cham.xsd", "urn:a", "Own"): ("c/more.xsd", 1), ("c/cham.xsd", "urn:b", "Own"): ("c/more.xsd", 1),
        ("c/more.xsd", "urn:a", "Own"): ("c/more.xsd", 1), ("c/more.xsd", "urn:b", "Own"): ("c/more.xsd", 1),
    }


def test_links_to_other_namespaces_are_faults(spark):
    files = {
        "a": f'<xs:schema {XS} targetNamespace="urn:a"><xs:include schemaLocation="b"/><xs:import namespace="urn:x" schemaLocation="b"/></xs:schema>',
        "b": f'<xs:schema {XS} targetNamespace="urn:b"/>',
    }
    faults = schema_sets.closure(_rows(spark, files), spark.createDataFrame([("a",)], "path string"))[1]
    assert {r.reason for r in faults.collect()} == {"included from another namespace", "imported under another namespace"}


def test_an_undeclared_prefix_fails(spark):
    with pytest.raises(Exception, match="no namespace for p:T"):
        _rows(spark, {"a": f'<xs:schema {XS}><xs:element name="e" type="p:T"/></xs:schema>'}).count()


def test_paths_are_worked_off(spark):
    cases = [("a/b/c.xsd", "../d.xsd", "a/d.xsd"), ("c.xsd", "./x/./y.xsd", "x/y.xsd"), ("a/c.xsd", "http://h/x.xsd", "http://h/x.xsd"), ("a/c.xsd", "/r/x.xsd", "/r/x.xsd")]
    rows = spark.createDataFrame(cases, "base string, location string, want string")
    assert all(r.got == r.want for r in rows.withColumn("got", schema_sets.joined_path(F.col("base"), F.col("location"))).collect())


# --- cycles


def _reach(edges):
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)
    nodes = {x for e in edges for x in e}
    found = {}
    for n in nodes:
        seen, todo = set(), list(out.get(n, ()))
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += out.get(x, ())
        found[n] = seen
    return nodes, found


@pytest.mark.parametrize("seed,nodes,edges", [(1, 30, 40), (2, 25, 22)])
def test_components_and_layers_against_reach(spark, seed, nodes, edges):
    draw = random.Random(seed)
    held = [(draw.randrange(nodes), draw.randrange(nodes)) for _ in range(edges)] + [(100, 101), (101, 102), (102, 103), (103, 101), (103, 103), (104, 104)]
    every, reach = _reach(held)
    want = {n: min(m for m in every if m in reach[n] and n in reach[m]) for n in every if n in reach[n]}
    df = spark.createDataFrame(held + [(None, 1)], "a long, b long")
    found = cycles.components(df)
    assert {r.node: r.component for r in found.collect()} == want
    on = {(r.a, r.b) for r in cycles.cycle_edges(df, found).collect()}
    assert on == {(a, b) for a, b in held if a in want and b in want and want[a] == want[b]}
    name = {n: want.get(n, n) for n in every}
    layer = dict.fromkeys(set(name.values()), 0)
    for _ in every:
        for a, b in held:
            if name[a] != name[b]:
                layer[name[b]] = max(layer[name[b]], layer[name[a]] + 1)
    assert {r.node: (r.component, r.layer) for r in cycles.layers(df, found).collect()} == {n: (name[n], layer[name[n]]) for n in every}


def test_no_edges_no_cycles(spark):
    none = spark.createDataFrame([], "a long, b long")
    assert cycles.components(none).count() == 0 and cycles.layers(none).count() == 0


# --- the guarded writer

RULES = edge_writer.Rules(("T",), ("p", "q"), ("p",), "src", "Target")
NODES = [("a", "src", ["x"]), ("b", "hub", ["Target"]), ("c", "other", ["Target"]), ("d", "hub", None)]
GOOD = [("T", "a", "b", {"p": ["1"]}), ("T", "a", "c", {"p": ["1"], "q": ["2", "3"]})]


def _files(path):
    return sorted(f for _, _, names in os.walk(path.removeprefix("file://")) for f in names if not f.endswith(".crc"))


@pytest.mark.parametrize("bad,why", [
    (("U", "a", "b", {"p": ["1"]}), "a type that isn't declared"), (("T", "none", "b", {"p": ["1"]}), "no node where it begins"),
    (("T", "a", "none", {"p": ["1"]}), "no node where it ends"), (("T", "c", "b", {"p": ["1"]}), "another source"),
    (("T", "a", "d", {"p": ["1"]}), "labelled as a target"), (("T", "a", "b", {"q": ["1"]}), "no p"),
    (("T", "a", "b", {"p": ["1"], "z": ["1"]}), "z isn't declared"), (("T", "a", "b", {"p": [None]}), "a null in p"),
])
def test_a_violation_leaves_nothing_behind(spark, bad, why):
    path = new_shared_path(spark, "edges")
    nodes = spark.createDataFrame(NODES, "stable_id string, source string, labels array<string>")
    edge_writer.write_edges(spark.createDataFrame(GOOD, edge_writer.EDGE), nodes, path, RULES)
    before = _files(path)
    with pytest.raises(Exception, match=re.escape(why)):
        edge_writer.write_edges(spark.createDataFrame([*GOOD * 40, bad], edge_writer.EDGE).repartition(3), nodes, path, RULES)
    assert _files(path) == before
    assert sorted((r.from_id, r.to_id) for r in edge_writer.read_edges(spark, path).collect()) == [("a", "b"), ("a", "c")]


def test_tasks_that_run_on_leave_nothing_behind(tmp_path):
    import pyarrow as pa

    options = {"path": f"file://{tmp_path}/edges", "draft": "d", "rules": json.dumps({"types": ["T"], "allowed": []})}
    writer = edge_writer.GuardedEdgeWriter(options)
    kinds = pa.schema([(c, pa.string()) for c in ("type", "from_id", "to_id")] + [("properties", pa.map_(pa.string(), pa.list_(pa.string()))), ("from_source", pa.string()), ("to_labels", pa.list_(pa.string()))])
    good, bad = (pa.RecordBatch.from_pylist([{"type": t, "from_id": "a", "to_id": "b", "properties": [], "from_source": "s", "to_labels": []}], kinds) for t in "TU")
    # The task with the forbidden edge ends before the other one begins; only then may the write end.
    given = iter([good, bad, good])
    messages = [writer.write(given), writer.write(iter([good]))]
    assert next(given, None) is None and [m.edges for m in messages] == [1, 0]
    with pytest.raises(ValueError, match="edge U a -> b: a type that isn't declared"):
        writer.commit(messages[::-1])
    # A refusing attempt that was lost, and tried again, is still not a commit.
    with pytest.raises(ValueError, match="refused"):
        writer.commit(messages[1:])
    writer.abort(messages)
    assert _files(str(tmp_path)) == []


def test_commits_add_up(spark):
    path = new_shared_path(spark, "edges")
    nodes = spark.createDataFrame(NODES, "stable_id string, source string, labels array<string>")
    for _ in range(2):
        edge_writer.write_edges(spark.createDataFrame(GOOD, edge_writer.EDGE), nodes, path, RULES)
    edge_writer.write_edges(spark.createDataFrame([], edge_writer.EDGE), nodes, path, RULES)
    rows = edge_writer.read_edges(spark, path)
    assert rows.count() == 4 and rows.where(F.size(F.col("properties")["q"]) == 2).count() == 2


# --- log blocks


def _plain(text):
    out, now = [], None
    for line in text.split("\n"):
        head = re.match(r"^(\d+)\)[ \t]+(.*?)[ \t]+—[ \t]+retrieval cosine[ \t]+(\S+)[ \t]*$", line)
        if head:
            now = [int(head[1]), head[2], float(head[3]), None, None, []]
            out.append(now)
        elif now:
            said = now[3] is None and re.match(log_blocks.NOMINATION, line)
            if said:
                now[3], now[4] = said[1].strip(), said[2].strip()
            else:
                now[5] += [k for k, p in log_blocks.MARKERS.items() if re.match(p, line) and k not in now[5]]
    return [(*x[:5], sorted(x[5])) for x in out]


def test_blocks_in_splits_of_1_kb_equal_one_task(spark):
    draw, path, want = random.Random(3), new_shared_path(spark, "log"), {}
    os.makedirs(path.removeprefix("file://"))
    for f in range(3):
        lines = ["preamble", "   Range: not in a block"]
        for i in range(60):
            lines.append(f"{i}) card {draw.randrange(9)} — retrieval cosine {draw.random():.6f}")
            for _ in range(draw.choice([0, 1, 5, 60])):
                lines.append(draw.choice(["   Nominated by x: why it é", "\tNominated by y:", "   Range: r", "  Notes: n", "x" * draw.randrange(90), "", "   Domain(s): d", "  CEDS Value Reference: q", "3) no header — cosine 1"]))
        text = "\n".join(lines)
        want[f"{f}.log"] = _plain(text)
        with open(f"{path.removeprefix('file://')}/{f}.log", "w") as out:
            out.write(text)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        lines = log_blocks.read_lines(spark, path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert lines.select("file", "split").distinct().count() > 60
    rows = log_blocks.candidate_blocks(lines).orderBy("file", "split", "number").collect()
    got = {}
    for r in rows:
        got.setdefault(r.file.rsplit("/", 1)[1], []).append((r.position, r.name, r.cosine, r.nominated_by, r.rationale, sorted(r.markers)))
    assert got == want
    top = log_blocks.ranked(log_blocks.candidate_blocks(lines)).where("rank = 1").collect()
    assert {r.file.rsplit("/", 1)[1]: r.cosine for r in top} == {f: max(x[2] for x in w) for f, w in want.items()}


def test_a_cosine_that_is_no_number_fails(spark):
    lines = spark.createDataFrame([("f", 0, 0, "1) a — retrieval cosine 0.5abc")], "file string, split long, number long, line string")
    with pytest.raises(Exception, match="a cosine that is no number"):
        log_blocks.candidate_blocks(lines).collect()


# --- routes


def test_routes_against_patterns(spark):
    templates = {"layer": "layer/{layer}", "version": "layer/{layer}/version/{tag}", "meaning": "hub/{hub}/{release}/q/{key...}", "hub": "hub/{hub}", "element": "{standard}/{version}/{element...}", "root": "root"}
    draw = random.Random(2)
    words = ["layer", "hub", "q", "version", "a%20b", "c+d", "x", "root", "%2F"]
    uris = {"edc:" + "/".join(draw.choice(words) for _ in range(draw.randint(1, 6))) for _ in range(400)} | {"edc:layer/x?page=1", "http://layer/x", "edc:", "edc:layer//version/x", "edc:/layer/x/"}
    rank = sorted(templates.items(), key=lambda x: (-sum(not p.startswith("{") for p in x[1].split("/")), "..." in x[1], -len(x[1].split("/"))))

    def plain(uri):
        from urllib.parse import unquote

        if not uri.startswith("edc:"):
            return None
        parts = uri[4:].split("?")[0].strip("/").split("/")
        for kind, template in rank:
            names = template.split("/")
            rest = names[-1].endswith("...}")
            if len(parts) < len(names) or (len(parts) > len(names) and not rest):
                continue
            if any(not n.startswith("{") and n != p for n, p in zip(names, parts, strict=False)):
                continue
            found = {}
            for i, n in enumerate(names):
                if n.startswith("{"):
                    found[n.strip("{}.")] = unquote("/".join(parts[i:]) if n.endswith("...}") else parts[i])
            return None if "" in found.values() else (kind, found)
        return None

    table = routes.route_table(spark, templates)
    got = {r.uri: (r.kind, r.parts) if r.kind else None for r in routes.matched(spark.createDataFrame([(u,) for u in uris], "uri string"), table).collect()}
    assert got == {u: plain(u) for u in uris}


def test_routes_of_rows_that_come_in_another_order_each_time(spark):
    """As what a shuffle or a spill gives may: no row gets another row's route."""

    def turned(batches):
        for frame in batches:
            yield frame.sample(frac=1)

    uris = [f"edc:{kind}/{i}" for i in range(2000) for kind in "abz"] + ["edc:a/1", None, None]
    rows = spark.createDataFrame([(u,) for u in uris], "uri string").coalesce(1).mapInPandas(turned, "uri string")
    found = routes.matched(rows, routes.route_table(spark, {"a": "a/{x}", "b": "b/{x}"})).collect()
    want = Counter((u, u[4], u[6:]) if u and u[4] in "ab" else (u, None, None) for u in uris)
    assert Counter((r.uri, r.kind, r.parts and r.parts["x"]) for r in found) == want


def test_answers_by_status(spark):
    table = routes.route_table(spark, {"a": "a/{x}", "b": "b/{x}", "c": "c/{x}"})
    found = routes.matched(spark.createDataFrame([(u,) for u in ("edc:a/1", "edc:a/2", "edc:b/1", "edc:z", "edc:a/1?page=1", "edc:c/1?page=1", None)], "uri string"), table)
    known = spark.createDataFrame([("a", "1", "one"), ("b", "1", "one"), ("c", "1", "c-one")], "kind string, key string, answer string")
    got = {r.uri: (r.status, r.answer) for r in routes.resolved(found, known, ["a", "c"], ["c"]).collect()}
    assert got == {"edc:a/1": (200, "one"), "edc:a/2": (404, None), "edc:b/1": (501, None), "edc:z": (400, None), "edc:a/1?page=1": (400, None), "edc:c/1?page=1": (200, "c-one"), None: (400, None)}


# --- RDF/XML


def test_statements_of_a_file(spark):
    from stelae.sources import rdf

    text = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#" xmlns:owl="http://www.w3.org/2002/07/owl#" xmlns:e="urn:e#" xml:base="http://b/x" xml:lang="en">
    <owl:Class rdf:ID="A" e:note="n"><rdfs:label>Ä</rdfs:label><rdfs:label xml:lang="fr">à</rdfs:label><rdfs:subClassOf><rdfs:Class rdf:about="B"/></rdfs:subClassOf></owl:Class>
    <rdf:Description rdf:about="#A"><e:n rdf:datatype="urn:int">5</e:n><e:list rdf:parseType="Collection"><rdf:Description rdf:about="urn:1"/><e:T/></e:list><e:x rdf:parseType="Literal">a<b>c</b></e:x></rdf:Description>
    <owl:ObjectProperty rdf:about="urn:p"><rdf:type rdf:resource="http://www.w3.org/2000/01/rdf-schema#Class"/><rdfs:domain rdf:resource="#A"/><rdfs:label/></owl:ObjectProperty></rdf:RDF>"""
    said = rdf.statements(spark.createDataFrame([("f", text)], "path string, text string"))
    short = lambda x: x.rsplit("#", 1)[-1] if x.startswith("http://www.w3") or x.startswith("urn:e#") else x
    got = {(r.subject, short(r.predicate), short(r.object), r.kind, r.lang, r.datatype and short(r.datatype), r.place) for r in said.collect()}
    a = "http://b/x#A"
    assert got == {
        (a, "type", "Class", "iri", None, None, None), (a, "note", "n", "literal", "en", None, None), (a, "label", "Ä", "literal", "en", None, None), (a, "label", "à", "literal", "fr", None, None),
        (a, "subClassOf", "http://b/B", "iri", None, None, None), ("http://b/B", "type", "Class", "iri", None, None, None), (a, "n", "5", "literal", None, "urn:int", None),
        (a, "list", "urn:1", "iri", None, None, 0), (a, "list", "_:f#1", "blank", None, None, 1), ("_:f#1", "type", "T", "iri", None, None, None), (a, "x", "a<b>c</b>", "literal", None, "XMLLiteral", None),
        ("urn:p", "type", "ObjectProperty", "iri", None, None, None), ("urn:p", "type", "Class", "iri", None, None, None), ("urn:p", "domain", a, "iri", None, None, None), ("urn:p", "label", "", "literal", "en", None, None),
    }
    nodes, edges = rdf.ontology(said)
    assert {(r.id, r.role, r.label) for r in nodes.collect()} == {(a, "class", "Ä"), ("http://b/B", "class", None), ("urn:p", "class", "")}
    assert {(r.type, r.from_id, r.to_id) for r in edges.collect()} == {("SUBCLASS_OF", a, "http://b/B"), ("HAS_PROPERTY", a, "urn:p")}
