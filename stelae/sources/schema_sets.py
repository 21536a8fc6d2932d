"""Sets of XML schema files: what belongs to a set, and what its written names mean.

Each file is read once, in a task, into rows: its own namespace, the files that it
includes or imports, its definitions, and every written qualified name with the namespace
that its prefix has at that place. The set of a root file is a closure over these rows,
round by round until nothing is new, so cycles of imports end it like anything else. A file
without a namespace that is included takes the namespace of the file that includes it, and
so may stand in a set under several.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stelae.runtime import ship_package, stored

XSD = "http://www.w3.org/2001/XMLSchema"
#: Attributes that hold qualified names, with the symbol space they name, and the
#: elements that define a name, by that space.
USES = {"type": "type", "base": "type", "itemType": "type", "memberTypes": "type", "substitutionGroup": "element"}
SPACES = {"complexType": "type", "simpleType": "type", "element": "element", "attribute": "attribute", "group": "group", "attributeGroup": "attributeGroup"}
LINKS = ("include", "import", "redefine")
ROW = "path string, what string, site string, name string, space string, namespace string, location string"


def file_rows(path: str, text: bytes) -> Iterator[tuple]:
    """Rows of one file. what: schema (namespace), link (name: the kind; namespace, location),
    definition (space, name), use (site, name as written, space, namespace of its prefix;
    null without one)."""
    scopes: list[dict[str, str]] = [{}]
    opened: list[tuple[str, dict[str, int]]] = []
    pending: dict[str, str] = {}
    top = f"{{{XSD}}}schema"
    for event, x in ElementTree.iterparse(io.BytesIO(text), events=("start-ns", "start", "end")):
        if event == "start-ns":
            pending[x[0]] = x[1]
        elif event == "end":
            opened.pop()
            scopes.pop()
            x.clear()
        else:
            scope = {**scopes[-1], **pending}
            pending = {}
            scopes.append(scope)
            tag = x.tag.removeprefix(f"{{{XSD}}}")
            counts = opened[-1][1] if opened else {}
            counts[tag] = counts.get(tag, 0) + 1
            site = f"{opened[-1][0]}/{tag}[{counts[tag]}]" if opened else f"/{tag}"
            opened.append((site, {}))
            if len(opened) == 1:
                if x.tag != top:
                    raise ValueError(f"{path} is no schema")
                yield path, "schema", site, None, None, x.get("targetNamespace"), None
            elif len(opened) == 2 and tag in LINKS:
                yield path, "link", site, tag, None, x.get("namespace"), x.get("schemaLocation")
            elif len(opened) == 2 and tag in SPACES and x.get("name"):
                yield path, "definition", site, x.get("name"), SPACES[tag], None, None
            uses = [(x.get(a), s) for a, s in USES.items() if x.get(a)]
            if x.get("ref") and tag in SPACES:
                uses.append((x.get("ref"), SPACES[tag]))
            for written, space in uses:
                for one in written.split():
                    prefix = one.partition(":")[0] if ":" in one else ""
                    if prefix and prefix not in scope:
                        raise ValueError(f"{path}{site}: no namespace for {one}")
                    yield path, "use", site, one, space, scope.get(prefix) or None, None


def read_schemas(files: DataFrame) -> DataFrame:
    """files (path, text) -> the rows of all files; stored."""
    ship_package(files.sparkSession)
    names = [c.split()[0] for c in ROW.split(", ")]

    def run(frames):
        from stelae.sources import schema_sets

        for frame in frames:
            for path, text in zip(frame["path"], frame["text"], strict=True):
                raw = text if isinstance(text, bytes) else text.encode()
                yield pd.DataFrame(list(schema_sets.file_rows(path, raw)), columns=names)

    return stored(files.select("path", "text").mapInPandas(run, ROW), "schema_rows")


def joined_path(base: Column, location: Column) -> Column:
    """A location as seen from a file: its folder's steps and the location's, ``.`` and
    ``..`` worked off. Absolute locations and those with a scheme stand for themselves."""
    steps = F.split(F.concat(F.regexp_replace(base, "[^/]*$", ""), location), "/")
    empty = F.array().cast("array<string>")
    back = lambda held, s: F.when((s == "..") & (F.size(held) > 0), F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(0))))
    done = F.aggregate(steps, empty, lambda held, s: back(held, s).when((s == ".") | (s == ""), held).otherwise(F.concat(held, F.array(s))))
    return F.when(location.rlike("^([A-Za-z][A-Za-z0-9+.-]*:|/)"), location).otherwise(F.array_join(done, "/"))


def closure(rows: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """roots (path) -> (members: root, path, namespace that the file stands for; faults: root,
    path, reason). Faults: a link to a file that isn't there, an include of another
    namespace, an import of a file that has another namespace than it says."""
    own = rows.where("what = 'schema'").select("path", F.col("namespace").alias("own"))
    links = rows.where("what = 'link' and location is not null").select(
        "path", F.col("name").alias("kind"), F.col("namespace").alias("says"), joined_path(F.col("path"), F.col("location")).alias("to")
    )
    targets = own.withColumnRenamed("path", "to").withColumnRenamed("own", "theirs").withColumn("there", F.lit(True))
    links = stored(links.join(targets, "to", "left"), "links")
    now = roots.select(F.col("path").alias("root"), "path").join(own, "path").select("root", "path", F.col("own").alias("namespace"))
    now = members = stored(now, "members")
    faults = None
    while now.limit(1).count():
        met = now.join(links, "path")
        imported = F.col("kind") == "import"
        reason = F.when(F.col("there").isNull(), "not there")
        reason = reason.when(imported & ~F.col("theirs").eqNullSafe(F.col("says")), "imported under another namespace")
        reason = reason.when(~imported & F.col("theirs").isNotNull() & ~F.col("theirs").eqNullSafe(F.col("namespace")), "included from another namespace")
        met = stored(met.select("root", F.col("to").alias("path"), F.when(imported, F.col("theirs")).otherwise(F.coalesce("theirs", "namespace")).alias("namespace"), reason.alias("reason")), "met")
        wrong = met.where("reason is not null").select("root", "path", "reason").distinct()
        faults = wrong if faults is None else faults.unionByName(wrong)
        new = met.where("reason is null").select("root", "path", "namespace").distinct()
        same = (new["root"] == members["root"]) & (new["path"] == members["path"]) & new["namespace"].eqNullSafe(members["namespace"])
        now = stored(new.join(members, same, "left_anti"), "members")
        members = stored(members.unionByName(now), "members")
    return members, (faults if faults is not None else members.select("root", "path", F.lit("").alias("reason")).where("false")).distinct()


def unaccounted(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Files that belong to no set."""
    return rows.where("what = 'schema'").select("path").join(members.select("path"), "path", "left_anti")


def resolve_names(rows: DataFrame, members: DataFrame, foreign: tuple[str, ...] = (XSD,)) -> DataFrame:
    """-> root, path, namespace (of the file in the set), site, written, space, target (file
    of the definition), found (how many definitions it has; 1 is right). Names of foreign
    namespaces are left out. A name without a namespace, in a file that took over another's,
    means that one."""
    chameleon = rows.where("what = 'schema'").select("path", F.col("namespace").isNull().alias("took"))
    held = members.join(chameleon, "path")
    uses = rows.where("what = 'use'").select("path", "site", F.col("name").alias("written"), "space", F.col("namespace").alias("meant"))
    uses = uses.join(held, "path").withColumn("uri", F.coalesce("meant", F.when(F.col("took"), F.col("namespace"))))
    uses = uses.where(~F.coalesce(F.col("uri").isin(*foreign), F.lit(False))).withColumn("local", F.substring_index("written", ":", -1))
    known = rows.where("what = 'definition'").select("path", "space", F.col("name").alias("local")).join(members, "path")
    # One file under one namespace is one definition, by however many ways it was reached.
    known = known.select("root", "space", "local", F.coalesce("namespace", F.lit("")).alias("uri"), F.col("path").alias("target")).distinct()
    counted = known.groupBy("root", "space", "local", "uri").agg(F.min("target").alias("target"), F.count(F.lit(1)).alias("found"))
    found = uses.withColumn("uri", F.coalesce("uri", F.lit(""))).join(counted, ["root", "space", "local", "uri"], "left")
    return found.select("root", "path", "namespace", "site", "written", "space", "target", F.coalesce("found", F.lit(0)).alias("found"))
