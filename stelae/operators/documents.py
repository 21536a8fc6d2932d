"""Nested JSON documents as statements, and back; equal subtrees by their digests.

``unnest`` takes documents apart level by level: each round explodes the containers of one
level, so a document of any depth takes as many narrow passes as it is deep, and a document
with very many values is spread as soon as it is cut. Bottom up, ``fold_up`` gives each
container a value made of its children's: the text of the container, which builds the
document again, or a digest, by which equal subtrees are found without comparing them
(a Merkle tree). References are found top down, without cutting documents whole: what equals
a component is not taken apart any further.

Numbers are those of Spark's variants, so 1.0 and 1 are one value; members of objects are
in the order of their names. A document that is no JSON fails the job.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stelae.runtime import new_shared_path, stored

STEP = "struct<key:string,place:int>"


class Tree:
    """nodes (doc, level, steps, kind: object, array or leaf, value: JSON of a leaf), stored
    by level; a node's steps lead to it from the document's root. roots: the documents as
    variants (doc, v); they are taken apart when nodes or depth are first asked for."""

    def __init__(self, nodes: DataFrame | None = None, depth: int = 0, roots: DataFrame | None = None):
        self._held, self._roots = (nodes, depth), roots

    @cached_property
    def _taken(self) -> tuple[DataFrame, int]:
        return _levels(self._roots) if self._held[0] is None else self._held

    @property
    def nodes(self) -> DataFrame:
        return self._taken[0]

    @property
    def depth(self) -> int:
        return self._taken[1]

    @cached_property
    def roots(self) -> DataFrame:
        if self._roots is not None:
            return self._roots
        return rebuilt(self).select("doc", F.parse_json("text").alias("v"))


def unnest(docs: DataFrame, variant: Column | None = None) -> Tree:
    """docs (doc, text), or any with ``doc`` and a variant. Null texts have no nodes; empty
    objects and arrays are leaves."""
    if variant is None:
        roots = docs.where("text is not null").select("doc", F.parse_json("text").alias("v"))
    else:
        roots = docs.select("doc", variant.alias("v")).where("v is not null")
    return Tree(roots=stored(roots, "roots"))


def _kind(text: Column) -> Column:
    """Of a value in Spark's JSON."""
    return F.when(text.isin("{}", "[]"), "leaf").when(text.startswith("{"), "object").when(text.startswith("["), "array").otherwise("leaf")


def _parts(inner: DataFrame, *kept: str) -> DataFrame:
    """inner (kept, steps, kind, v), objects and arrays -> kept, steps, v of their members."""
    parts = inner.lateralJoin(inner.sparkSession.tvf.variant_explode(F.col("v").outer()))
    step = F.struct("key", F.when(F.col("kind") == "array", F.col("pos")).alias("place"))
    return parts.select(*kept, F.concat("steps", F.array(step)).alias("steps"), F.col("value").alias("v"))


def _levels(roots: DataFrame) -> tuple[DataFrame, int]:
    spark, text = roots.sparkSession, F.to_json("v")
    path, level = new_shared_path(spark, "nodes"), 0
    now = roots.select("doc", F.array().cast(f"array<{STEP}>").alias("steps"), "v")
    while True:
        now = now.withColumn("kind", _kind(text))
        now = stored(now, "level") if level else now
        now.select("doc", "steps", "kind", F.when(F.col("kind") == "leaf", text).alias("value")).write.parquet(f"{path}/level={level}")
        inner = now.where("kind <> 'leaf'")
        if not inner.limit(1).count():
            break
        now = _parts(inner, "doc")
        level += 1
    kind = roots.schema["doc"].dataType.simpleString()
    return spark.read.schema(f"doc {kind}, steps array<{STEP}>, kind string, value string, level int").parquet(path), level


def pointer(steps: Column, set_valued: tuple[str, ...] = ()) -> Column:
    """The JSON pointer of steps; members of the named arrays, whose order means nothing,
    all stand at ``-``."""
    names = F.array(*[F.lit(s) for s in set_valued]) if set_valued else F.array().cast("array<string>")

    def part(step: Column, i: Column) -> Column:
        owner = F.get(steps, i - 1)["key"]
        free = step["key"].isNull() & F.coalesce(F.array_contains(names, owner), F.lit(False))
        key = F.replace(F.replace(step["key"], F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
        return F.concat(F.lit("/"), F.when(free, F.lit("-")).otherwise(F.coalesce(key, step["place"].cast("string"))))

    return F.array_join(F.transform(steps, part), "")


def statements(tree: Tree, set_valued: tuple[str, ...] = ()) -> DataFrame:
    """-> doc, pointer, value: one row for each leaf."""
    return tree.nodes.where("kind = 'leaf'").select("doc", pointer(F.col("steps"), set_valued).alias("pointer"), "value")


def _quoted(text: Column) -> Column:
    whole = F.to_json(F.array(text))
    return F.substr(whole, F.lit(2), F.length(whole) - 2)


def _whole(members: Column, kind: Column) -> Column:
    """The text of a container from its sorted members (key, place, value)."""
    pairs = F.transform(members, lambda m: F.concat(_quoted(m["key"]), F.lit(":"), m["value"]))
    values = F.transform(members, lambda m: m["value"])
    made = F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
    return F.when(kind == "object", made).otherwise(F.concat(F.lit("["), F.array_join(values, ","), F.lit("]")))


def fold_up(tree: Tree, digest: bool = False, bare_of: str | None = None) -> DataFrame:
    """-> doc, level, steps, kind, value of every node: its canonical JSON, or with
    ``digest`` the SHA-256 of what that would be, made of the digests of its children. bare:
    for objects, the value without their own member ``bare_of``. All members of one
    container meet in one task, as they do in the document."""
    spark = tree.nodes.sparkSession
    seal = (lambda c: F.sha2(c, 256)) if digest else (lambda c: c)
    path, below = new_shared_path(spark, "folded"), None
    for level in range(tree.depth, -1, -1):
        here = tree.nodes.where(F.col("level") == level)
        leaves = here.where("kind = 'leaf'").select("doc", "steps", "kind", seal(F.col("value")).alias("value"))
        leaves = leaves.withColumn("bare", F.col("value"))
        made = leaves
        if below is not None:
            last = F.element_at("steps", -1)
            children = below.select("doc", F.slice("steps", 1, F.size("steps") - 1).alias("steps"), F.struct(last["key"].alias("key"), last["place"].alias("place"), "value").alias("m"))
            groups = children.groupBy("doc", "steps").agg(F.array_sort(F.collect_list("m")).alias("members"))
            first = F.get("members", 0)["key"]
            groups = groups.withColumn("kind", F.when(first.isNull(), "array").otherwise("object"))
            bare = F.filter("members", lambda m: ~m["key"].eqNullSafe(F.lit(bare_of))) if bare_of else F.col("members")
            made = leaves.unionByName(groups.select("doc", "steps", "kind", seal(_whole(F.col("members"), F.col("kind"))).alias("value"), seal(_whole(bare, F.col("kind"))).alias("bare")))
        made.write.parquet(f"{path}/level={level}")
        kind = tree.nodes.schema["doc"].dataType.simpleString()
        schema = f"doc {kind}, steps array<{STEP}>, kind string, value string, bare string, level int"
        below = spark.read.schema(schema).parquet(path).where(F.col("level") == level)
    return spark.read.schema(schema).parquet(path)


def without(tree: Tree, names: tuple[str, ...]) -> Tree:
    """The tree without the members of these names, at any depth; a container that they were
    all of is empty then."""
    left = tree.nodes.where(~F.exists("steps", lambda s: F.coalesce(s["key"].isin(*names), F.lit(False))))
    left = stored(left, "kept")
    parents = left.where("level > 0").select("doc", F.slice("steps", 1, F.size("steps") - 1).alias("steps")).distinct().withColumn("held", F.lit(True))
    nodes = left.join(parents, ["doc", "steps"], "left")
    bare = (F.col("kind") != "leaf") & F.col("held").isNull()
    value = F.when(bare, F.when(F.col("kind") == "object", "{}").otherwise("[]")).otherwise(F.col("value"))
    nodes = nodes.withColumns({"value": value, "kind": F.when(bare, "leaf").otherwise(F.col("kind"))})
    return Tree(stored(nodes.select("doc", "steps", "kind", "value", "level"), "kept"), tree.depth)


def frozen_text(docs: DataFrame) -> DataFrame:
    """docs (doc, text) -> doc, text in canonical JSON, digest (its SHA-256): one text for
    documents that differ in order and spacing alone. What JSON can't say (NaN, infinities)
    fails the job."""
    return rebuilt(unnest(docs)).withColumn("digest", F.sha2("text", 256))


def definition_digests(docs: DataFrame, omitted: tuple[str, ...] = ("position", "comments")) -> DataFrame:
    """docs (doc, text) -> doc, digest of the canonical JSON without the members that say
    where a definition stands, not what it is."""
    return rebuilt(without(unnest(docs), omitted)).select("doc", F.sha2("text", 256).alias("digest"))


def rebuilt(tree: Tree) -> DataFrame:
    """-> doc, text: the documents in canonical JSON."""
    return fold_up(tree).where("level = 0").select("doc", F.col("value").alias("text"))


def graph_statements(nodes: DataFrame) -> DataFrame:
    """nodes (doc, properties: map of lists) -> doc, pointer, value, as a document
    ``{name: [values]}`` of the node would state them."""
    listed = nodes.select("doc", F.explode("properties").alias("key", "values"))
    root = F.struct(F.col("key"), F.lit(None).cast("int").alias("place"))
    empty = listed.where("size(values) = 0").select("doc", pointer(F.array(root)).alias("pointer"), F.lit("[]").alias("value"))
    each = listed.select("doc", "key", F.posexplode("values").alias("place", "value"))
    inner = F.array(root, F.struct(F.lit(None).cast("string").alias("key"), F.col("place")))
    text = F.when(F.col("value").isNull(), F.lit("null")).otherwise(_quoted(F.col("value")))
    return each.select("doc", pointer(inner).alias("pointer"), text.alias("value")).unionByName(empty)


# --- references by content


def _at(v: Column, *keys: str, kind: str = "variant") -> Column:
    """What stands at these keys; null where nothing does, or nothing of the kind."""
    quotes = [next((q for q in "'\"" if q not in key), None) for key in keys]
    if None in quotes:
        raise ValueError(f"a name with both quotes: {keys}")
    return F.try_variant_get(v, "$" + "".join(f"[{q}{key}{q}]" for q, key in zip(quotes, keys, strict=True)), kind)


def components(tree: Tree, at: tuple[str, ...] = ("components", "schemas")) -> DataFrame:
    """The named components: name, text, and the least doc that holds it. Those that are no
    objects or empty are none."""
    rows = tree.roots.select("doc", F.explode(_at(F.col("v"), *at, kind="map<string,variant>")).alias("name", "v"))
    rows = rows.select("doc", "name", F.to_json("v").alias("text")).groupBy("name", "text").agg(F.min("doc").alias("doc"))
    return stored(rows, "components").where(_kind(F.col("text")) == "object")


def _bare(v: Column, bare_of: str) -> Column:
    """A digest of an object without its own member ``bare_of``."""
    members = F.map_filter(_at(v, kind="map<string,variant>"), lambda key, _: key != bare_of)
    return F.unhex(F.sha2(F.to_json(members), 256))


def recover_references(tree: Tree, at: tuple[str, ...] = ("components", "schemas"), bare_of: str = "description", title: str = "title") -> tuple[DataFrame, DataFrame]:
    """Documents whose references were replaced by copies -> (references, refused).

    Components are united over the documents by name. A copy is an object inside a
    component that equals a component but for its own description; of copies in copies the
    outermost counts. References: component, pointer (within it), target, by_title. Where
    several components are equal, the one that the copy's title names is meant. Refused:
    reason, name, pointer: a name that stands for different components, a copy whose title
    names none of several, or more than one. Nothing is guessed."""
    v = F.col("v")
    held = components(tree, at).withColumn("v", F.parse_json("text"))
    held = stored(held.select("name", "doc", "v", _bare(v, bare_of).alias("bare")), "distinct")
    union = held.groupBy("name").agg(F.count(F.lit(1)).alias("shapes"), F.min("bare").alias("bare"), F.min("doc").alias("doc"))
    union = stored(union, "named")
    unequal = union.where("shapes > 1").select(F.lit("different components of one name").alias("reason"), "name", F.lit("").alias("pointer"))
    index = union.groupBy("bare").agg(F.count(F.lit(1)).alias("alike"), F.min("name").alias("only"))
    index = stored(index, "index")
    # Each component is walked once, in the least document that holds it, a level at a time.
    # What is a copy is not walked: copies in it are part of it.
    roots = held.join(union.select("name", "doc"), ["name", "doc"], "left_semi")
    inner = roots.select("name", F.array().cast(f"array<{STEP}>").alias("steps"), F.lit("object").alias("kind"), "v")
    sites = None
    while True:
        parts = stored(_parts(inner, "name").withColumn("kind", _kind(F.to_json("v"))).where("kind <> 'leaf'"), "parts")
        named = F.to_json(_at(v, title))
        named = F.when(_kind(named) == "leaf", F.get(F.from_json(F.concat(F.lit("["), named, F.lit("]")), "array<string>"), 0))
        objects = parts.where("kind = 'object'").select("*", _bare(v, bare_of).alias("bare")).join(index, "bare", "left")
        objects = stored(objects.select("name", "steps", "kind", "bare", F.when(F.col("alike").isNull(), v).alias("v"), "alike", "only", F.when(F.col("alike") > 1, named).alias("title")), "objects")
        hits = objects.where("alike is not null").drop("v", "kind")
        sites = hits if sites is None else sites.unionByName(hits)
        inner = objects.where("alike is null").select("name", "steps", "kind", "v").unionByName(parts.where("kind = 'array'"))
        if not inner.limit(1).count():
            break
    # A title can only mean a component that equals others.
    several = union.join(index.where("alike > 1"), "bare", "left_semi").select(F.col("name").alias("title"), F.col("bare").alias("meant"))
    tied = sites.where("alike > 1").join(several, "title", "left")
    where = pointer(F.col("steps")).alias("pointer")
    ok = F.col("meant").eqNullSafe(F.col("bare"))
    found = sites.where("alike = 1").select(F.col("name").alias("component"), where, F.col("only").alias("target"), F.lit(False).alias("by_title"))
    found = found.unionByName(tied.where(ok).select(F.col("name").alias("component"), where, F.col("title").alias("target"), F.lit(True).alias("by_title")))
    refused = unequal.unionByName(tied.where(~ok).select(F.lit("title names none of several equal components").alias("reason"), "name", where))
    return found, refused
