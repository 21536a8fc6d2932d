"""Scalar functions of the engine, as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUL = "\u0000"


def sha256_hex(text: Column) -> Column:
    """Hex SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(text, 256)


def vector_id(model: Column, dims: Column, text: Column) -> Column:
    """Content address of an embedding: model, width and text, joined by NUL; null
    where a part holds NUL itself."""
    whole = F.concat(model, F.lit(NUL), dims.cast("string"), F.lit(NUL), text)
    return F.when(~(F.contains(model, F.lit(NUL)) | F.contains(text, F.lit(NUL))), F.sha2(whole, 256))


def address_signature(*slots: Column) -> Column:
    """Slots in a fixed order joined by ``|``; an absent slot is empty."""
    return F.concat_ws("|", *[F.coalesce(s.cast("string"), F.lit("")) for s in slots])


def assertion_id(subject: Column, predicate: Column, target: Column, author: Column | None = None) -> Column:
    lines = [subject, predicate, target]
    text = F.concat_ws("\n", *[F.coalesce(x.cast("string"), F.lit("")) for x in lines])
    if author is not None:
        text = F.when(author.isNull(), text).otherwise(F.concat(text, F.lit("\n"), author))
    return F.sha2(text, 256)


def match_id(block: Column, subject: Column, predicate: Column, target: Column, instance: Column | None = None) -> Column:
    """SHA-256 of four lines, of five where a mapping is written to an instance."""
    lines = F.concat_ws("\n", block, subject, predicate, target)
    return F.sha2(lines if instance is None else F.when(instance.isNull(), lines).otherwise(F.concat(lines, F.lit("\n"), instance)), 256)


def mapping_sameness_id(subjects: Column, predicate: Column, objects: Column, negative: Column) -> Column:
    """One id for a mapping however its member lists are ordered."""
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), " ")
    text = F.concat_ws("\n", listed(subjects), predicate, listed(objects))
    return F.concat(F.lit("mapping:"), F.when(negative, F.lit("~")).otherwise(F.lit("")), F.sha2(text, 256))


def edge_identity(kind: Column, source: Column, target: Column, props: Column) -> Column:
    """Type, ends and sorted properties of an edge; props is a map of strings."""
    pairs = F.array_sort(F.transform(F.map_entries(props), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return F.concat_ws("␟", kind, source, target, F.array_join(pairs, "␟"))


def collapse_whitespace(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, r"[ \t\n\r\f\x0b]+", " "))


def slugify(text: Column) -> Column:
    """Runs of anything but ASCII letters and digits become ``_``, none at the ends."""
    return F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9]+", "_"), "^_|_$", "")


def search_text(*parts: Column) -> Column:
    """Trimmed parts that aren't empty, joined by `` | ``."""
    return F.concat_ws(" | ", *[F.nullif(F.btrim(p), F.lit("")) for p in parts])


def ratio_of(part: Column, whole: Column) -> Column:
    """Four decimals; null where the whole is nothing."""
    return F.when(whole != 0, F.round(part / whole, 4))


def percent_of(part: Column, whole: Column) -> Column:
    """One decimal; null where the whole is nothing."""
    return F.when(whole != 0, F.round(100 * part / whole, 1))


def rank_bucket(rank: Column) -> Column:
    return (
        F.when(rank == 1, "1").when(rank <= 3, "2-3").when(rank <= 10, "4-10").when(rank <= 15, "11-15").otherwise("16+")
    )


def day_of(stamp: Column) -> Column:
    return F.substring(stamp, 1, 10)


def usd_for(tokens_in: Column, tokens_out: Column, rate_in: Column, rate_out: Column) -> Column:
    return tokens_in / 1e6 * rate_in + tokens_out / 1e6 * rate_out


def encode_segment(text: Column) -> Column:
    """Percent-encoding of a path segment (a space is %20)."""
    return F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))


def compose_subject(hub, hub_version, source, source_version, suffix, mark=None) -> Column:
    text = F.concat(hub, F.lit("@"), hub_version, F.lit("_rel_"), source, F.lit("@"), source_version, F.lit("_"), suffix)
    return text if mark is None else F.when(mark.isNull(), text).otherwise(F.concat(text, F.lit("~"), mark))


SUBJECT = r"^([^@]+)@([^_]+)_rel_([^@]+)@([^_]+)_([^~]+)(?:~(.+))?$"


def parse_subject(text: Column) -> Column:
    names = ("hub", "hub_version", "source", "source_version", "suffix", "mark")
    return F.struct(*[F.nullif(F.regexp_extract(text, SUBJECT, i + 1), F.lit("")).alias(n) for i, n in enumerate(names)])


def split_compound(text: Column) -> Column:
    """Words of a compound name: cut at marks and between a small and a large letter."""
    cut = F.regexp_replace(text, "([a-z0-9])([A-Z])", "$1 $2")
    return F.filter(F.split(F.regexp_replace(cut, "[^A-Za-z0-9]+", " "), " "), lambda w: w != "")


def first_of_list(values: Column) -> Column:
    return F.get(values, 0)


def unwrap(values: Column) -> Column:
    """A list of one is its member; others are joined, for reading only."""
    return F.when(F.size(values) == 1, values[0]).otherwise(F.array_join(values, ","))


def confidence_band(category: Column) -> Column:
    bands = {"exact": 0.95, "close": 0.8, "broad": 0.6, "related": 0.4}  # fixed values
    out = F.lit(None).cast("double")
    for name, value in bands.items():
        out = F.when(category == name, F.lit(value)).otherwise(out)
    return out


def version_key(text: Column) -> Column:
    """major.minor.patch as numbers, which compare member by member."""
    return F.transform(F.split(text, r"\."), lambda p: p.cast("int"))


def wrap(value: Column) -> Column:
    """A value as a list of one."""
    return F.array(value)


def id_prefix(stable_id: Column) -> Column:
    """What stands before the first colon of a stable id."""
    return F.split_part(stable_id, F.lit(":"), F.lit(1))


def compose_text(*slots: Column) -> Column:
    """Slots joined by a middle dot (empty and null ones left out), white space collapsed."""
    held = F.filter(F.array(*slots), lambda s: s.isNotNull() & (F.trim(s) != ""))
    return F.trim(F.regexp_replace(F.array_join(held, " · "), r"\s+", " "))
