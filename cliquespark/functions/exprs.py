"""Column functions of the normalization engine. JVM expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the namespace of set identifiers.
SET_NAMESPACE = "14ef168c-14cb-4979-8442-da6aaca55572"


def text(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def curie_key(curie) -> Column:
    """The lookup key: the whole identifier in upper case."""
    return F.upper(text(curie))


def prefix_of(curie) -> Column:
    """What stands before the first colon, case kept; without a colon the whole string."""
    return F.split(text(curie), ":")[0]


def upper_prefix(curie) -> Column:
    """The prefix in upper case, or null without a colon."""
    c = text(curie)
    return F.when(c.contains(":"), F.split(F.upper(c), ":")[0])


def local_part(curie) -> Column:
    """What stands after the first colon; without a colon the whole string."""
    c = text(curie)
    return F.when(c.contains(":"), F.substring(c, F.instr(c, ":") + 1, F.length(c))).otherwise(c)


def shorten(value, limit: int = 80) -> Column:
    """At most ``limit`` characters, with dots where some were cut; null for empty."""
    v = text(value)
    return F.when(F.length(v) > limit, F.concat(F.substring(v, 1, limit), F.lit("..."))).when(F.length(v) > 0, v)


def path_last(value) -> Column:
    return F.substring_index(text(value), "/", -1)


def obo_to_curie(value) -> Column:
    return F.replace(path_last(value), F.lit("_"), F.lit(":"))


def url_to_curie(value) -> Column:
    """Identifiers in the URLs of four public services as prefix and local part; others unchanged."""
    v = text(value)
    parts = F.split(v, "/")
    return (
        F.when(v.startswith("http://purl.obolibrary.org") | v.startswith("http://www.orpha.net"), obo_to_curie(v))
        .when(v.startswith("http://linkedlifedata.com/resource/umls"), F.concat(F.lit("UMLS:"), path_last(v)))
        .when(v.startswith("http://identifiers.org/"), F.concat(F.upper(F.element_at(parts, -2)), F.lit(":"), F.element_at(parts, -1)))
        .otherwise(v)
    )


def curie_to_obo(curie) -> Column:
    parts = F.split(text(curie), ":")
    return F.concat(F.lit("<http://purl.obolibrary.org/obo/"), parts[0], F.lit("_"), parts[1], F.lit(">"))


def snakify(value) -> Column:
    """Commas, dashes and runs of white space as underscores; white space at the ends goes."""
    return F.regexp_replace(F.trim(F.regexp_replace(F.translate(text(value), ",-", "__"), r"\s+", " ")), " ", "_")


def upper_curie(curie) -> Column:
    c = text(curie)
    return F.when(c.contains(":"), F.concat(F.upper(F.split(c, ":")[0]), F.lit(":"), local_part(c))).otherwise(c)


def gene_local(gene) -> Column:
    g = text(gene)
    return F.when(g.startswith("http://"), path_last(g)).otherwise(g)


def edge_md5(subject, object_, file) -> Column:
    return F.md5(F.concat(text(subject), text(object_), text(file)).cast("binary"))


def uuid5(name, namespace: str = SET_NAMESPACE) -> Column:
    """The name-based UUID (version 5): SHA-1 of namespace and name with version and variant bits set."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(text(name), "UTF-8")))
    variant = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(F.lower(F.hex(variant.cast("long"))), F.substring(digest, 18, 3)), F.substring(digest, 21, 12))


def boosted(identifiers: Column, prefixes: Column) -> Column:
    """Identifiers by the rank of their prefix, those with other prefixes last, otherwise in their order."""

    def keyed(x: Column, at: Column) -> Column:
        place = F.array_position(prefixes, prefix_of(x["i"]))
        rank = F.when(place == 0, F.size(prefixes).cast("long") + 1).otherwise(place)
        return F.struct(rank.alias("rank"), at.alias("at"), x.alias("x"))

    # rank and place differ between any two, so that the identifiers themselves are never compared
    by = lambda a, b: F.when((a["rank"] < b["rank"]) | ((a["rank"] == b["rank"]) & (a["at"] < b["at"])), -1).otherwise(1)
    return F.transform(F.array_sort(F.transform(identifiers, keyed), by), lambda k: k["x"])


def preferred_label(identifiers: Column, types: Column, boost_prefixes: dict[str, tuple[str, ...]], longest: int) -> Column:
    """The first label in order of preference: boosted prefixes, no empty or placeholder labels, short ones before long."""
    order = identifiers
    if boost_prefixes:
        # the least specific configured type decides
        hit = F.get(F.filter(F.reverse(types), lambda t: t.isin(list(boost_prefixes))), F.lit(0))
        order = identifiers
        for name, prefixes in boost_prefixes.items():
            order = F.when(hit == name, boosted(identifiers, F.array(*map(F.lit, prefixes)))).otherwise(order)
    labels = F.transform(order, lambda x: F.coalesce(x["l"], F.lit("")))
    usable = F.filter(labels, lambda x: (x != "") & ~x.startswith("CHEMBL"))
    short = F.filter(usable, lambda x: F.length(x) <= longest)
    return F.coalesce(F.get(short, F.lit(0)), F.get(usable, F.lit(0)))


def union_sorted(a, b) -> Column:
    """Distinct values of both lists in code point order."""
    return F.sort_array(F.array_union(text(a), text(b)))


def append_missing(a, b, key: str = "identifier") -> Column:
    """List ``a`` and then the items of ``b`` whose key ``a`` lacks; repeats inside ``b`` stay."""
    have = F.transform(text(a), lambda x: x[key])
    return F.concat(text(a), F.filter(text(b), lambda x: ~F.array_contains(have, x[key])))


def confidence(n_equivalents, n_types, weight: float, bonus: float) -> Column:
    """Weight plus bounded bonuses for equivalents and types and one for the source, at most 1."""
    d = lambda x: F.lit(float(x))
    equivalents = F.least(d(0.2), text(n_equivalents).cast("double") * d(0.05))
    types = F.least(d(0.1), text(n_types).cast("double") * d(0.01))
    return F.least(d(1.0), d(weight) + equivalents + types + d(bonus))


# The rank of each type for the merge by type.
TYPE_PRIORITY = {"biolink:Gene": 10, "biolink:Protein": 9, "biolink:ChemicalEntity": 8, "biolink:AnatomicalEntity": 7, "biolink:Disease": 6, "biolink:OrganismTaxon": 5, "biolink:NamedThing": 1}


def type_priority(types, ranks: dict[str, int] | None = None) -> Column:
    """The highest rank of a type that one of the list starts with, 0 for none."""
    best = F.lit(0)
    for name, rank in sorted((ranks or TYPE_PRIORITY).items(), key=lambda x: x[1]):
        starts = F.transform(text(types), lambda t: t.startswith(F.lit(name)))  # noqa: B023
        best = F.when(F.array_contains(starts, True), F.lit(rank)).otherwise(best)
    return best


def canonical_json(value) -> Column:
    """JSON text in one spelling: keys in order, no blanks, plain numbers. Text that is no JSON, or repeats a key, stays as it is."""
    return F.coalesce(F.to_json(F.try_parse_json(text(value))), text(value))


def canonical_map(value: Column) -> Column:
    """A map of JSON texts with its keys in order and every value in one spelling."""
    entries = F.transform(F.map_entries(value), lambda e: F.struct(e["key"].alias("key"), canonical_json(e["value"]).alias("value")))
    return F.map_from_entries(F.array_sort(entries))
