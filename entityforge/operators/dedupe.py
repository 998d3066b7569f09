"""Entity resolution: greedy leaders in ingest order, and the merge of what they absorb.

A row joins an earlier leader of its type with the same canonical name, or else with the same
domain; otherwise it becomes a leader. Only leaders' keys count, so this is no transitive closure:
the leaders are the first maximal independent set, in order, of the graph of shared keys. Rounds
find it in parallel: a row that comes first under all its keys, among undecided rows, leads, and all
that share a key with a leader are decided.

A few such rounds decide nearly everything; what they leave hangs together in chains, in which each row waits
for the one before. Later rounds follow chains at once: where only one earlier row stands in a row's way, the
row leads if and only if that one does not, so it is that row, an odd number of steps away. Pointers along
such steps are doubled, and a chain of any length takes as many tables as its length has binary digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityforge.functions.names import canonical_name
from entityforge.functions.text import strip
from entityforge.functions.urls import canonical_domain
from entityforge.session import cut_lineage


def resolution_keys(entities: DataFrame, use_domain: bool = True, exempt: tuple[str, ...] = ()) -> DataFrame:
    """(pos, name_key, domain_key). No domain gives no domain key; an empty name is a key like any other.

    `use_domain=False` and `exempt` hosts, whose pages have different subjects, depart from the default on request.
    """
    kind = F.lower(strip(F.coalesce("entity_type", F.lit(""))))
    domain = canonical_domain(F.col("url"))
    usable = (domain != "") & ~domain.isin(*exempt) if exempt else domain != ""
    key = F.when(usable, F.concat_ws("|", kind, domain)) if use_domain else F.lit(None).cast("string")
    return entities.select("pos", F.concat_ws("|", kind, canonical_name(F.col("name"))).alias("name_key"), key.alias("domain_key"))


#: Rounds that look at first rows alone, before chains are followed.
PLAIN_ROUNDS = 3
KEYS = ("name_key", "domain_key")
#: Stands for no row.
NONE = -(1 << 63)


def _with_first(undecided: DataFrame) -> DataFrame:
    """Each row with the first row under its name (_n) and under its domain (_d)."""
    by_name = undecided.groupBy("name_key").agg(F.min("pos").alias("_n"))
    by_domain = undecided.filter("domain_key is not null").groupBy("domain_key").agg(F.min("pos").alias("_d"))
    return undecided.join(by_name, "name_key").join(by_domain, "domain_key", "left")


def _first_rows(undecided: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that come first under all their keys; and all rows."""
    ranked = _with_first(undecided)
    return ranked.filter((F.col("pos") == F.col("_n")) & (F.col("pos") == F.coalesce("_d", "pos"))).select("pos", *KEYS), undecided


def _along_chains(undecided: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that lead by following chains; and the rows without those whose key another one takes for sure.

    `to` is the only earlier row in a row's way, or none, or unknown where there are more. Under a key whose second
    row waits for its first row alone, one of the two leads, so that no later row does.
    """
    ranked = cut_lineage(_with_first(undecided))
    for key, first, second in (("name_key", "_n", "_n2"), ("domain_key", "_d", "_d2")):
        later = ranked.filter(F.col("pos") > F.col(first)).groupBy(key).agg(F.min("pos").alias(second))
        ranked = ranked.join(later, key, "left")
    own = F.lit(NONE)
    waits = lambda first, second: F.when(F.col("pos") == F.coalesce(first, "pos"), own).when(F.col("pos") == F.col(second), F.col(first))
    ranked = ranked.withColumn("_p", waits("_n", "_n2")).withColumn("_q", waits("_d", "_d2"))
    only = F.when(F.col("_p") == own, F.col("_q")).when((F.col("_q") == own) | (F.col("_q") == F.col("_p")), F.col("_p"))
    steps = cut_lineage(ranked.select("pos", *KEYS, "_n", "_d", "_n2", "_d2", only.alias("to")))

    # pointers along single steps: `odd` says whether the row at `to` leads or this one does
    chain = steps.filter(F.col("to") != own).select("pos", "to", F.lit(True).alias("odd"))
    ends = steps.select(F.col("pos").alias("to"), F.coalesce(F.col("to") == own, F.lit(False)).alias("leads"), (F.coalesce("to", own) != own).alias("goes_on"))
    chain = cut_lineage(chain.join(ends, "to"))
    while chain.filter("goes_on").limit(1).count():
        on = chain.select(F.col("pos").alias("to"), F.col("to").alias("_to"), F.col("odd").alias("_odd"), F.col("leads").alias("_leads"), F.col("goes_on").alias("_goes_on"))
        far = chain.filter("goes_on").join(on, "to").select("pos", F.col("_to").alias("to"), (F.col("odd") != F.col("_odd")).alias("odd"), F.col("_leads").alias("leads"), F.col("_goes_on").alias("goes_on"))
        chain = cut_lineage(chain.filter("not goes_on").unionByName(far))
    lead = steps.filter(F.col("to") == own).select("pos", *KEYS)
    lead = lead.unionByName(steps.join(chain.filter("leads and not odd").select("pos"), "pos", "left_semi").select("pos", *KEYS))

    rest = undecided
    for key, first, second in (("name_key", "_n", "_n2"), ("domain_key", "_d", "_d2")):
        sure = steps.filter((F.col("pos") == F.col(second)) & (F.col("to") == F.col(first))).select(F.col(key).alias("_key"), F.col("pos").alias("_second"))
        rest = rest.join(sure, (F.col(key) == F.col("_key")) & (F.col("pos") > F.col("_second")), "left_anti")
    return lead, rest


def leaders_of(keys: DataFrame) -> DataFrame:
    """The leaders among `keys` (pos unique)."""
    undecided, found, rounds = cut_lineage(keys), None, 0
    while undecided.limit(1).count():
        new, rest = (_first_rows if rounds < PLAIN_ROUNDS else _along_chains)(undecided)
        new = cut_lineage(new)
        rest = rest.join(new.select("name_key"), "name_key", "left_anti")
        rest = rest.join(new.select("domain_key").filter("domain_key is not null"), "domain_key", "left_anti")
        undecided = cut_lineage(rest.select("pos", *KEYS))
        found = new if found is None else found.unionByName(new)
        rounds += 1
    return keys.limit(0) if found is None else found


def assign_leaders(keys: DataFrame) -> DataFrame:
    """(pos, leader): of an absorbed row, the leader of its name if that came earlier, else that of its domain."""
    lead = leaders_of(keys)
    names = lead.select("name_key", F.col("pos").alias("_n"))
    domains = lead.filter("domain_key is not null").select("domain_key", F.col("pos").alias("_d"))
    met = keys.join(names, "name_key", "left").join(domains, "domain_key", "left")
    return met.select("pos", F.when(F.col("_n") <= F.col("pos"), F.col("_n")).otherwise(F.col("_d")).alias("leader"))


def longest_first(text: str, pos: str) -> Column:
    """Aggregate: the longest text, the earliest of equals."""
    return F.max_by(F.coalesce(text, F.lit("")), F.struct(F.length(F.coalesce(text, F.lit(""))), -F.col(pos)))


def merge(entities: DataFrame, assigned: DataFrame) -> DataFrame:
    """Leaders with what they absorbed: the longest description (earliest of equals), the sorted union
    of categories, and all metadata, later rows winning key by key, null values included. Leaders that
    absorbed nothing stay as they are."""
    rows = entities.join(assigned, "pos")
    sizes = rows.groupBy("leader").agg(F.count("*").alias("_n"), longest_first("description", "pos").alias("_description"))
    shared = sizes.filter("_n > 1")
    inside = rows.join(shared.select("leader"), "leader", "left_semi")
    labels = inside.select("leader", F.explode_outer("categories").alias("c")).groupBy("leader").agg(F.array_sort(F.collect_set("c")).alias("_categories"))
    facts = inside.select("leader", "pos", F.explode("metadata")).groupBy("leader", "key").agg(F.max_by("value", "pos").alias("value"))
    facts = facts.groupBy("leader").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("_metadata"))
    extra = shared.join(labels, "leader", "left").join(facts, "leader", "left").withColumnRenamed("leader", "_leader")
    kept = rows.filter("pos = leader").join(extra, F.col("leader") == F.col("_leader"), "left")
    merged = {"description": "_description", "categories": "_categories", "metadata": "_metadata"}
    return kept.select(*[F.coalesce(merged[c], c).alias(c) if c in merged else F.col(c) for c in entities.columns])


def dedupe(entities: DataFrame, use_domain: bool = True, exempt: tuple[str, ...] = ()) -> DataFrame:
    """One row per resolved entity."""
    return merge(entities, assign_leaders(resolution_keys(entities, use_domain, exempt)))
