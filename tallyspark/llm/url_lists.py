"""URL filters by dated lists.

Dated entries (add, remove) of a list become validity intervals, and every capture is evaluated as of its fetch time
against the entries then active for its host or one of the domains above it.

Hosts are matched to entries once each, not once per capture; captures then meet their host's intervals in an equi-join
on the host with the time as a further condition, which adaptive execution can split at a hot host.

Defined results: an entry is active from its time on, until the next entry of the same list and pattern; of entries at one
time a removal wins. Captures with a null time or an unparsable url match nothing. Repeated captures give a row each.
Empty lists block nothing. Null patterns, times and actions are ignored. Entries may be of any number of labels, but for a
last label alone, which blocks only a host of that name. Columns named like the results are replaced, all others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import hidden


def host_of(url: Column) -> Column:
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_to) of entries (list, pattern, at, action); valid_to is null while still active."""
    clean = entries.filter("pattern is not null and at is not null and action in ('add', 'remove')").withColumn("pattern", F.lower("pattern"))
    once = clean.groupBy("list", "pattern", "at").agg(F.max(F.col("action") == "remove").alias("removed"))
    after = F.lead("at").over(Window.partitionBy("list", "pattern").orderBy("at"))
    return once.withColumn("valid_to", after).filter("not removed").select("list", "pattern", F.col("at").alias("valid_from"), "valid_to")


def domains(host: Column) -> Column:
    """The host and all domains above it, the last label alone left out."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    upper = F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), n)), lambda k: F.array_join(F.slice(labels, -k, k), "."))
    return F.array_distinct(F.when(n >= 2, F.concat(upper, F.array(host))).otherwise(F.array(host)))


def evaluate(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched") -> DataFrame:
    """captures with host, lists (names of the lists that block it, sorted) and blocked."""
    kept = [c for c in captures.columns if c.lower() not in ("host", "lists", "blocked")]
    base = captures.select(*[captures[c] for c in kept], host_of(captures[url]).alias("host"))
    spans = validity_intervals(entries)
    hosts = base.select("host").filter("host is not null").distinct().select("host", F.explode(domains(F.col("host"))).alias("pattern"))
    active = hosts.join(spans, "pattern").select(F.col("host").alias("_host"), "list", "valid_from", "valid_to")
    keys = base.select("host", F.col(at).alias("_at")).filter("host is not null and _at is not null").distinct()
    met = (F.col("host") == F.col("_host")) & (F.col("_at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("_at") < F.col("valid_to")))
    hits = keys.join(active, met).groupBy("_host", "_at").agg(F.array_sort(F.collect_set("list")).alias("lists"))
    of_host, when, names = hidden(base, "_host", "_at", "_lists")
    hits = hits.toDF(of_host, when, names)
    out = base.join(hits, (base["host"] == hits[of_host]) & (base[at] == hits[when]), "left")
    return out.select(*kept, "host", F.coalesce(F.array_join(names, ","), F.lit("")).alias("lists"), F.col(names).isNotNull().alias("blocked"))


def pages_as_captures(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Captures and dated entries derived from the pages table: times from page numbers, entries for hosts and domains by
    the least page number of each host."""
    day = lambda n: F.pmod(n, F.lit(365)).cast("int")
    captures = pages.select("page_id", "url", day(F.col("page_id") * 37).alias("fetched"))
    hosts = pages.select(host_of(F.col("url")).alias("pattern"), "page_id").filter("pattern is not null")
    hosts = hosts.groupBy("pattern").agg(F.min("page_id").alias("k"))
    start = day(F.col("k") * 13)
    parent = F.regexp_extract("pattern", r"([^.]+\.[^.]+\.[^.]+)$", 1)
    add = hosts.filter("k % 3 = 0").select(F.lit("abuse").alias("list"), "pattern", start.alias("at"), F.lit("add").alias("action"))
    gone = hosts.filter("k % 6 = 0").select(F.lit("abuse").alias("list"), "pattern", (start + 40).alias("at"), F.lit("remove").alias("action"))
    again = hosts.filter("k % 12 = 0").select(F.lit("abuse").alias("list"), "pattern", (start + 90).alias("at"), F.lit("add").alias("action"))
    wide = hosts.filter((F.col("k") % 10 == 0) & (parent != "")).select(F.lit("parked").alias("list"), parent.alias("pattern"), (start + 5).alias("at"), F.lit("add").alias("action"))
    return captures, add.unionByName(gone).unionByName(again).unionByName(wide)
