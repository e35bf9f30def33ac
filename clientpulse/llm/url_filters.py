"""URL filters over dated lists, in DataFrame expressions only.

List entries come as dated additions and removals. They become validity intervals; every capture is then evaluated
against the entries that were active when it was fetched, by an as-of join on the host names and path prefixes that
could match it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientpulse.llm.stored import stored

HOST_PART = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH_PART = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^?#]*)"
KINDS = ("host", "domain", "prefix")


def host_of(url: Column) -> Column:
    """The host name in lower case, without user, port and final dots; empty without one, null for null."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, HOST_PART, 1)), r"\.+$", "")


def segments_of(url: Column) -> Column:
    """The path's segments that are not empty."""
    return F.array_remove(F.split(F.regexp_extract(url, PATH_PART, 1), "/"), "")


def match_keys(url: Column) -> Column:
    """All (kind, pattern) that match a URL: its host, every domain of two labels or more above or at it, and every
    prefix of its path (``host/a``, ``host/a/b`` and so on)."""
    host, labels, path = host_of(url), F.split(host_of(url), r"\."), segments_of(url)
    domains = F.transform(
        F.filter(F.sequence(F.lit(1), F.size(labels)), lambda k: F.size(labels) - k >= 1),
        lambda k: F.struct(F.lit("domain").alias("kind"), F.array_join(
            F.slice(labels, k, F.size(labels)), ".").alias("pattern")))
    prefixes = F.transform(path, lambda _, k: F.struct(F.lit("prefix").alias("kind"), F.concat(
        host, F.lit("/"), F.array_join(F.slice(path, 1, k + 1), "/")).alias("pattern")))
    own = F.array(F.struct(F.lit("host").alias("kind"), host.alias("pattern")))
    return F.when(host != "", F.concat(own, domains, prefixes))


def intervals(entries: DataFrame) -> DataFrame:
    """(kind, pattern, valid_from, valid_to) from dated entries (kind, pattern, listed_on, action).

    An entry is valid from its addition to the next removal (open: null). Of several actions of one day a removal
    counts; an addition while valid and a removal while not valid change nothing. Entries with a null are left out.
    """
    known = entries.where(F.col("kind").isNotNull() & F.col("pattern").isNotNull() & F.col("listed_on").isNotNull()
                          & F.col("action").isin("add", "remove"))
    days = known.groupBy("kind", "pattern", "listed_on").agg(F.max("action").alias("action"))
    order = Window.partitionBy("kind", "pattern").orderBy("listed_on")
    changes = days.withColumn("before", F.lag("action", 1, "remove").over(order)).where(F.col("action") != F.col("before"))
    spans = changes.withColumn("valid_to", F.lead("listed_on").over(order))
    return spans.where(F.col("action") == "add").select("kind", "pattern", F.col("listed_on").alias("valid_from"), "valid_to")


def evaluated(captures: DataFrame, entries: DataFrame, url: str = "url", fetched_on: str = "fetched_on") -> DataFrame:
    """(row, active_entries, entry, blocked) per row of ``captures``.

    ``active_entries`` counts the entries that match the URL and were valid on its day, ``entry`` is the most specific
    of them (prefix before host before domain, the longest first), and ``blocked`` says whether there is any. Captures
    without URL, host or day match nothing; repeated rows are evaluated each; an empty list blocks nothing and an empty
    table gives no rows. Column names in ``captures`` may be anything.

    Each (URL, day) is evaluated once, however many captures it has, and meets only the entries of its own keys. A hot
    host is a skewed key of one equality join, whose other side holds few intervals per key.
    """
    packed = captures.select(F.struct("*").alias("row"), F.col(url).alias("of_url"), F.col(fetched_on).alias("of_day"))
    asked = packed.select("of_url", "of_day").where(F.col("of_url").isNotNull() & F.col("of_day").isNotNull()).distinct()
    keys = asked.withColumn("key", F.explode(match_keys(F.col("of_url")))).select("of_url", "of_day", "key.kind", "key.pattern")
    valid = stored(intervals(entries), "url-intervals")
    active = keys.join(valid, ["kind", "pattern"]).where(
        (F.col("valid_from") <= F.col("of_day")) & (F.col("valid_to").isNull() | (F.col("of_day") < F.col("valid_to"))))
    rank = F.when(F.col("kind") == "prefix", 0).when(F.col("kind") == "host", 1).otherwise(2)
    verdict = active.groupBy("of_url", "of_day").agg(
        F.count(F.lit(1)).alias("active_entries"),
        F.min(F.struct(rank.alias("rank"), (-F.length("pattern")).alias("size"), "kind", "pattern")).alias("first"))
    # As a table, so that Spark sees two plain shuffles and can split the partition of a capture with many rows.
    verdict = stored(verdict.select(F.col("of_url").alias("v_url"), F.col("of_day").alias("v_day"), "active_entries",
                             F.concat_ws(":", "first.kind", "first.pattern").alias("entry")), "url-verdicts")
    same = (F.col("of_url") == F.col("v_url")) & (F.col("of_day") == F.col("v_day"))
    return packed.join(verdict, same, "left").select(
        "row", F.coalesce("active_entries", F.lit(0).cast("long")).alias("active_entries"), "entry",
        F.col("active_entries").isNotNull().alias("blocked"))


# --- the lists and fetch days that the check query derives from the pages ---

FIRST_DAY = "2024-01-01"
#: Per kind of entry the days after its first listing on which it is removed and listed again (None: never again).
LIFE = {"host": (90, 200), "domain": (5, None), "prefix": (14, 30)}


def _number(c: Column) -> Column:
    return F.conv(F.substring(F.md5(c), 1, 7), 16, 10).cast("long")


def derived_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch day made of their number."""
    return pages.select("page_id", "url", F.date_add(F.lit(FIRST_DAY).cast("date"), (
        F.col("page_id") * 37 % 365).cast("int")).alias("fetched_on"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """Dated entries for every host, its domain of two labels and its first path segment, on days made of a hash."""
    host, path = host_of(F.col("url")), segments_of(F.col("url"))
    of_kind = {"host": host, "domain": F.substring_index(host, ".", -2),
               "prefix": F.when(F.size(path) > 0, F.concat(host, F.lit("/"), F.get(path, F.lit(0))))}
    named = F.array(*[F.struct(F.lit(k).alias("kind"), p.alias("pattern")) for k, p in of_kind.items()])
    every = pages.where(host != "").select(F.inline(named)).where(F.col("pattern").isNotNull()).distinct()
    start = F.date_add(F.lit(FIRST_DAY).cast("date"), (_number(F.col("pattern")) % 365).cast("int"))
    actions = F.lit(None)
    for kind, (removed, again) in LIFE.items():
        steps = [(0, "add"), (removed, "remove")] + ([(again, "add")] if again is not None else [])
        made = F.array(*[F.struct(F.lit(d).alias("after"), F.lit(a).alias("action")) for d, a in steps])
        actions = F.when(F.col("kind") == kind, made).otherwise(actions)
    return (every.withColumn("start", start).select("kind", "pattern", "start", F.inline(actions))
            .select("kind", "pattern", F.date_add("start", F.col("after")).alias("listed_on"), "action"))


def oracle() -> str:
    """The SQL of the query over the pages table."""
    steps = [(k, d, a) for k, (removed, again) in LIFE.items()
             for d, a in [(0, "add"), (removed, "remove")] + ([(again, "add")] if again is not None else [])]
    values = ", ".join(f"('{k}', {d}, '{a}')" for k, d, a in steps)
    return rf"""
WITH hosts AS (SELECT page_id, url, DATE '{FIRST_DAY}' + CAST(page_id * 37 % 365 AS INTEGER) AS fetched_on,
  regexp_replace(lower(regexp_extract(url, '{HOST_PART}', 1)), '\.+$', '') AS host,
  list_filter(string_split(regexp_extract(url, '{PATH_PART}', 1), '/'), lambda s: s <> '') AS path FROM pages),
named AS (SELECT DISTINCT kind, pattern FROM (SELECT unnest(['host', 'domain', 'prefix']) AS kind,
  unnest([host, array_to_string(string_split(host, '.')[-2:], '.'), CASE WHEN len(path) > 0 THEN host || '/' || path[1] END])
  AS pattern FROM hosts WHERE host <> '') WHERE pattern IS NOT NULL),
entries AS (SELECT n.kind, pattern, DATE '{FIRST_DAY}' + CAST(('0x' || substr(md5(pattern), 1, 7))::BIGINT % 365 + after AS
  INTEGER) AS listed_on, action FROM named n JOIN (VALUES {values}) s(kind, after, action) USING (kind)),
spans AS (SELECT a.kind, a.pattern, a.listed_on AS valid_from, (SELECT min(r.listed_on) FROM entries r WHERE r.kind = a.kind
  AND r.pattern = a.pattern AND r.action = 'remove' AND r.listed_on > a.listed_on) AS valid_to
  FROM entries a WHERE a.action = 'add'),
keys AS (SELECT page_id, url, fetched_on, 'host' AS kind, host AS pattern FROM hosts WHERE host <> ''
  UNION ALL SELECT page_id, url, fetched_on, 'domain', array_to_string(string_split(host, '.')[k:], '.') FROM
    (SELECT *, unnest(range(1, len(string_split(host, '.')))) AS k FROM hosts WHERE host <> '')
  UNION ALL SELECT page_id, url, fetched_on, 'prefix', host || '/' || array_to_string(path[:k], '/') FROM
    (SELECT *, unnest(range(1, len(path) + 1)) AS k FROM hosts WHERE host <> '')),
active AS (SELECT page_id, url, fetched_on, k.kind, k.pattern FROM keys k JOIN spans s ON s.kind = k.kind AND s.pattern = k.pattern
  AND s.valid_from <= fetched_on AND (s.valid_to IS NULL OR fetched_on < s.valid_to)),
verdict AS (SELECT page_id, url, count(*) AS active_entries, min_by(kind || ':' || pattern, (CASE kind WHEN 'prefix' THEN 0
  WHEN 'host' THEN 1 ELSE 2 END, -length(pattern), pattern)) AS entry FROM active GROUP BY page_id, url)
SELECT h.page_id, h.url, h.fetched_on, coalesce(active_entries, 0) AS active_entries, entry, active_entries IS NOT NULL AS
  blocked FROM hosts h LEFT JOIN verdict v ON v.page_id = h.page_id AND v.url = h.url
"""
