"""URL filtering by a temporal list join.

Lists change: an entry is added on a date and may be removed and added again later. Dated entries become
intervals of validity per (list, kind, value), and every capture is evaluated against the entries that were
active when it was fetched: an equi-join on the capture's keys with an as-of condition on its date.

A capture's keys are its URL without fragment, its host and every parent domain of it, and the words of host
and path. Intervals of one entry do not overlap, so a capture meets each entry at most once. The most specific
entry decides: URL before domain before word, longer domains before shorter ones; allowing wins over blocking.

Only column functions are used. Intervals are broadcast while their count is below the bound; beyond it the
join is a shuffled one whose hot keys adaptive execution splits. Captures are folded to one row per id with
partial aggregation first.

Defined cases: a null or unparsable URL has no keys and is not blocked; a null date is outside all intervals;
entries with a null value, action or date are ignored; repeated additions or removals change nothing; on one
day removal comes before addition, so the entry is valid from that day on; equal capture ids are rows of their
own; empty lists block nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bikeflow.llm.tables import landed, small_side, table

DAY_ZERO = "2024-01-01"
DAYS = 366
# Sample data for the registered query; lists are an input of the operator.
BLOCKED_WORDS = ("casino", "bets", "porn", "pills", "warez")


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, value, valid_from, valid_to) from dated entries (list, kind, value, action, dated).

    ``list`` is "block" or "allow", ``action`` "add" or "remove"; valid_to is exclusive, null while valid.
    """
    usable = entries.filter("value is not null and dated is not null and action in ('add', 'remove')")
    usable = usable.select("list", "kind", F.lower("value").alias("value"), (F.col("action") == "add").alias("on"), "dated")
    # One state per day: valid if the day's last action, removal before addition, leaves it so.
    days = usable.groupBy("list", "kind", "value", "dated").agg(F.max("on").alias("on"))
    one = Window.partitionBy("list", "kind", "value").orderBy("dated")
    changes = days.withColumn("was", F.lag("on", 1, False).over(one)).filter(F.col("on") != F.col("was"))
    spans = changes.withColumn("valid_to", F.lead("dated").over(one)).filter("on")
    return spans.select("list", "kind", "value", F.col("dated").alias("valid_from"), "valid_to")


def url_keys(url):
    """Array of (kind, value, weight) of a URL; null without a host."""
    plain = F.lower(F.regexp_replace(url, "#.*$", ""))
    host = F.regexp_extract(plain, r"^[a-z][a-z0-9+.-]*://(?:[^/?@]*@)?([^/:?]+)", 1)
    path = F.regexp_extract(plain, r"^[a-z][a-z0-9+.-]*://[^/?]+([^?]*)", 1)
    labels = F.split(host, r"\.")
    key = lambda kind, value, weight: F.struct(F.lit(kind).alias("kind"), value.alias("value"), weight.cast("int").alias("weight"))
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: key("domain", F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."), 1000 + F.size(labels) - i),
    )
    words = F.array_distinct(F.filter(F.split(F.concat(host, path), "[^a-z0-9]+"), lambda w: w != ""))
    keys = F.concat(F.array(key("url", plain, F.lit(1_000_000))), parents, F.transform(words, lambda w: key("word", w, F.lit(0))))
    return F.when(host != "", keys)


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """capture_id, url, fetched_on with blocked and the deciding rule ("kind:value", empty if none).

    ``captures``: capture_id, url, fetched_on.
    """
    spark = captures.sparkSession
    spans = landed(spark, intervals(entries), "intervals")
    size = spans.count()
    # Ids may repeat; what decides depends only on URL and date.
    asked = captures.select("url", "fetched_on").distinct()
    keyed = asked.filter("fetched_on is not null").select("url", "fetched_on", F.explode(url_keys(F.col("url"))).alias("key"))
    keyed = keyed.select("url", "fetched_on", "key.kind", "key.value", "key.weight")
    met = keyed.join(small_side(spans, size), ["kind", "value"]).filter(
        (F.col("fetched_on") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to")))
    )
    strength = F.struct("weight", (F.col("list") == "allow").alias("allow"), "value")
    best = met.groupBy("url", "fetched_on").agg(
        F.max_by(F.struct("list", "kind", "value"), strength).alias("rule")
    )
    return captures.join(best, ["url", "fetched_on"], "left").select(
        "capture_id",
        "url",
        "fetched_on",
        (F.coalesce(F.col("rule.list"), F.lit("")) == "block").alias("blocked"),
        F.concat_ws(":", F.col("rule.kind"), F.col("rule.value")).alias("rule"),
    )


def _draw(value):
    """A number below 65536 that a text determines."""
    return F.conv(F.substring(F.md5(value), 1, 4), 16, 10).cast("int")


def _dated(days):
    return F.date_add(F.lit(DAY_ZERO).cast("date"), days)


def op2_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    """Every page as a capture, against lists made of the table's own hosts and the blocked words.

    Pages have no fetch date and there is no list table, so both are derived: a page is fetched on day
    page_id mod 366; a third of the domains are blocked for 60 days and again from day 120 after their
    first entry; a third of the hosts of another third are allowed from some day on, their domain blocked.
    """
    pages = table(spark, sf, "pages").select("page_id", "url")
    captures = pages.select(
        F.col("page_id").alias("capture_id"), "url", _dated(F.pmod("page_id", F.lit(DAYS)).cast("int")).alias("fetched_on")
    )
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?([^/:?#]+)", 1))
    hosts = pages.select(host.alias("host")).filter("host != ''").distinct()
    hosts = hosts.select("host", F.substring_index("host", ".", -3).alias("domain"))
    domains = hosts.select("domain").distinct().withColumn("draw", _draw(F.col("domain")))
    blocked = domains.filter("draw % 3 < 2").withColumn("first", F.col("draw") % 200)
    action = lambda name, after: F.struct(F.lit(name).alias("action"), _dated(F.col("first") + after).alias("dated"))
    changes = F.when(F.col("draw") % 3 == 0, F.array(action("add", 0), action("remove", 60), action("add", 120))).otherwise(
        F.array(action("add", 0))
    )
    entry = lambda frame, list_, value: frame.select(
        F.lit(list_).alias("list"), F.lit("domain").alias("kind"), F.col(value).alias("value"), "change.action", "change.dated"
    )
    entries = entry(blocked.withColumn("change", F.explode(changes)), "block", "domain")
    spared = hosts.filter("host != domain").withColumn("draw", _draw(F.col("host"))).filter("draw % 3 = 0")
    spared = spared.withColumn("first", F.col("draw") % 100).withColumn("change", action("add", 0))
    words = spark.createDataFrame([(w,) for w in BLOCKED_WORDS], "value string").select(
        F.lit("block").alias("list"),
        F.lit("word").alias("kind"),
        "value",
        F.lit("add").alias("action"),
        F.lit("2024-03-01").cast("date").alias("dated"),
    )
    entries = entries.unionByName(entry(spared, "allow", "host")).unionByName(words)
    found = filter_captures(captures, entries)
    return found.select(F.col("capture_id").alias("page_id"), "url", "fetched_on", "blocked", "rule")


OP2_SQL = r"""
WITH c AS (SELECT page_id, url, CAST(DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS DATE) AS fetched_on,
           lower(regexp_replace(url, '#.*$', '')) AS plain FROM pages),
h AS (SELECT *, regexp_extract(plain, '^[a-z][a-z0-9+.-]*://(?:[^/?@]*@)?([^/:?]+)', 1) AS host,
      regexp_extract(plain, '^[a-z][a-z0-9+.-]*://[^/?]+([^?]*)', 1) AS path FROM c),
hosts AS (SELECT DISTINCT host, array_to_string(list_slice(string_split(host, '.'), -3, -1), '.') AS domain FROM h WHERE host <> ''),
dom AS (SELECT domain, draw, draw % 200 AS first FROM (SELECT domain, CAST('0x' || substr(md5(domain), 1, 4) AS INTEGER) AS draw
        FROM (SELECT DISTINCT domain FROM hosts)) WHERE draw % 3 < 2),
spared AS (SELECT host, draw % 100 AS first FROM (SELECT host, domain, CAST('0x' || substr(md5(host), 1, 4) AS INTEGER) AS draw FROM hosts)
           WHERE host <> domain AND draw % 3 = 0),
spans AS (
  SELECT 'block' AS list, 'domain' AS kind, domain AS value, DATE '2024-01-01' + first AS f,
         CASE WHEN draw % 3 = 0 THEN DATE '2024-01-01' + (first + 60) END AS t FROM dom
  UNION ALL SELECT 'block', 'domain', domain, DATE '2024-01-01' + (first + 120), NULL FROM dom WHERE draw % 3 = 0
  UNION ALL SELECT 'allow', 'domain', host, DATE '2024-01-01' + first, NULL FROM spared
  UNION ALL SELECT 'block', 'word', w, DATE '2024-03-01', NULL FROM (SELECT unnest(['casino', 'bets', 'porn', 'pills', 'warez']) AS w)),
lab AS (SELECT *, string_split(host, '.') AS ls FROM h WHERE host <> ''),
k AS (SELECT page_id, fetched_on, 'domain' AS kind, array_to_string(ls[i:], '.') AS value, 1000 + len(ls) - i AS weight
      FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM lab)
      UNION ALL SELECT DISTINCT page_id, fetched_on, 'word', w, 0
      FROM (SELECT page_id, fetched_on, unnest(regexp_split_to_array(host || path, '[^a-z0-9]+')) AS w FROM lab) WHERE w <> ''),
m AS (SELECT page_id, list, kind, k.value, row_number() OVER (PARTITION BY page_id ORDER BY weight DESC, list = 'allow' DESC, k.value DESC) AS r
      FROM k JOIN spans s USING (kind) WHERE k.value = s.value AND fetched_on >= f AND (t IS NULL OR fetched_on < t))
SELECT c.page_id, c.url, c.fetched_on, coalesce(m.list = 'block', false) AS blocked, coalesce(m.kind || ':' || m.value, '') AS rule
FROM c LEFT JOIN m ON m.page_id = c.page_id AND m.r = 1
"""
