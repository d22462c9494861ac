"""The URL filter over the page table: captures, lists and the same in SQL.

The page table has no fetch dates and comes without lists.  Both follow from its rows by rule: a page is fetched on a
day given by page_id; lists hold domains, hosts and path prefixes of the table, each with dated entries given by the md5
of its key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.llm.url_filter import judge, url_keys

DAY_ZERO, DAYS = "2023-01-01", 730


def captures(pages: DataFrame) -> DataFrame:
    day = F.pmod(F.col("page_id") * 7919, F.lit(DAYS)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit(DAY_ZERO).cast("date"), day).alias("fetched"))


def _draw(key: Column, at: int) -> Column:
    return F.conv(F.substring(F.md5(key), at, 6), 16, 10).cast("long")


def entries(pages: DataFrame) -> DataFrame:
    """A third of the keys are on the block list from a day on, half of those leave it later, and a fifth of those come
    back; a seventh of the keys is on the allow list throughout."""
    keys = pages.select(F.explode(url_keys(F.col("url"))).alias("key")).distinct()
    drawn = keys.select("key", *[_draw(F.col("key"), 1 + 6 * i).alias(f"r{i}") for i in range(5)])
    zero = F.lit(DAY_ZERO).cast("date")

    def entry(name: str, kind: str, listed: bool, day: Column, when: Column) -> Column:
        return F.when(
            when,
            F.struct(
                F.lit(name).alias("list_name"),
                F.lit(kind).alias("kind"),
                F.lit(listed).alias("listed"),
                F.date_add(zero, day.cast("int")).alias("dated"),
            ),
        )

    begin, end = F.col("r1") % 500, F.col("r1") % 500 + 30 + F.col("r2") % 200
    blocked, left = F.col("r0") % 3 == 0, F.col("r3") % 2 == 0
    each = F.array(
        entry("abuse", "block", True, begin, blocked),
        entry("abuse", "block", False, end, blocked & left),
        entry("abuse", "block", True, end + 60, blocked & left & (F.col("r4") % 5 == 0)),
        entry("partners", "allow", True, F.lit(0), F.col("r0") % 7 == 0),
    )
    return drawn.select("key", F.explode(F.filter(each, lambda e: e.isNotNull())).alias("e")).select("key", "e.*")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(captures(pages), entries(pages))


_URL = "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)"
_DRAW = ", ".join(f"('0x' || substr(md5(key), {1 + 6 * i}, 6))::BIGINT AS r{i}" for i in range(5))
#: A list key as captures have it: the host lower-case, the path as it is.
_KEY = "lower(split_part(key, '/', 1)) || substr(key, length(split_part(key, '/', 1)) + 1)"
_ZERO = f"DATE '{DAY_ZERO}'"

ORACLE = f"""
WITH page AS (
  SELECT page_id, url, {_ZERO} + ((page_id * 7919) % {DAYS})::INTEGER AS fetched_on,
         regexp_replace(lower(regexp_extract(url, '{_URL}', 1)), '[.]$', '') AS host,
         list_filter(string_split(regexp_extract(url, '{_URL}', 2), '/'), lambda p: p <> '') AS parts
  FROM pages),
keyed AS (
  SELECT page_id, fetched_on, array_to_string(labels[i:], '.') AS key
  FROM (SELECT page_id, fetched_on, labels, unnest(range(1, greatest(len(labels), 2))) AS i
        FROM (SELECT *, string_split(host, '.') AS labels FROM page WHERE host <> ''))
  UNION ALL
  SELECT page_id, fetched_on, host || '/' || array_to_string(parts[1:i], '/')
  FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM page WHERE host <> '')),
drawn AS (SELECT key, {_DRAW} FROM (SELECT DISTINCT key FROM keyed)),
entry AS (
  SELECT 'abuse' AS list_name, 'block' AS kind, {_KEY} AS key, true AS listed, r1 % 500 AS day FROM drawn WHERE r0 % 3 = 0
  UNION ALL SELECT 'abuse', 'block', {_KEY}, false, r1 % 500 + 30 + r2 % 200 FROM drawn WHERE r0 % 3 = 0 AND r3 % 2 = 0
  UNION ALL SELECT 'abuse', 'block', {_KEY}, true, r1 % 500 + 90 + r2 % 200 FROM drawn
            WHERE r0 % 3 = 0 AND r3 % 2 = 0 AND r4 % 5 = 0
  UNION ALL SELECT 'partners', 'allow', {_KEY}, true, 0 FROM drawn WHERE r0 % 7 = 0),
day AS (SELECT list_name, kind, key, day, bool_or(listed) AS listed FROM entry GROUP BY ALL),
span AS (
  SELECT *, lead(day) OVER (PARTITION BY list_name, kind, key ORDER BY day) AS until FROM day),
hit AS (
  SELECT k.page_id, k.key, s.list_name, s.kind
  FROM keyed k JOIN span s ON k.key = s.key AND s.listed
   AND k.fetched_on >= {_ZERO} + s.day::INTEGER AND (s.until IS NULL OR k.fetched_on < {_ZERO} + s.until::INTEGER)),
best AS (
  SELECT *, count(*) OVER (PARTITION BY page_id) AS n_active,
         row_number() OVER (PARTITION BY page_id ORDER BY length(key) DESC, key DESC, kind <> 'block', list_name) AS nth
  FROM hit)
SELECT p.page_id, coalesce(p.host, '') AS host, p.fetched_on, coalesce(b.n_active, 0) AS n_active, b.key, b.list_name,
       b.kind, coalesce(b.kind = 'block', false) AS blocked
FROM page p LEFT JOIN best b ON p.page_id = b.page_id AND b.nth = 1
"""
