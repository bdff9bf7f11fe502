"""URL rules: a sort-merge range join of reversed hosts with nested rule intervals."""

from __future__ import annotations

from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.llm.common import fresh_name, table
from playmart.operators import Scratch

# The prescribed rules as (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
DEFAULT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Closes each label of a key; less than any character of a label.
CLOSE = "\x01"
#: Rows of one range of keys, about.
RANGE_ROWS = 200_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path; both empty without a ://."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each closed: the keys of a host and all of
    its subdomains are those that start with the host's key."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), CLOSE), F.lit(CLOSE))


class Sweep:
    """Keys in rising order against nested intervals of keys.

    The stack holds the rules whose interval is open at the current key, outermost
    first; an entry has the rules of one host by path.
    """

    def __init__(self, rules: list[tuple[str, str, str, str]]):
        self.rules = sorted({(key, host, path): verdict for key, host, path, verdict in sorted(rules)}.items())
        self.next = 0
        self.stack: list[tuple[str, str, dict[str, str]]] = []

    def _close(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def find(self, key: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits; the longer host on a tie."""
        while self.next < len(self.rules) and self.rules[self.next][0][0] <= key:
            (start, host, prefix), verdict = self.rules[self.next]
            self._close(start)
            if not self.stack or self.stack[-1][0] != start:
                self.stack.append((start, host, {}))
            self.stack[-1][2][prefix] = verdict
            self.next += 1
        self._close(key)
        best = None
        for _, host, paths in self.stack:
            for size in sorted({len(p) for p in paths}, reverse=True):
                prefix = path[:size]
                if len(prefix) == size and prefix in paths:
                    if best is None or len(host) + size >= best[0]:
                        best = (len(host) + size, host + prefix, paths[prefix])
                    break
        return None if best is None else best[1:]


def apply_rules(
    pages: DataFrame, rules: DataFrame, scratch: Scratch, url: str = "url", default: str = DEFAULT
) -> DataFrame:
    """Add host, path, rule and verdict to every row of ``pages``.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains where
    the url's path starts with the rule's; the longest host and path wins, the longer
    host on a tie, and the greatest verdict if a rule is given twice. Without a fitting
    rule, rule is null and verdict is ``default``.

    Rows are range-partitioned by their reversed host and a row number, so that one hot
    host spans several ranges, and written; each range gets the rules whose interval
    meets it and sweeps once over both. Only the bounds of the ranges are broadcast: a
    row for each range.

    A null url counts as one without host and path, which a rule with an empty host and
    path would fit. Rules with a null host or path are ignored. Repeated rows are judged
    each. Columns that are called like an added one are replaced; others stay.
    """
    spark = pages.sparkSession
    pages = pages.drop(*(c for c in pages.columns if c.lower() in ("host", "path", "rule", "verdict") and c != url))
    names = list(pages.columns)
    key, row, part = (fresh_name(names, n) for n in ("url_key", "url_row", "url_range"))
    host, path = host_and_path(F.col(url))
    keyed = pages.select("*", host.alias("host"), path.alias("path")).withColumns(
        {key: host_key(F.col("host")), row: F.monotonically_increasing_id()}
    )
    ranges = max(spark.sparkContext.defaultParallelism, ceil(pages.count() / RANGE_ROWS))
    stored = scratch.write("ranges", keyed.repartitionByRange(ranges, key, row).withColumn(part, F.spark_partition_id()))
    bounds = stored.groupBy(F.col(part).alias("range")).agg(F.min(key).alias("first"), F.max(key).alias("last"))

    start = host_key(F.col("host"))
    known = rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull()).select(
        start.alias("start"), F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict"
    )
    # Every key with the rule's key as its beginning is at least it and less than it
    # followed by a character beyond all others.
    meets = (F.col("start") <= F.col("last")) & (F.concat("start", F.lit("\U0010ffff")) >= F.col("first"))
    dealt = known.join(F.broadcast(bounds), meets).select("range", "start", "rule_host", "rule_path", "verdict")
    schema = T.StructType(
        [*stored.select(*names, "host", "path").schema, T.StructField("rule", T.StringType())]
    ).add("verdict", T.StringType())

    def run(urls: pa.Table, near: pa.Table) -> pa.Table:
        urls = urls.take(pa.compute.sort_indices(urls.column(key).cast(pa.binary())))
        columns = (near.column(c).to_pylist() for c in ("start", "rule_host", "rule_path", "verdict"))
        sweep = Sweep(list(zip(*columns, strict=True)))
        found = [sweep.find(k, p) for k, p in zip(urls.column(key).to_pylist(), urls.column("path").to_pylist(), strict=True)]
        out = urls.select([*names, "host", "path"])
        out = out.append_column("rule", pa.array([f and f[0] for f in found], type=pa.string()))
        return out.append_column("verdict", pa.array([f[1] if f else default for f in found], type=pa.string()))

    return stored.groupBy(part).cogroup(dealt.groupBy("range")).applyInArrow(run, schema)


def rule_rows(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host and path with the rule that decides it."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = apply_rules(pages, rule_rows(spark), Scratch(spark, "urls"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


_RULE_ROWS = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
OP7_SQL = f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULE_ROWS}),
rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS body
  FROM pages
),
cut AS (
  SELECT page_id, body, regexp_extract(body, '^[^/?#]*') AS raw FROM rest
),
parts AS (
  SELECT row_number() OVER () AS n, page_id, translate(raw, '{UPPER}', '{LOWER}') AS host,
    regexp_extract(substr(body, length(raw) + 1), '^[^?#]*') AS path
  FROM cut
),
fitting AS (
  SELECT n, rule_host || rule_path AS rule, rule_verdict
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) = 1
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, '{DEFAULT}') AS verdict
FROM parts LEFT JOIN fitting USING (n)
"""
