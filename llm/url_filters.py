"""URL filters: block and allow rules on hosts, their subdomains, and paths.

Method: every URL is expanded into expressions, host suffix times path prefix (prefixes of the
lengths that the rules have). Expressions meet rules by an equi-join on the first four
bytes of their SHA-256; full digests confirm; the longest rule wins, then the one with the
longer host, then block before allow.

Results for special rows: a null URL, or one without ``://``, has an empty host and path and no rule; a rule
without a host fits nothing; repeated rules count once; ports and user names belong to the host as written. Input columns
stay; ``host``, ``path``, ``rule`` and ``verdict`` replace those of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.storage import packed, read, unpacked

#: Fixed values of the contract.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
DEFAULT = "allow"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_DIGITS = 8


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): what follows the first ``://`` up to ``/``, ``?`` or ``#``; then up to ``?`` or ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\x00"), path), 256)


def expressions(host: Column, path: Column, lengths: list[int]) -> Column:
    """Digests of all pairs of a host suffix and a path prefix of one of the lengths."""
    labels = F.split(host, "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length(path))
    pairs = F.transform(suffixes, lambda s: F.transform(fitting, lambda n: digest(s, F.substring(path, F.lit(1), n))))
    return F.flatten(pairs)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``pages`` (with ``url``) and ``host``, ``path``, ``rule`` and ``verdict``; ``rules`` are (host, path, verdict)."""
    known = rules.filter("host <> '' and path is not null and verdict is not null")
    known = known.select(F.translate("host", UPPER, LOWER).alias("h"), F.col("path").alias("p"), F.col("verdict").alias("v"))
    known = known.withColumn("full", digest(F.col("h"), F.col("p"))).withColumn("short", F.substring("full", 1, PREFIX_DIGITS))
    # distinct lengths of rule paths: bounded by the longest path, whatever the number of rules
    lengths = sorted(r[0] for r in known.select(F.length("p")).distinct().collect())

    host, path = url_parts(F.col("url"))
    base = packed(pages, host.alias("host"), path.alias("path"))
    once = base.filter("host <> ''").select("host", "path").distinct()
    spread = once.select("host", "path", F.explode(expressions(F.col("host"), F.col("path"), lengths)).alias("digest")) if lengths else None
    if spread is None:
        judged = base.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    else:
        spread = spread.withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))
        met = spread.join(known, "short").filter(F.col("digest") == F.col("full"))
        order = F.struct(F.length("h") + F.length("p"), F.length("h"), F.col("v"))
        best = met.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("h", "p").alias("rule"), F.col("v").alias("verdict")), order).alias("best"))
        judged = base.join(best, ["host", "path"], "left")
        judged = judged.withColumns({"rule": F.col("best.rule"), "verdict": F.coalesce("best.verdict", F.lit(default))})
    return unpacked(judged, pages.columns, **{c: F.col(c) for c in ("host", "path", "rule", "verdict")})


def op3_url_filters(spark, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


ORACLE = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(h, p, v) AS (VALUES {", ".join(str(r) for r in RULES)}
), fits AS (
  SELECT page_id, host, path, h || p AS rule, v,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(h || p) DESC) AS place
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT a.page_id, a.host, a.path, f.rule, coalesce(f.v, '{DEFAULT}') AS verdict
FROM parts a LEFT JOIN fits f ON f.page_id = a.page_id AND f.host = a.host AND f.path = a.path AND f.place = 1
"""
