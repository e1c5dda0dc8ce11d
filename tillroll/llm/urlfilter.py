"""URL filters: a blocked Bloom filter of listed keys in front of an exact hash join.

A url is judged by its canonical form: host (A-Z lower-cased) and path, without
scheme, query and fragment: urls that differ in their query only are one url to the list. The list holds canonical urls and rules; a rule is a host
with a path prefix and fits the host, its subdomains and every path that starts so. Each
url yields a few keys (host suffixes times the path-prefix lengths that rules have,
and its own canonical url). Keys pass the Bloom filter, which travels by broadcast and is bounded
by ``bloom.MAX_BLOCKS`` whatever the list holds (a longer list fills it, and more keys go to the join); only its possible hits are shuffled to the exact join,
which removes false positives. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.bloom import bloom, blocks_for, possible
from tillroll.llm.common import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]   # host, path prefix, verdict


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: the host up to ``/``, ``?`` or ``#``, then the path up to ``?`` or ``#``; else both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def canonical_key(host: Column, path: Column) -> Column:
    """Key of one url: its host and its path without trailing slashes. The space keeps it apart from rules."""
    return F.concat(F.lit("url "), host, F.regexp_replace(path, "/+$", ""))


def judge(pages: DataFrame, rules: list[Rule], urls: DataFrame | None = None,
          key: str = "page_id", url: str = "url") -> DataFrame:
    """Per row: key, host, path, rule (host and prefix of the longest fitting rule, else null) and verdict.

    The verdict is the rule's; without a rule it is ``block`` if the canonical url is one of
    ``urls`` (column ``url``), else ``allow``. A null url, or one without ``://``, has an empty host and path, fits
    no rule and is allowed. Rules of equal length go by the longer host, then by the greater text; a rule
    given twice keeps its first verdict. Repeated rows are judged alike, null keys like others, and other
    columns are not read.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark)
    first = {}
    for host, path, verdict in rules:
        if not host or verdict not in ("allow", "block"):
            raise ValueError(f"bad rule {(host, path, verdict)}")
        first.setdefault(host.translate(str.maketrans(UPPER, LOWER)) + path, (host, path, verdict))
    entries = [F.struct(F.lit(k).alias("key"), F.lit(v).alias("verdict"), F.lit(len(k)).alias("size"),
                        F.lit(len(h)).alias("host_size")) for k, (h, _, v) in first.items()]
    listed = spark.range(1).select(F.inline(F.array(*entries).cast(
        "array<struct<key:string,verdict:string,size:int,host_size:int>>")))
    if urls is not None:
        h, p = host_and_path(F.col("url"))
        own = urls.select(canonical_key(h, p).alias("key")).where(F.col("key") != "url ").distinct()
        listed = listed.unionByName(own.select("key", F.lit("block").alias("verdict"), F.lit(0).alias("size"),
                                               F.lit(0).alias("host_size")))
    listed = scratch.save(listed)
    blocks = blocks_for(listed.count())
    filter_ = bloom(listed, blocks)

    h, p = host_and_path(F.col(f"`{url}`"))
    rows = pages.select(F.col(f"`{key}`").alias("key_"), h.alias("host"), p.alias("path"))
    distinct = rows.select("host", "path").distinct().where("host <> ''")
    lengths = sorted({len(path) for _, path, _ in rules})
    # only suffixes of as many labels as a rule's host has, however long the url's host is
    labels = sorted({host.count(".") + 1 for host, _, _ in rules})
    suffixes = F.array(*[F.substring_index("host", ".", -n) for n in labels]) if labels else F.array().cast("array<string>")
    prefixes = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths])
                        if lengths else F.array().cast("array<string>"), lambda x: x.isNotNull())
    keys = F.concat(F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda x: F.concat(s, x)))),
                    F.array(canonical_key(F.col("host"), F.col("path"))))
    keyed = distinct.select("host", "path", F.explode(F.array_distinct(keys)).alias("key"))
    # a scan on the list's side and plain rows on the other, so AQE may split a rule that fits most urls
    hits = possible(keyed, filter_, blocks).join(listed.hint("shuffle_hash"), "key")
    best = scratch.save(hits.groupBy("host", "path").agg(F.max(F.struct(
        "size", "host_size", "key", "verdict")).alias("best")).select("host", "path", "best.*"))
    rule = F.when(F.col("size") > 0, F.col("key"))
    # compressed files look smaller than their rows are: never broadcast what grows with the input
    return rows.join(best.hint("merge"), ["host", "path"], "left").select(
        F.col("key_").alias(key), "host", "path", rule.alias("rule"),
        F.coalesce("verdict", F.lit("allow")).alias("verdict"))
