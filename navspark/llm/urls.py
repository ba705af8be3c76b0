"""URL filter: a blocked Bloom filter passes possible hits to an exact hash join.

Two lists judge a URL. Rules: a host and a path prefix with an action. A rule
fits a URL whose host is the rule's or lies below it and whose path starts with
the rule's; the longest rule that fits wins. Listed URLs: a URL that no rule
fits is blocked if its canonical form is listed.

Either list is met in the same way. A URL gives its keys (its canonical form; for
rules one key for every shape, labels in the host and characters in the path,
that occurs in the list), keys that the Bloom filter may hold go on to an exact
join with the list, which removes the false positives. Verdicts are found for
distinct URLs and joined back by the URL itself.

Canonical form: host in lower case (A-Z), without user, port 80 or 443, closing
dots and a leading ``www.``; path with its escapes decoded, without closing
slashes; query parameters sorted, without empty ones and those of tracking
(``utm_...``, ``ref``); no scheme and no fragment.

Defined results: a null URL, or one without ``://``, has an empty host and path
and no canonical form, fits no rule and is allowed. Repeated rows are each
judged. A rule with a null or empty host never fits; of equal rules the one with
the smaller action name (``allow``) wins. Other columns of the input are kept by
``judge_urls`` under their own names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navspark.llm.common import BROADCAST_ROWS, bloom_block, bloom_mask, fresh, stored

#: Lists of up to so many entries and BROADCAST_BYTES are broadcast; larger ones are joined by shuffle.
BROADCAST_RULES = 200_000
#: Lists of so many bytes, and verdicts of so many bytes of distinct URLs, are broadcast.
BROADCAST_BYTES = 32 << 20
#: The filter has at most so many blocks of 64 bits: 4 MB with their numbers.
MAX_BLOCKS = 1 << 18
#: Path prefixes are keys up to this length; longer ones are keyed by a multiple of it, up to the second, and then compared.
WHOLE_PREFIX, LONGEST_PREFIX = 64, 1024

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    raw = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(raw, F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """The canonical form; null for a null URL, or one without ``://``."""
    host = F.regexp_replace(F.regexp_replace(url_host(url), r"^.*@|(?::(?:80|443))?$", ""), r"\.+$|^www\.", "")
    path = url_path(url)
    decoded = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    query = F.regexp_extract(url, r"(?s)\A.*?://[^?#]*\?([^#]*)", 1)
    left = F.sort_array(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(r"^(utm_\w*|ref)(=|$)")))
    tail = F.when(F.size(left) > 0, F.concat(F.lit("?"), F.array_join(left, "&"))).otherwise("")
    return F.when(url.contains("://"), F.concat(host, F.regexp_replace(decoded, r"/+$", ""), tail))


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def _prefix_length(path: Column) -> Column:
    n = F.length(path)
    return F.when(n <= WHOLE_PREFIX, n).otherwise(F.least(F.floor(n / WHOLE_PREFIX) * WHOLE_PREFIX, F.lit(LONGEST_PREFIX)).cast("int"))


def _possible(probes: DataFrame, entries: DataFrame, n: int) -> DataFrame:
    """Rows of ``probes`` (key k) whose key the Bloom filter of the n ``entries`` (key e_k) may hold."""
    blocks = min(MAX_BLOCKS, max(8, 1 << (max(n, 1) // 4).bit_length()))
    bloom = entries.groupBy(bloom_block(F.col("e_k"), blocks).alias("b_block")).agg(F.bit_or(bloom_mask(F.col("e_k"))).alias("b_bits"))
    mask = bloom_mask(F.col("k"))
    held = (F.col("b_block") == bloom_block(F.col("k"), blocks)) & (F.col("b_bits").bitwiseAND(mask) == mask)
    return probes.join(F.broadcast(bloom), held).drop("b_block", "b_bits")  # at most MAX_BLOCKS rows of 12 bytes


def _rule_hits(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(u, rule, action): the longest rule that fits each distinct URL that any fits."""
    rules = rules.where("host IS NOT NULL AND host != ''").select(
        F.col("host").alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), F.col("action").alias("r_action")
    )
    rules = rules.groupBy("r_host", "r_path").agg(F.min("r_action").alias("r_action"))
    rules = rules.withColumns({"n": _labels(F.col("r_host")), "m": _prefix_length(F.col("r_path"))})
    rules = rules.withColumn("r_prefix", F.substr("r_path", F.lit(1), F.col("m"))).withColumn("e_k", F.xxhash64("r_host", "r_prefix"))
    # One row for each shape of entry: at most some eighty prefix lengths for each number of labels that occurs.
    held = F.sum((F.octet_length("r_host") + 2 * F.octet_length("r_path")).cast("long"))  # the prefix is a part of the path
    shapes = rules.groupBy("n", "m").agg(F.count("*").alias("entries"), held.alias("bytes")).collect()
    total, size = sum(r["entries"] for r in shapes), sum(r["bytes"] for r in shapes)
    lengths = F.array(*[F.struct(F.lit(r["n"]).alias("n"), F.lit(r["m"]).alias("m")) for r in shapes]) if shapes else F.array().cast("array<struct<n:int,m:int>>")
    seen = urls.withColumns({"host": url_host(F.col("u")), "path": url_path(F.col("u"))}).withColumns({"labels": _labels(F.col("host")), "size": F.length("path")})
    fit = F.filter(lengths, lambda s: (s["n"] <= F.col("labels")) & (s["m"] <= F.col("size")))
    part = lambda s: F.struct(F.call_function("substring_index", F.col("host"), F.lit("."), -s["n"]).alias("h"), F.substr(F.col("path"), F.lit(1), s["m"]).alias("p"))
    probes = seen.select("u", "path", F.explode(F.transform(fit, part)).alias("x")).select("u", "path", "x.h", "x.p", F.xxhash64("x.h", "x.p").alias("k"))
    exact = F.broadcast(rules) if total <= BROADCAST_RULES and size <= BROADCAST_BYTES else rules
    same = (F.col("k") == F.col("e_k")) & (F.col("h") == F.col("r_host")) & (F.col("p") == F.col("r_prefix")) & F.col("path").startswith(F.col("r_path"))
    longest = F.struct((F.length("r_host") + F.length("r_path")).alias("size"), F.concat("r_host", "r_path").alias("rule"), F.col("r_action").alias("action"))
    best = _possible(probes, rules, total).join(exact, same).groupBy("u").agg(F.max(longest).alias("best"))
    return best.select("u", "best.rule", "best.action")


def _listed_hits(urls: DataFrame, listed: DataFrame) -> DataFrame:
    """(u, listed): the distinct URLs whose canonical form ``listed`` (url) holds in any form."""
    entries = listed.select(canonical_url(F.col("url")).alias("e_url")).dropna().distinct().withColumn("e_k", F.xxhash64("e_url"))
    entries = stored(entries)
    n, size = entries.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("e_url")), F.lit(0))).first()
    probes = urls.select("u", canonical_url(F.col("u")).alias("c")).dropna().withColumn("k", F.xxhash64("c"))
    exact = F.broadcast(entries) if n <= BROADCAST_RULES and size <= BROADCAST_BYTES else entries
    hits = _possible(probes, entries, n).join(exact, (F.col("k") == F.col("e_k")) & (F.col("c") == F.col("e_url")))
    return hits.select("u").distinct().withColumn("listed", F.lit(True))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", listed: DataFrame | None = None) -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    ``rules`` has host, path and action (``allow`` or ``block``); its host is
    lower case already. ``listed`` has url. The result keeps the columns of
    ``pages`` and adds the four; a clash in name is resolved in favour of the
    new column.
    """
    urls = pages.select(F.col(url).alias("u")).dropna()
    found = _rule_hits(urls, rules)
    none = F.lit(None).cast("boolean")
    found = found.withColumn("listed", none) if listed is None else found.join(_listed_hits(urls, listed), "u", "full")
    u, rule, action, hit = fresh(pages, "nv_u", "nv_rule", "nv_action", "nv_listed")
    found = stored(found.select("u", "rule", "action", "listed").toDF(u, rule, action, hit))
    rows, size = found.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(u)), F.lit(0))).first()
    small = F.broadcast(found) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else found
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    verdict = F.coalesce(action, F.when(F.col(hit), "block"), F.lit("allow"))
    made = {"host": url_host(F.col(url)), "path": url_path(F.col(url)), "rule": F.col(rule), "verdict": verdict}
    joined = pages.join(small, F.col(url) == F.col(u), "left")
    return joined.select(*own, *[c.alias(n) for n, c in made.items()])
