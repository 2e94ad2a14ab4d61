"""URL filters: explicit rules, then Empirical-Bayes host reputation (operator 3), in DataFrame operations only.

A label's ``doc_id`` names the page of the same ``page_id``; labels of other ids are of no page here and left out.  A page's outcome
is bad if its labels say toxic 1 or quality 0 (the worst of several label rows).  Hosts, registered domains and suffixes are three
levels of beta-binomial priors: a suffix is shrunk towards the share of bad pages over all, a domain towards its suffix, a host
towards its domain.  How strongly, is estimated at each level from how much the groups differ beyond what chance explains (method
of moments).  Without a rule, a url is blocked if the lower posterior bound of its host's bad share is above ``LIMIT``.  Mean and
bound are returned.  A host without labelled pages has its domain's posterior as prior and nothing more, one of a domain without
any its suffix's, and so on; its bound is as wide as one page drawn from that prior leaves it.

Null urls and urls without ``://`` have empty host and path and count as one host.  Repeated rows are judged each, and count each
where they are labelled.  No labels: nothing is blocked but by rules.  Null page ids are judged and have no label.  Very long urls
are judged whole.  Ties: of rules of one length the first by spelling.  Extra columns, also ones whose names clash, are ignored.
Empty table: no rows.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import only, written

#: (host and path, verdict): the host's part is up to the first slash.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: Block if the bad share is above LIMIT with the certainty of this many standard deviations.
LIMIT, DEVIATIONS = 0.5, 1.645
#: Prior strengths are kept within these, in pages.
WEAKEST, STRONGEST = 1.0, 1000.0
#: Suffixes of two labels that belong to registries (fixed values).
TWO_LABELS = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "co.kr", "com.br", "com.cn", "com.mx", "co.in", "co.za")


def host_of(url: Column) -> Column:
    rest = F.expr("substring(url, instr(url, '://') + 3)")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.instr(url, "://") > 0, host).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.expr("substring(url, instr(url, '://') + 3)")
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...], part: int) -> Column:
    """Part 0 (the rule) or 1 (its verdict) of the longest rule that fits; null if none does."""
    cases = []
    for rule in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        h, slash, p = rule[0].partition("/")
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(slash + p)
        cases.append(F.when(fits, F.lit(rule[part])))
    return F.coalesce(*cases) if cases else F.lit(None).cast("string")


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABELS), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    return F.when(F.substring_index(host, ".", -2).isin(*TWO_LABELS), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


@dataclass(frozen=True)
class Prior:
    """Strengths in pages, from the top: suffix, domain, host; and the mean over all."""

    mean: float
    strengths: tuple[float, float, float]


def outcomes(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, domain, suffix, n, bad): labelled pages by host."""
    marks = only(labels, "doc_id", "quality", "toxic").where("doc_id is not null").groupBy("doc_id").agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    seen = rows.join(marks, rows["page_id"] == marks["doc_id"]).groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
    return seen.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})


def _strength(groups: DataFrame) -> float:
    """Of groups (n, bad, mu: their parent's mean): the moment estimate of the beta prior's strength."""
    share = F.col("bad") / F.col("n")
    got = groups.agg(
        F.count(F.lit(1)).alias("g"),
        F.sum("n").alias("m"),
        F.sum(F.col("n") * F.col("n")).alias("m2"),
        F.sum(F.col("n") * (share - F.col("mu")) * (share - F.col("mu"))).alias("s"),
        F.sum(F.col("n") * F.col("mu") * (1 - F.col("mu"))).alias("v"),
    ).first()
    if not got.g or got.m * got.m == got.m2:
        return STRONGEST
    within = got.v / got.m
    between = (got.s - (got.g - 1) * within) / (got.m - got.m2 / got.m)
    if between <= 0 or within <= 0:
        return STRONGEST
    return min(STRONGEST, max(WEAKEST, within / between - 1))


@dataclass(frozen=True)
class Reputation:
    """(key, p, low) by host, domain and suffix: posterior mean of the bad share and its lower bound; and the prior over all."""

    host: DataFrame
    domain: DataFrame
    suffix: DataFrame
    prior: Prior


def lower(p: Column, strength: Column) -> Column:
    """The lower bound of a share whose beta distribution has this mean and as many pages behind it."""
    return p - DEVIATIONS * F.sqrt(p * (1 - p) / (strength + 1))


def reputations(seen: DataFrame) -> Reputation:
    """From :func:`outcomes`.  Only sums reach the driver."""
    total = seen.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = ((total.bad or 0) + 1) / ((total.n or 0) + 2)
    shrunk = lambda k: (F.lit(k) * F.col("mu") + F.col("bad")) / (F.lit(k) + F.col("n"))
    level = lambda *keys: seen.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffix = level("suffix").withColumn("mu", F.lit(mean))
    k_suffix = _strength(suffix)
    suffix = suffix.select("suffix", shrunk(k_suffix).alias("p"))
    domain = level("domain", "suffix").join(suffix.withColumnRenamed("p", "mu"), "suffix")
    k_domain = _strength(domain)
    domain = domain.select("domain", shrunk(k_domain).alias("p"))
    host = seen.join(domain.withColumnRenamed("p", "mu"), "domain")
    k_host = _strength(host)
    p = F.col("p")
    host = host.select("host", shrunk(k_host).alias("p"), "n").select("host", "p", lower(p, k_host + F.col("n")).alias("low"))
    domain = domain.withColumn("low", lower(p, F.lit(k_host)))
    suffix = suffix.withColumn("low", lower(p, F.lit(k_domain)))
    return Reputation(host, domain, suffix, Prior(mean, (k_suffix, k_domain, k_host)))


def judge(pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, limit: float = LIMIT) -> DataFrame:
    """page_id, host, path, rule, verdict, posterior and bound of every row of ``pages`` (page_id, url); labels: doc_id, quality, toxic."""
    url = F.col("url")
    rows = only(pages, "page_id", "url").select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    known = reputations(written(outcomes(rows, labels), "outcomes"))
    named = lambda df, key: df.select(F.col(key).alias(f"of_{key}"), F.col("p").alias(f"{key}_p"), F.col("low").alias(f"{key}_low"))
    joined = rows
    for df, key, own in ((known.host, "host", F.col("host")), (known.domain, "domain", domain_of(F.col("host"))), (known.suffix, "suffix", suffix_of(F.col("host")))):
        joined = joined.join(named(df, key), own == F.col(f"of_{key}"), "left")
    least = lower(F.lit(known.prior.mean), F.lit(known.prior.strengths[0]))
    posterior = F.round(F.coalesce("host_p", "domain_p", "suffix_p", F.lit(known.prior.mean)), 6)
    bound = F.round(F.coalesce("host_low", "domain_low", "suffix_low", least), 6)
    verdict = F.coalesce(rule_of(F.col("host"), F.col("path"), rules, 1), F.when(bound > limit, "block").otherwise("allow"))
    return joined.select("page_id", "host", "path", rule_of(F.col("host"), F.col("path"), rules, 0).alias("rule"), verdict.alias("verdict"), posterior.alias("posterior"), bound.alias("bound"))


def _sql_case(part: int) -> str:
    out = []
    for rule in sorted(RULES, key=lambda r: (-len(r[0]), r[0])):
        h, slash, p = rule[0].partition("/")
        out.append(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{slash + p}') THEN '{rule[part]}'")
    return f"CASE {' '.join(out)} END"


_TWO = ", ".join(f"'{t}'" for t in TWO_LABELS)
_LAST = lambda k: f"array_to_string(list_reverse(list_reverse(string_split(host, '.'))[1:{k}]), '.')"


def _sql_strength(groups: str) -> str:
    return f"""(SELECT CASE WHEN g = 0 OR m * m = m2 OR v <= 0 OR s - (g - 1) * v / m <= 0 THEN {STRONGEST}
      ELSE least({STRONGEST}, greatest({WEAKEST}, (v / m) / ((s - (g - 1) * v / m) / (m - m2 / m)) - 1)) END
      FROM (SELECT count(*) g, sum(n)::DOUBLE m, sum(n * n)::DOUBLE m2, sum(n * (bad / n - mu) * (bad / n - mu)) s, sum(n * mu * (1 - mu)) v FROM {groups}))"""


ORACLE = f"""
WITH rows AS (
  SELECT page_id, translate(CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*') ELSE '' END,
      '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
    CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
named AS (SELECT *, CASE WHEN {_LAST(2)} IN ({_TWO}) THEN {_LAST(3)} ELSE {_LAST(2)} END AS domain,
    CASE WHEN {_LAST(2)} IN ({_TWO}) THEN {_LAST(2)} ELSE {_LAST(1)} END AS suffix FROM rows),
marks AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
seen AS (SELECT host, domain, suffix, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS bad FROM named JOIN marks ON page_id = doc_id GROUP BY ALL),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) FROM seen) AS mu FROM seen GROUP BY suffix),
s1 AS (SELECT suffix, (k * mu + bad) / (k + n) AS p FROM s0, (SELECT {_sql_strength('s0')} AS k)),
d0 AS (SELECT domain, s.suffix, s.n, s.bad, s1.p AS mu FROM (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM seen GROUP BY ALL) s JOIN s1 ON s.suffix = s1.suffix),
d1 AS (SELECT domain, (k * mu + bad) / (k + n) AS p FROM d0, (SELECT {_sql_strength('d0')} AS k)),
h0 AS (SELECT host, seen.n, seen.bad, d1.p AS mu FROM seen JOIN d1 ON seen.domain = d1.domain),
kh AS (SELECT {_sql_strength('h0')} AS k),
kd AS (SELECT {_sql_strength('d0')} AS k),
ks AS (SELECT {_sql_strength('s0')} AS k),
h1 AS (SELECT host, p, p - {DEVIATIONS} * sqrt(p * (1 - p) / (k + n + 1)) AS low FROM (SELECT host, n, k, (k * mu + bad) / (k + n) AS p FROM h0, kh)),
d2 AS (SELECT domain, p, p - {DEVIATIONS} * sqrt(p * (1 - p) / (k + 1)) AS low FROM d1, kh),
s2 AS (SELECT suffix, p, p - {DEVIATIONS} * sqrt(p * (1 - p) / (k + 1)) AS low FROM s1, kd),
a0 AS (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) AS p FROM seen),
a1 AS (SELECT p, p - {DEVIATIONS} * sqrt(p * (1 - p) / (k + 1)) AS low FROM a0, ks),
said AS (SELECT page_id, named.host AS host, path, round(coalesce(h1.p, d2.p, s2.p, a1.p), 6) AS posterior, round(coalesce(h1.low, d2.low, s2.low, a1.low), 6) AS bound
  FROM named LEFT JOIN h1 ON named.host = h1.host LEFT JOIN d2 ON named.domain = d2.domain LEFT JOIN s2 ON named.suffix = s2.suffix, a1)
SELECT page_id, host, path, {_sql_case(0)} AS rule, coalesce({_sql_case(1)}, CASE WHEN bound > {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict, posterior, bound FROM said
"""
