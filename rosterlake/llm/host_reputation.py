"""URL filters: rules first, else the host's empirical-Bayes reputation, in DataFrame functions only.

Labelled page outcomes (good or not) are summed by host, by registered domain (the suffix and the label before it) and by suffix
(the last label of the host, or the last two where these are in MULTI_SUFFIXES). Each level is a beta-binomial whose prior mean is the posterior mean of the level above and whose
concentration is estimated from the spread of the level's shares (method of moments), so a host with few pages leans on its domain,
and that on its suffix. A host passes if the lower bound of its posterior (normal approximation) reaches a threshold.

All sums are pre-aggregated before they are shuffled; pages then meet the table of hosts, which is broadcast only up to a
checked number of rows and else joined by a shuffle that splits hot hosts (adaptive skew join). What reaches the driver is one row
per level. Defined results: a null url or one without `://` has an empty host and path, which form a host of their own; a host
without labelled outcomes gets the posterior of the nearest level that has some; repeated rows count as often as they occur.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Z = 1.645
MIN_BOUND = 0.8
#: Hosts (rows of about 60 bytes) up to which the reputation table is broadcast.
BROADCAST_HOSTS = 200_000
# Suffixes of two labels below which names are registered.
MULTI_SUFFIXES = (
    "ac.at", "co.at", "or.at", "com.ar", "com.au", "edu.au", "gov.au", "net.au", "org.au", "com.br", "gov.br", "org.br", "com.cn", "gov.cn", "net.cn", "org.cn",
    "com.hk", "co.id", "ac.il", "co.il", "ac.in", "co.in", "gov.in", "org.in", "ac.jp", "co.jp", "go.jp", "ne.jp", "or.jp", "ac.kr", "co.kr", "go.kr", "or.kr",
    "com.mx", "com.my", "ac.nz", "co.nz", "govt.nz", "org.nz", "com.pl", "com.ru", "com.sg", "com.tr", "com.tw", "com.ua", "ac.uk", "co.uk", "gov.uk", "ltd.uk",
    "me.uk", "net.uk", "org.uk", "plc.uk", "sch.uk", "ac.za", "co.za",
)
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def suffix_of(host: Column, suffixes: tuple[str, ...] = MULTI_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), two).otherwise(F.substring_index(host, ".", -1)) if suffixes else F.substring_index(host, ".", -1)


def domain_of(host: Column, suffixes: tuple[str, ...] = MULTI_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), F.substring_index(host, ".", -3)).otherwise(two) if suffixes else two


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...], value) -> Column:
    """value(rule) of the longest rule that fits, else null. Rules are part of the plan: meant for some hundreds at most."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, value(r)) if out is None else out.when(fits, value(r))
    return out if out is not None else F.lit(None).cast("string")


def _concentration(children: DataFrame, parents: DataFrame, parent: str) -> float:
    """Of the beta prior that children have below their parents, by moments; bounded so that a level without spread keeps a
    strong prior and one with all spread a weak one."""
    c = children.agg(F.count("*").alias("g"), F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk")).first()
    inside = children.groupBy(parent).agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"))
    p = inside.agg(F.count("*").alias("g"), F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk"), F.sum(F.col("nn") / F.col("n")).alias("nn")).first()
    if not c["n"]:
        return 2.0
    mean = c["k"] / c["n"]
    pq, free = mean * (1 - mean), c["g"] - p["g"]
    room = pq * (c["n"] - p["nn"] - free)
    share = (c["kk"] - p["kk"] - pq * free) / room if room > 0 else 0.0
    share = min(0.5, max(1e-3, share))
    return (1 - share) / share


def _posterior(n: Column, k: Column, mean: Column, strength: float) -> Column:
    return (k + mean * strength) / (n + strength)


def reputation(outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """outcomes: url, good (boolean or null). Gives (host, bound, mean) per host seen, and one row with the same for a new host
    of a new suffix."""
    return _levels(outcomes)[::3]


def _levels(outcomes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """bound and mean by host; for new hosts, by domain and by suffix; and the one row for all others."""
    seen = outcomes.where("good is not null").select(host_of(F.col("url")).alias("host"), F.col("good").cast("long").alias("good"))
    hosts = seen.groupBy("host").agg(F.count("*").alias("n"), F.sum("good").alias("k"))
    hosts = hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    hosts = materialize(hosts, "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("root", F.lit(""))
    root = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    top = (root["k"] + 1) / (root["n"] + 2)
    s_suffix = _concentration(suffixes, suffixes, "root")
    s_domain = _concentration(domains, suffixes, "suffix")
    s_host = _concentration(hosts, domains, "domain")
    n, k = F.col("n"), F.col("k")
    suffixes = suffixes.select("suffix", _posterior(n, k, F.lit(top), s_suffix).alias("suffix_mean"))
    domains = domains.join(suffixes, "suffix").select("domain", _posterior(n, k, F.col("suffix_mean"), s_domain).alias("domain_mean"))
    a, b = k + F.col("domain_mean") * s_host, n - k + (1 - F.col("domain_mean")) * s_host
    found = hosts.join(domains, "domain").select("host", a.alias("a"), b.alias("b"))
    # a new host of a known domain is drawn from below the domain, a new domain from below its suffix
    of_domain = domains.select("domain", (F.col("domain_mean") * s_host).alias("a"), ((1 - F.col("domain_mean")) * s_host).alias("b"))
    of_suffix = suffixes.select("suffix", (F.col("suffix_mean") * s_domain).alias("a"), ((1 - F.col("suffix_mean")) * s_domain).alias("b"))
    new = hosts.sparkSession.createDataFrame([(top * s_suffix, (1 - top) * s_suffix)], "a double, b double")
    return _bounded(found, "host"), _bounded(of_domain, "domain"), _bounded(of_suffix, "suffix"), _bounded(new)


def _bounded(df: DataFrame, *keep: str) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    mean = a / (a + b)
    return df.select(*keep, (mean - Z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))).alias("bound"), mean.alias("mean"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES, min_bound: float = MIN_BOUND) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    table, domains, suffixes, new = _levels(outcomes)
    new_bound = new.first()["bound"]
    if table.count() <= BROADCAST_HOSTS:  # there are no more domains or suffixes than hosts
        table, domains, suffixes = F.broadcast(table), F.broadcast(domains), F.broadcast(suffixes)
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    parts = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    parts = parts.withColumns({"domain": domain_of(host), "suffix": suffix_of(host)})
    domains = domains.select("domain", F.col("bound").alias("domain_bound"))
    suffixes = suffixes.select("suffix", F.col("bound").alias("suffix_bound"))
    by_method = F.when(F.coalesce("bound", "domain_bound", "suffix_bound", F.lit(new_bound)) >= min_bound, "allow").otherwise("block")
    return parts.join(table, "host", "left").join(domains, "domain", "left").join(suffixes, "suffix", "left").select(
        "page_id", "host", "path",
        rule_of(host, path, rules, lambda r: F.lit(r.name)).alias("rule"),
        F.coalesce(rule_of(host, path, rules, lambda r: F.lit(r.verdict)), by_method).alias("verdict"),
    )


#: Of 100 characters of a page's visible text so many must be letters. Prose has about 80; spam with marks between its words, lists of
#: numbers and broken encodings have less.
MIN_LETTERS = 72
_UNSEEN = r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>|&[a-z0-9#]+;"


def markup_outcomes(pages: DataFrame, min_letters: int = MIN_LETTERS) -> DataFrame:
    """Weak labels where no outcomes are given: a page is good if min_letters of 100 characters of its visible text (without tags,
    scripts, styles, comments and character references) are letters, and bad if not, or without a letter; no label without html."""
    seen = F.regexp_replace("html", _UNSEEN, "")
    letters = F.length(F.regexp_replace(seen, r"[^\p{L}]", ""))
    return pages.select("url", ((letters > 0) & (letters * 100 >= F.length(seen) * min_letters)).alias("good"))


ORACLE_SQL = r"""
with split as (
  select page_id, html, regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>|&[a-z0-9#]+;', '', 'g') as seen,
    case when url is null or not contains(url, '://') then '' else
      translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') end as host,
    case when url is null or not contains(url, '://') then '' else regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) end as path
  from pages),
labels_of as (select *, string_split(host, '.') as labels, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') as two from split),
parts as (
  select *, case when two in (SUFFIXES) then array_to_string(list_slice(labels, -3, -1), '.') else two end as domain,
    case when two in (SUFFIXES) then two else list_extract(labels, -1) end as suffix from labels_of),
hosts as (
  select host, count(*)::double n, sum(case when letters > 0 and letters * 100 >= length(seen) * 72 then 1 else 0 end)::double k,
    any_value(domain) as domain, any_value(suffix) as suffix
  from (select *, length(regexp_replace(seen, '[^\p{L}]', '', 'g')) as letters from parts) where html is not null group by host),
domains as (select domain, suffix, sum(n) n, sum(k) k, sum(n * n) nn from hosts group by domain, suffix),
suffixes as (select suffix, sum(n) n, sum(k) k from hosts group by suffix),
root as (select sum(n) n, sum(k) k, (sum(k) + 1) / (sum(n) + 2) top, sum(k) / sum(n) * (1 - sum(k) / sum(n)) pq from suffixes),
spread as (
  select
    ((select sum(k * k / n) from suffixes) - k * k / n - pq * ((select count(*) from suffixes) - 1))
      / nullif(pq * (n - (select sum(n * n) from suffixes) / n - ((select count(*) from suffixes) - 1)), 0) as g1,
    ((select sum(k * k / n) from domains) - (select sum(k * k / n) from suffixes) - pq * ((select count(*) from domains) - (select count(*) from suffixes)))
      / nullif(pq * (n - (select sum(x.nn / s.n) from (select suffix, sum(n * n) nn from domains group by suffix) x join suffixes s using (suffix))
        - ((select count(*) from domains) - (select count(*) from suffixes))), 0) as g2,
    ((select sum(k * k / n) from hosts) - (select sum(k * k / n) from domains) - pq * ((select count(*) from hosts) - (select count(*) from domains)))
      / nullif(pq * (n - (select sum(nn / n) from domains) - ((select count(*) from hosts) - (select count(*) from domains))), 0) as g3
  from root),
strength as (
  select (1 - a) / a s1, (1 - b) / b s2, (1 - c) / c s3 from (
    select least(0.5, greatest(0.001, coalesce(g1, 0))) a, least(0.5, greatest(0.001, coalesce(g2, 0))) b,
      least(0.5, greatest(0.001, coalesce(g3, 0))) c from spread)),
m1 as (select suffix, (k + top * s1) / (s.n + s1) mean from (select suffix, n, k from suffixes) s, strength, (select top from root)),
m2 as (select domain, (k + mean * s2) / (n + s2) mean from domains join m1 using (suffix), strength),
ab as (select host, k + mean * s3 a, n - k + (1 - mean) * s3 b from hosts join m2 using (domain), strength),
bound as (select host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) as bound from ab),
domain_bound as (select domain, mean - 1.645 * sqrt(mean * (1 - mean) / (s3 + 1)) as domain_bound from m2, strength),
suffix_bound as (select suffix, mean - 1.645 * sqrt(mean * (1 - mean) / (s2 + 1)) as suffix_bound from m1, strength),
ruled as (
  select page_id, host, path, domain, suffix,
    case when (host = 'www.example.com' or ends_with(host, '.www.example.com')) and starts_with(path, '/en/') then 'www.example.com/en/'
      when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/') then 'example.com/en/'
      when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/es/') then 'net/es/'
      when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/fr/') then 'net/fr/'
      when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/') then 'com/' end as rule
  from parts)
select page_id, host, path, rule,
  case when rule in ('com/', 'www.example.com/en/') then 'allow' when rule is not null then 'block'
    when coalesce(bound, domain_bound, suffix_bound, (select top - 1.645 * sqrt(top * (1 - top) / (s1 + 1)) from root, strength)) >= 0.8 then 'allow' else 'block' end as verdict
from ruled left join bound using (host) left join domain_bound using (domain) left join suffix_bound using (suffix)
""".replace("SUFFIXES", ", ".join(f"'{x}'" for x in MULTI_SUFFIXES))
