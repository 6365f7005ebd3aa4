"""URL filter: hand-written rules first, then the reputation of the host, shrunk towards its domain and suffix.

Labelled pages give each host a count of outcomes and of bad ones. Its rate is taken as beta-distributed around
the posterior mean of its registered domain, that one's around the mean of its public suffix, and the suffix's
around the rate of all labelled pages. How strongly a level is drawn to the one above is estimated from the
excess of its members' variance over the binomial one (moments of the beta-binomial). A host without labels has
its domain's posterior. A page is blocked if the bad rate lies above ``limit`` even ``deviations`` posterior
standard deviations below the mean.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.session import materialize, small_side

LIMIT = 0.3  # bad rate above which a host is blocked
DEVIATIONS = 1.0  # posterior standard deviations by which the mean has to exceed the limit
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 10_000.0  # outcomes that a prior counts for
HOT_SHARE = 1_000  # a host of more than one in so many pages is hot; there are fewer than that many such hosts
# fixed values: public suffixes of two labels
TWO_LABEL_SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp", "or.jp", "co.kr",
    "com.br", "com.cn", "com.mx", "com.tr", "com.tw", "co.in", "co.za", "com.ar", "com.sg", "com.hk",
)


@dataclass(frozen=True)
class Rule:
    """Allow or block a host with its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """From behind the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def public_suffix(host: Column) -> Column:
    """The last label, the last two where they are a known suffix; an address of numbers is its own suffix."""
    two = F.substring_index(host, ".", -2)
    by_number = host.rlike(r"^[0-9.]+(:[0-9]*)?$")
    return F.when(by_number, host).when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def registered_domain(host: Column) -> Column:
    """The public suffix and one label before it."""
    suffix = public_suffix(host)
    labels = F.size(F.split(suffix, r"\.")) + 1
    return F.when(suffix == host, host).otherwise(F.array_join(F.slice(F.split(host, r"\."), -labels, labels), "."))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits; of equal ones ``block`` wins. Null where none fits."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(set(rules), key=lambda r: (len(r.text), len(r.host), r.verdict == "block", r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _strength(members: DataFrame) -> float:
    """How many outcomes the prior counts for, from members' (n, k) and their prior mean m."""
    even = F.col("n") * F.col("m") * (1 - F.col("m"))
    seen, binomial, most = members.agg(
        F.sum((F.col("k") - F.col("n") * F.col("m")) ** 2), F.sum(even), F.sum(even * (F.col("n") - 1))).first()
    if not most:
        return LEAST_STRENGTH
    rho = (seen - binomial) / most
    return max(LEAST_STRENGTH, min(MOST_STRENGTH, 1 / rho - 1)) if rho > 0 else MOST_STRENGTH


def _shrunk(members: DataFrame) -> DataFrame:
    """Posterior ``mean`` and ``weight`` (prior strength and outcomes) of members with n, k and the prior mean m."""
    s = F.lit(_strength(members))
    return members.withColumn("mean", (s * F.col("m") + F.col("k")) / (s + F.col("n"))).withColumn("weight", s + F.col("n"))


def host_reputation(hosts: DataFrame) -> DataFrame:
    """(host, n, k, mean, bound): posterior bad rate of each host and its lower bound, from outcomes n and bad ones k.

    ``hosts`` has one row per host, n = 0 where nothing is labelled. Without any label all rates are 0. Only the
    overall rate and three sums a level come to the driver.
    """
    named = materialize(hosts.select("host", registered_domain(F.col("host")).alias("domain"), public_suffix(F.col("host")).alias("suffix"), "n", "k"), "hosts")
    domains = materialize(named.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "domains")
    n, k = named.agg(F.sum("n"), F.sum("k")).first()
    suffixes = materialize(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "suffixes")
    above = small_side(_shrunk(suffixes.withColumn("m", F.lit(k / n if n else 0.0))).select("suffix", F.col("mean").alias("m")))
    domains = materialize(domains.join(above, "suffix"), "domains")
    above = small_side(_shrunk(domains).select("domain", F.col("mean").alias("m")))
    leaves = materialize(named.join(above, "domain"), "leaves")
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return _shrunk(leaves).select("host", "n", "k", "mean", (F.col("mean") - DEVIATIONS * sd).alias("bound"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], id_column: str = "page_id", url_column: str = "url",
               limit: float = LIMIT) -> DataFrame:
    """(id, host, path, rule, verdict, n_labelled, n_bad) for every row of ``pages``.

    ``outcomes`` has a url and whether its page was ``bad`` (boolean; null rows are left out), any number of rows a
    host. ``rules`` is a hand-written list: the longest fitting one decides, else the host's reputation, and
    ``allow`` where nothing speaks against it. Null urls and those without ``://`` have an empty host, judged like any
    other host name. Equal rows and ids give equal rows; other columns are not looked at. Outcomes are counted before
    the shuffle; a host of over a thousandth of all pages is joined by broadcast (there are at most a
    thousand), all others by a shuffle.
    """
    keyed = pages.select(pages[id_column].alias("id"), url_host(pages[url_column]).alias("host"), url_path(pages[url_column]).alias("path"))
    counted = keyed.groupBy("host").agg(F.count("*").alias("pages"))
    labelled = outcomes.filter("bad is not null").groupBy(url_host(F.col("url")).alias("host")).agg(
        F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("k"))
    hosts = materialize(counted.join(labelled, "host", "left").na.fill(0, ["n", "k"]), "host_counts")
    known = materialize(host_reputation(hosts).join(hosts.select("host", "pages"), "host"), "reputation")
    total = known.agg(F.sum("pages")).first()[0] or 0
    hot = known.filter(F.col("pages") * HOT_SHARE > total)
    fields = ("n", "k", "bound")
    hot = hot.select("host", *[F.col(c).alias(f"hot_{c}") for c in fields])
    page = keyed.join(F.broadcast(hot), "host", "left").withColumn(
        "key", F.when(F.col("hot_n").isNotNull(), F.concat(F.lit(" "), F.pmod(F.hash("path", "id"), F.lit(HOT_SHARE)))).otherwise(F.col("host")))
    page = page.join(known.select(F.col("host").alias("key"), *fields), "key", "left")
    n, k, bound = (F.coalesce(f"hot_{c}", c) for c in fields)
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    return page.select(
        F.col("id").alias(id_column), "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(bound > limit, F.lit("block")).otherwise("allow")).alias("verdict"), n.alias("n_labelled"), k.alias("n_bad"))
