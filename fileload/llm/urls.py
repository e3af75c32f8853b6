"""URL filters: rules first, then the reputation of the host, by empirical Bayes.

Labelled pages of a host are counted as bad or good.  A host's rate of bad pages has
a beta prior from its registered domain, that one from its suffix, and that from all
pages; the strength of each prior is estimated from how much the rates below it vary
beyond chance (beta-binomial moments).  A host is blocked if the lower bound of its
posterior rate is above a threshold.

Cases: a null url, or one without ``://``, has an empty host and path; hosts without
labels have the rate of the levels above, an empty table of labels blocks nothing;
equal urls get equal verdicts; the longest rule wins, of two as long a block; input
columns named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fileload.llm.text import col, without
from fileload.session import stage_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Second-level names that registries hand out below.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")

#: Standard deviations below the mean, and the rate of bad pages that blocks a host.
BOUND, BLOCK_RATE = 1.645, 0.5
STRENGTH = (1.0, 1000.0)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.when(has, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def domain_of(host: Column) -> Column:
    """The registered domain: two labels, three below a second-level registry."""
    labels = F.split(host, r"\.", -1)
    registry = (F.size(labels) > 2) & F.get(labels, F.size(labels) - 2).isin(*SECOND_LEVEL) & (F.length(F.get(labels, F.size(labels) - 1)) == 2)
    return F.when(registry, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def suffix_of(domain: Column) -> Column:
    """What a registered domain stands below."""
    dot = F.instr(domain, ".")
    return F.when(dot > 0, F.substr(domain, dot + 1)).otherwise(domain)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule (host and path joined) and verdict of the longest rule that fits, or nulls.
    ``rules`` are (allow or block, host, path), a list written by hand."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block")):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def _strength(children: DataFrame) -> float:
    """Of the beta prior with mean ``m`` for children with ``bad`` of ``n`` pages."""
    spread = F.pow(F.col("bad") - F.col("n") * F.col("m"), 2) / (F.col("n") * F.col("m") * (1 - F.col("m")))
    k, n, total = children.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(spread), F.lit(0.0))).first()
    if n <= k:
        return STRENGTH[0]
    low, high = 1 / (STRENGTH[1] + 1), 1 / (STRENGTH[0] + 1)
    within = min(max((total - k) / (n - k), low), high)
    return 1 / within - 1


def host_reputation(outcomes: DataFrame, bound: float = BOUND) -> DataFrame:
    """``host, n, bad, rate, low`` from rows of ``host`` and ``bad`` (1, 0 or null).

    Pages are counted by host before anything is shuffled; the levels above are made
    from those counts, and only three strengths come to the driver.
    """
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    hosts = stage_table(hosts.withColumn("domain", domain_of(F.col("host"))), "hosts")
    domains = stage_table(
        hosts.groupBy("domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("suffix", suffix_of(F.col("domain"))),
        "domains",
    )
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    n, bad = domains.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()

    def shrunk(level: DataFrame, s: float) -> Column:
        return (F.col("bad") + s * F.col("m")) / (F.col("n") + s)

    suffixes = suffixes.withColumn("m", F.lit((bad + 1) / (n + 2)))
    means = suffixes.select("suffix", shrunk(suffixes, _strength(suffixes)).alias("m"))
    domains = domains.join(means, "suffix")
    means = domains.select("domain", shrunk(domains, _strength(domains)).alias("m"))
    hosts = hosts.join(means, "domain")
    s = _strength(hosts)
    a, b = F.col("bad") + s * F.col("m"), F.col("n") - F.col("bad") + s * (1 - F.col("m"))
    rate = a / (a + b)
    low = rate - bound * F.sqrt(rate * (1 - rate) / (a + b + 1))
    return hosts.select("host", "n", "bad", rate.alias("rate"), low.alias("low"))


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    bad: Column | None = None,
    *,
    url_col: str = "url",
    bound: float = BOUND,
    block_rate: float = BLOCK_RATE,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``bad`` labels pages (1, 0 or null); by default those that a rule judges are
    labelled by it.  A hot host is one row of reputation and a skewed join key.
    """
    host, path = host_and_path(col(url_col).cast("string"))
    labelled = pages.withColumns({"__host": host, "__path": path, "__bad": F.lit(None).cast("int") if bad is None else bad.cast("int")})
    rule, verdict = rule_of(F.col("__host"), F.col("__path"), rules)
    by_rule = F.when(F.col("__verdict") == "block", 1).when(F.col("__verdict") == "allow", 0)
    rows = labelled.withColumns({"__rule": rule, "__verdict": verdict})
    rows = rows.withColumn("__bad", by_rule if bad is None else F.col("__bad"))
    known = host_reputation(rows.select(F.col("__host").alias("host"), F.col("__bad").alias("bad")), bound)
    known = known.select(F.col("host").alias("__host"), F.when(F.col("low") > block_rate, "block").otherwise("allow").alias("__own"))
    found = rows.join(known, "__host", "left")
    keep = without(pages.columns, ["host", "path", "rule", "verdict"])
    return found.select(
        *(col(c) for c in keep),
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("__rule").alias("rule"),
        F.coalesce("__verdict", "__own").alias("verdict"),
    )
