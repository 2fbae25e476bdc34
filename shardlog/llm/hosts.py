"""URL filter: written rules first, and the reputation of the host elsewhere.

Labelled outcomes of pages are shrunk by beta-binomial priors from the suffix to the
registered domain to the host. A host is blocked when the lower bound of its posterior
share of bad pages is above a limit. DataFrame functions only.

Suffixes are those of a public list, with its wildcards and exceptions: a file in the
list's format, by default the copy that Spark's own HTTP client brings along.
"""

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlog.workdir import materialised

LIMIT = 0.5  # share of bad pages
DEVIATIONS = 1.645  # of the posterior, from its mean down to the bound
LIST = "mozilla/public-suffix-list.txt"  # on the class path
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def plain(host: Column) -> Column:
    """The name of a host without user, port and closing dots."""
    name = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    return F.rtrim(name, F.lit("."))


def is_number(name: Column) -> Column:
    """Addresses have no registered domain above them."""
    return name.rlike(r"^\[.*\]$|^[0-9]+(\.[0-9]+)*$")


def suffix_rules(spark: SparkSession, path: str | None = None) -> DataFrame:
    """``(name, more)`` of a list of public suffixes: the rule's name, and the labels that the suffix has beyond it.

    A wildcard has one more than its name, an exception one less; a suffix in letters of
    another script also counts as it is written in ASCII. The list has some thousand lines.
    """
    if path is not None:
        lines = [r.value for r in spark.read.text(path).collect()]
    else:
        found = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader().getResourceAsStream(LIST)
        if found is None:
            raise ValueError("this Spark brings no list of public suffixes: pass the path of one")
        lines = bytes(found.readAllBytes()).decode().split("\n")
    rules = set()
    for line in lines:
        rule = line.split()[0].lower() if line.strip() and not line.startswith("//") else ""
        more = -1 if rule.startswith("!") else 1 if rule.startswith("*.") else 0
        name = rule.removeprefix("!").removeprefix("*.")
        if not name or "*" in name:
            continue
        rules.add((name, more))
        try:
            rules.add((name.encode("idna").decode(), more))
        except UnicodeError:  # a name that has no form in ASCII
            pass
    return spark.createDataFrame(sorted(rules), "name string, more int").coalesce(1)


def placed(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``hosts``, one row a ``host``, with its registered ``domain`` and its ``suffix``.

    An exception counts before the longest of the other rules that fit; where none does, the
    suffix is the last label. A host that is a suffix itself, or a number, is its own
    domain; numbers have the suffix ``number``. Of a long name only as many labels are
    compared as the longest rule has.
    """
    rules = materialised(rules, "suffixes")
    longest = (rules.agg(F.max(F.size(F.split("name", r"\.")))).first()[0] or 1) + 1
    labels, size = F.split("host", r"\."), F.size("_l")
    named = hosts.select("host", labels.alias("_l"))
    tails = F.transform(
        F.sequence(F.lit(1), F.least(size, F.lit(longest))),
        lambda n: F.struct(n.alias("n"), F.array_join(F.slice("_l", -n, n), ".").alias("name")),
    )
    tried = named.select("host", size.alias("_size"), F.explode(tails).alias("t")).select("host", "_size", "t.n", "t.name")
    fits = tried.join(F.broadcast(rules), "name").select("host", "more", (F.col("n") + F.col("more")).alias("n"), "_size")
    of = fits.where("n <= _size").groupBy("host").agg(F.max(F.when(F.col("more") < 0, F.col("n"))).alias("_but"), F.max("n").alias("_n"))
    length = F.coalesce("_but", "_n", F.lit(1))
    number = is_number(F.col("host"))
    joined = hosts.join(of, "host", "left").withColumn("_length", length)
    domain = F.when(number, F.col("host")).otherwise(F.expr("substring_index(host, '.', -(_length + 1))"))
    suffix = F.when(number, "number").otherwise(F.expr("substring_index(host, '.', -_length)"))
    return joined.withColumns({"domain": domain, "suffix": suffix}).drop("_but", "_n", "_length")


def rule_for(rules: list[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does.

    A rule ``("block", "example.org/es/")`` fits its host and subdomains where the path
    starts with the rule's. Of equally long ones the first in order of text wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, pattern in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        of, _, start = pattern.partition("/")
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(f"/{start}")
        rule, verdict = F.when(fits, pattern).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _shrunk(level: DataFrame, mean: str) -> DataFrame:
    """``level`` (n, x and the parent's ``mean``) with ``a`` and ``b`` of its beta posterior.

    One concentration a level, from moments: how far the outcomes of its members scatter
    around their parents beyond what chance gives.
    """
    p = F.col(mean)
    beyond = F.sum(F.pow(F.col("x") - F.col("n") * p, 2) - F.col("n") * p * (1 - p))
    possible = F.sum(F.col("n") * (F.col("n") - 1) * p * (1 - p))
    beyond, possible = level.agg(beyond, possible).first()
    like = min(0.999, max(0.001, beyond / possible)) if possible else 0.001
    strength = 1 / like - 1
    a = F.col("x") + strength * p
    b = F.col("n") - F.col("x") + strength * (1 - p)
    return level.select("*", a.alias("a"), b.alias("b"))


def reputations(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, a, b)``, the beta posterior of each host's share of bad pages.

    ``hosts`` has a row a host: ``n`` labelled pages, ``x`` bad ones. Hosts without labelled
    pages take their domain's posterior mean as prior, domains their suffix's, suffixes the
    overall mean, which is one half where nothing is labelled. ``rules`` are those of
    ``suffix_rules``.
    """
    hosts = materialised(placed(materialised(hosts, "hosts"), rules), "hosts")
    sums = lambda df, *keys: df.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    domains = materialised(sums(hosts, "domain", "suffix"), "domains")
    suffixes = materialised(sums(domains, "suffix"), "suffixes")
    n, x = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("x"), F.lit(0))).first()
    mean = lambda df, key, name: df.select(key, (F.col("a") / (F.col("a") + F.col("b"))).alias(name))
    suffixes = _shrunk(suffixes.withColumn("overall", F.lit((x + 1) / (n + 2))), "overall")
    domains = materialised(domains.join(mean(suffixes, "suffix", "of_suffix"), "suffix"), "domains")
    domains = _shrunk(domains, "of_suffix")
    hosts = materialised(hosts.join(mean(domains, "domain", "of_domain"), "domain"), "hosts")
    return _shrunk(hosts, "of_domain").select("host", "a", "b")


def lower_bound(a: Column, b: Column) -> Column:
    mean = a / (a + b)
    return mean - DEVIATIONS * F.sqrt(mean * (1 - mean) / (a + b + 1))


def shown_document(path: Column) -> Column:
    """The number of the document that a page shows: the last one in its path, null without one."""
    return F.try_to_number(F.nullif(F.regexp_extract(path, "([0-9]{1,18})[^0-9]*$", 1), F.lit("")), F.lit("9" * 18)).cast("long")


def outcomes_of(pages: DataFrame, labels: DataFrame, url: str = "url", key: str = "page_id") -> DataFrame:
    """``(page_id, bad)`` from the labels of the documents that pages show; bad are poor and toxic ones.

    ``labels`` has ``(doc_id, quality, toxic)``. A page that is there twice counts once for
    each label of its document.
    """
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    shows = pages.select(pages[key].alias("page_id"), shown_document(path_of(pages[url])).alias("doc_id")).distinct()
    return shows.join(labels.select("doc_id", bad.alias("bad")), "doc_id").select("page_id", "bad")


def judged(
    pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]], url: str = "url", key: str = "page_id", suffixes: str | None = None
) -> DataFrame:
    """One row a page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``bad_share``, ``bound``.

    ``outcomes`` has ``(page_id, bad)`` of labelled pages; null ids and outcomes are left
    out, a page labelled twice counts twice. A null or odd url has an empty host and path
    and is judged like any other host. User, port and closing dots of a host are returned,
    but its reputation is that of the plain name. Repeated rows are judged each.
    ``suffixes`` is the path of a list of public suffixes.
    """
    rows = pages.select(pages[key].alias("page_id"), host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path"))
    rows = rows.withColumn("name", plain(F.col("host")))
    found = outcomes.where("bad is not null and page_id is not null").groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("x")
    )
    per_host = rows.select("page_id", F.col("name").alias("host")).join(found, "page_id", "left").groupBy("host").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("x"), F.lit(0)).alias("x")
    )
    known = reputations(per_host, suffix_rules(pages.sparkSession, suffixes)).withColumnRenamed("host", "name")
    rule, said = rule_for(rules, F.col("host"), F.col("path"))
    bound = lower_bound(F.col("a"), F.col("b"))
    return rows.join(known, "name").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(said, F.when(bound > LIMIT, "block").otherwise("allow")).alias("verdict"),
        (F.col("a") / (F.col("a") + F.col("b"))).alias("bad_share"), bound.alias("bound"),
    )
