"""URL rules applied by a sort-merge range join over reversed-host canonical keys.

A rule (host, path) fits its host, all subdomains, and the paths that start with its
own. Hosts are written with their labels reversed, and a URL has one key for its host
and one for each domain above it, so that a rule is an interval of keys: those that
start with the rule's key. Intervals are nested or apart. A sweep over the sorted keys
therefore keeps the open rules on a stack, and the top of the stack is the longest
rule that fits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermart.llm.common import free_name, written

ALLOW, BLOCK = "allow", "block"
#: The verdict where no rule fits.
DEFAULT = ALLOW
#: A domain with more keys than this is dealt over several tasks, each of which gets its rules.
KEYS_PER_TASK = 2_000


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """What follows the first :// up to /, ?, # or the end; empty where there is none or the URL is null."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def domains(host: Column) -> Column:
    """Reversed keys of the host and all domains above it: com, com.example, com.example.www."""
    labels = F.reverse(F.split(host, r"\.", -1))
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, 1, n), "."))


def longest_rules(urls: DataFrame, rules: DataFrame, keys_per_task: int = KEYS_PER_TASK) -> DataFrame:
    """(host, path, rule, verdict) for the distinct (host, path) of ``urls`` that some rule fits.

    ``rules`` has host, path and verdict (text, no nulls). The longest rule text wins,
    of equally long ones the longer host; of equal rules ``block`` wins.
    """
    rules = rules.select(lower_ascii(F.col("host")).alias("host"), "path", "verdict").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    named = rules.select(reversed_host(F.col("host")).alias("domain"), "path", F.concat("host", "path").alias("rule"), "verdict")
    keys = urls.select("host", "path").distinct().withColumn("domain", F.explode(domains(F.col("host"))))
    # a rule's domain has few keys or is dealt out; the keys of domains without rules go
    sizes = keys.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).join(named.select("domain").distinct(), "domain", "left_semi")
    parts = written(sizes.select("domain", F.ceil(F.col("n") / keys_per_task).cast("long").alias("parts")), "url-domains")
    of_urls = keys.join(parts, "domain").select(
        "domain", "path", F.lit(1).alias("kind"), F.pmod(F.xxhash64("host", "path"), "parts").alias("part"), "host", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")
    )
    of_rules = named.join(parts, "domain").select(
        "domain", "path", F.lit(0).alias("kind"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(None).cast("string").alias("host"), "rule", "verdict"
    )
    sorted_keys = of_rules.unionByName(of_urls).repartition("domain", "part").sortWithinPartitions("domain", "part", "path", "kind")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, stack = None, []  # of open rules' (path, rule, verdict)
        for batch in batches:
            out: dict[str, list] = {"host": [], "path": [], "rule": [], "verdict": []}
            for row in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)]):
                domain, path, kind, part, host, rule, verdict = row
                if (domain, part) != at:
                    at, stack = (domain, part), []
                while stack and not path.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    stack.append((path, rule, verdict))
                elif stack:
                    for name, x in zip(out, (host, path, stack[-1][1], stack[-1][2])):
                        out[name].append(x)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(n, pa.string()) for n in out]))

    fits = sorted_keys.mapInArrow(sweep, "host string, path string, rule string, verdict string")
    # along one host's domains the rules are nested by host; a longer path may still win over a longer host
    rank = F.struct(F.length("rule"), F.length(F.substring_index("rule", "/", 1)), "rule", "verdict")
    best = fits.groupBy("host", "path").agg(F.max(rank).alias("best"))
    return best.select("host", "path", "best.rule", "best.verdict")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT, keys_per_task: int = KEYS_PER_TASK) -> DataFrame:
    """``pages`` with host, path, rule and verdict; columns of these names are replaced.

    Null URLs and those without :// have an empty host and path, and no rule. Rows that
    repeat stay; each distinct (host, path) is judged once. Without rules or pages the
    result is the default verdict, or no rows.
    """
    parsed = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host_of(pages[url]), "path": path_of(pages[url])})
    fits = longest_rules(parsed.filter("host <> ''"), rules, keys_per_task)
    return parsed.join(fits, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def keep_allowed(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """The rows of ``pages`` whose verdict is allow, columns unchanged."""
    link = free_name(pages, "judged_url")
    bad = judge(pages.select(F.col(url).alias(link)).distinct(), rules, link, default).filter(F.col("verdict") == BLOCK)
    return pages.join(bad.select(link), pages[url].eqNullSafe(F.col(link)), "left_anti")
