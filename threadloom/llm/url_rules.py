"""URL rules by a sorted sweep.  A rule is the interval of canonical keys
(reversed host labels, end mark, path) that begin with its own key; such
intervals nest or are disjoint.  A url has one key for itself and one for each
parent host, so that subdomains meet rules of their parents.  Rules and url
keys are sorted together in ranges, and each url key looks at the stack of nested
rules open at its place.  DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadloom.llm.store import Scratch

#: The rules of the contract (host, path, verdict).
CONTRACT_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
RULE_SCHEMA = "host string, path string, verdict string"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Ends a host in a canonical key; sorts below every character of a host label.
_END = "\u0001"
_STACK = "array<struct<size:int,key:string,rule:string,verdict:string>>"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): the host after the first "://" up to "/", "?", "#" or the
    end, A-Z lower-cased; the path then up to "?", "#" or the end."""
    there = F.instr(url, "://") > 0
    rest = F.regexp_replace(url, r"(?s)^.*?://", "")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(there, host).otherwise(F.lit("")), F.when(there, path).otherwise(F.lit(""))


def host_key(labels: Column) -> Column:
    return F.array_join(F.reverse(labels), "\u0002")


def canonical_rules(rules: DataFrame) -> DataFrame:
    """One row per distinct rule: its key, the number of host labels, and the
    stack of rules it lies in, itself last."""
    host = F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER)
    path = F.coalesce("path", F.lit(""))
    labels = F.split(host, r"\.", -1)
    own = (rules.where(F.col("verdict").isNotNull())
           .select(host.alias("h"), path.alias("p"), "verdict", labels.alias("labels"))
           .withColumn("key", F.concat(host_key(F.col("labels")), F.lit(_END), "p"))
           .groupBy("key").agg(F.max("verdict").alias("verdict"),  # block over allow
                               F.first(F.concat("h", "p")).alias("rule"), F.max(F.size("labels")).alias("depth")))
    inner = own.select(F.col("key").alias("inner"), F.explode(
        F.transform(F.sequence(F.lit(1), F.length("key")), lambda n: F.substring("key", F.lit(1), n))).alias("key"))
    return (inner.join(own, "key")
            .groupBy(F.col("inner").alias("key"))
            .agg(F.sort_array(F.collect_list(F.struct(F.length("key").alias("size"), "key", "rule", "verdict")))
                 .alias("stack"), F.max(F.when(F.col("key") == F.col("inner"), F.col("depth"))).alias("depth")))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow",
               keep: tuple[str, ...] = ("page_id",), sweeps: int | None = None, scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``pages``: the ``keep`` columns, host, path, rule, verdict.

    A rule fits its host and all subdomains if the path starts with the rule's;
    the longest fitting rule (characters of host and path) wins, and its verdict
    is the url's.  Without one, rule is null and the verdict is ``default``
    (allow).  A url that is null, empty or without "://" has an empty host and
    path and no rule; urls of any length are taken whole.  Of rules with the same host and path block wins; an empty
    rule table gives ``default`` throughout, an empty page table no rows.
    Repeated rows each keep their row.  Columns of ``pages`` other than ``keep`` and the url take
    no part, whatever their names.

    A url has one canonical key per number of host labels that some rule has.
    Rules and url keys are dealt by ranges of (key, row) to ``sweeps`` sorted
    sweeps, so that each rule is in one sweep and a host, or one url, holding
    most rows is cut into several.  The stack open at the end of a sweep is
    carried to those behind it: one row a sweep.
    """
    spark = pages.sparkSession
    scratch = scratch or Scratch(spark, "url-rules")
    sweeps = sweeps or int(spark.conf.get("spark.sql.shuffle.partitions"))
    stacks = scratch.keep(canonical_rules(rules), "rules")
    deepest = stacks.agg(F.max("depth")).first()[0] or 0  # one number

    host, path = split_url(F.col(url))
    rows = (pages.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], host.alias("host"), path.alias("path"))
            .withColumn("rid", F.monotonically_increasing_id()))
    labels = F.split("host", r"\.", -1)
    tails = F.filter(F.sequence(F.lit(1), F.lit(max(1, deepest))), lambda d: d <= F.size(labels))
    keys = F.transform(tails, lambda d: F.concat(
        host_key(F.slice(labels, F.size(labels) - d + 1, d)), F.lit(_END), F.col("path")))
    queries = rows.withColumns({"key": F.explode(keys), "stack": F.lit(None).cast(_STACK)})
    # a rule has no row id and so stands before the url keys equal to it
    laid = queries.unionByName(stacks.select("key", "stack"), allowMissingColumns=True)
    laid = scratch.keep(laid.repartitionByRange(sweeps, "key", "rid").withColumn("sweep", F.spark_partition_id()), "laid")
    ends = laid.groupBy("sweep").agg(F.max_by("stack", F.when(F.col("stack").isNotNull(), F.col("key"))).alias("end"))
    behind = Window.orderBy("sweep").rowsBetween(Window.unboundedPreceding, -1)  # over one row a sweep
    carried = ends.select("sweep", F.last("end", ignorenulls=True).over(behind).alias("carried"))
    so_far = (Window.partitionBy("sweep").orderBy("key", F.col("rid").asc_nulls_first())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    opened = (laid.withColumn("opened", F.last("stack", ignorenulls=True).over(so_far)).where("rid IS NOT NULL")
              .join(carried, "sweep"))
    stack = F.coalesce("opened", "carried", F.array().cast(_STACK))
    fitting = F.filter(stack, lambda r: F.col("key").startswith(r["key"]))
    best = F.try_element_at(fitting, F.lit(-1))
    found = opened.withColumn("best", F.when(F.size(fitting) > 0, F.struct(
        F.length(best["rule"]).alias("size"), best["rule"].alias("rule"), best["verdict"].alias("verdict"))))
    kept = [f"_k{i}" for i in range(len(keep))]
    return (found.groupBy("rid").agg(*[F.first(c).alias(c) for c in (*kept, "host", "path")], F.max("best").alias("best"))
            .select(*[F.col(k).alias(c) for k, c in zip(kept, keep, strict=True)], "host", "path",
                    F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


def rule_table(spark: SparkSession, rules=CONTRACT_RULES) -> DataFrame:
    """A short list of rules as a table of literals."""
    names = [c.split()[0] for c in RULE_SCHEMA.split(", ")]
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r, strict=True)]) for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))
