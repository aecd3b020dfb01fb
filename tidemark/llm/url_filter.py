"""URL filters: given rules first, gradient-boosted trees on lexical features for what no rule fits.

A rule names a host and a path prefix; it fits the host and all its subdomains where the path starts with the prefix,
and the longest fitting rule decides. URLs that a rule decides are the labelled ones: the trees learn from them, and
give the verdict on the rest. Features are lengths, depth, digit share, entropy, parameter counts and the smoothed share
of blocked URLs among labelled ones of the same host suffix.

* A null URL, or one without `://`, has an empty host and path; no rule fits it and the trees judge it.
* With labels of one kind only, that kind is the verdict on the rest; without any, the rest is allowed.
* Training takes at most about `train_rows` labelled rows, chosen by a hash of the URL; suffix counts use all rows.
* Repeated rows are judged alike; further columns are ignored.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored


@dataclass(frozen=True)
class Rule:
    verdict: str
    name: str

    @property
    def host(self) -> str:
        return self.name.split("/", 1)[0]

    @property
    def path(self) -> str:
        return self.name[len(self.host):]


RULES = [Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/")]

TRAIN_ROWS = 50_000
TREES = 16
DEPTH = 4
SEED = 11
#: Weight, in rows, of the overall share in a suffix's share.
SMOOTHING = 20.0
FEATURES = ["_length", "_host_length", "_path_length", "_depth", "_labels", "_hyphens", "_digits", "_entropy", "_parameters", "_suffix_share"]


def ascii_lower(value: Column) -> Column:
    return F.translate(value, string.ascii_uppercase, string.ascii_lowercase)


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without `://`."""
    url = F.coalesce(url, F.lit(""))
    pick = lambda group: F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)([^?#]*)", group)
    return ascii_lower(pick(1)), pick(2)


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the last one set is the longest
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def entropy(text: Column) -> Column:
    """Bits per character."""
    length = F.length(text)
    letters = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    bits = F.aggregate(letters, F.lit(0.0), lambda total, c: total - _plogp((length - F.length(F.replace(text, c, F.lit("")))) / length))
    return F.when(length > 0, bits).otherwise(0.0)


def _plogp(p: Column) -> Column:
    return p * F.log2(p)


def _count(text: Column, mark: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))).cast("double")


def judged_by_rules(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, url, host, path, rule, ruled (verdict of the rule)."""
    host, path = parts(F.col("url"))
    split = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    name, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    return split.withColumns({"rule": name, "ruled": verdict})


def lexical(rows: DataFrame) -> DataFrame:
    """The feature columns that need the URL alone, and its host suffix."""
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    digits = F.length(url) - F.length(F.translate(url, string.digits, ""))
    return rows.withColumns({
        "_length": F.length(url).cast("double"), "_host_length": F.length("host").cast("double"), "_path_length": F.length("path").cast("double"),
        "_depth": _count(F.col("path"), "/"), "_labels": _count(F.col("host"), "."), "_hyphens": _count(F.col("host"), "-"),
        "_digits": F.when(F.length(url) > 0, digits / F.length(url)).otherwise(0.0), "_entropy": entropy(url),
        "_parameters": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1.0),
        "_suffix": F.substring_index("host", ".", -1)})


def suffix_shares(rows: DataFrame) -> DataFrame:
    """(_suffix, _suffix_share): smoothed share of blocked URLs among the labelled ones of a suffix."""
    blocked = (F.col("ruled") == "block").cast("double")
    counts = rows.where("ruled is not null").groupBy("_suffix").agg(F.sum(blocked).alias("b"), F.count("*").alias("n"))
    overall = counts.agg((F.sum("b") / F.sum("n")).alias("p"))
    return counts.join(overall, F.lit(True)).select("_suffix", ((F.col("b") + SMOOTHING * F.col("p")) / (F.col("n") + SMOOTHING)).alias("_suffix_share"))


def with_features(rows: DataFrame) -> DataFrame:
    """Rows with all features; a suffix never seen in a labelled URL has a share of one half."""
    found = lexical(rows)
    return found.join(suffix_shares(found), "_suffix", "left").withColumn("_suffix_share", F.coalesce("_suffix_share", F.lit(0.5)))


def trained(rows: DataFrame, train_rows: int = TRAIN_ROWS):
    """The trees, or the only verdict there is."""
    labelled = rows.where("ruled is not null")
    n, blocked = labelled.agg(F.count("*"), F.sum((F.col("ruled") == "block").cast("long"))).first()
    if not n or blocked in (0, n):
        return "block" if n and blocked else "allow"
    parts_of = 1_000_000
    chosen = labelled.where(F.pmod(F.xxhash64("url"), F.lit(parts_of)) < min(parts_of, parts_of * train_rows // n))
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(
        chosen.withColumn("_label", (F.col("ruled") == "block").cast("double"))).select("_features", "_label")
    return GBTClassifier(featuresCol="_features", labelCol="_label", maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(assembled)


def url_verdicts(pages: DataFrame, rules: list[Rule] = RULES, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    rows = stored(with_features(judged_by_rules(pages.select("page_id", "url"), rules)), "url-features")
    model = trained(rows, train_rows)
    if isinstance(model, str):
        learned = rows.withColumn("_learned", F.lit(model))
    else:
        assembled = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(rows)
        learned = model.transform(assembled).withColumn("_learned", F.when(F.col("prediction") == 1.0, "block").otherwise("allow"))
    return learned.select("page_id", "host", "path", "rule", F.coalesce("ruled", "_learned").alias("verdict"))
