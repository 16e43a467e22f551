"""URL filter: host and path rules, and boosted trees on lexical features for the rest.

Rules are a short list that travels with the plan.  Of the rules that fit an url
the longest decides; an url without one is judged by gradient-boosted trees.
Their features are lexical (lengths, depth, digit ratio, character entropy,
parameters, punctuation) and statistics of the host's suffix (its last two
labels): how many urls of the whole table have it, and the share of blocked urls
among the labelled ones, also of the whole table.  Everything runs in DataFrame
and ML operators; the suffix statistics are aggregated before they are joined.

The trees are fitted on labelled urls, here those that a rule decides.  Only the
fit uses a sample: labelled rows whose hash falls below a threshold that lets
about ``SAMPLE`` rows through, ``2 * SAMPLE`` at most.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits
no rule and is judged by its features (a null one counts as empty); repeated rows
each give a row; without labelled urls of both kinds the verdict is that of the
one kind, allow without any; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import pick
from tillroll.session import materialize

SAMPLE = 20_000
MAX_RULES = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host, its subdomains and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def rules(*lines: str) -> list[Rule]:
    """Rules from lines such as ``block example.org/es/``."""
    out = []
    for line in lines:
        verdict, place = line.split(" ", 1)
        host, slash, path = place.partition("/")
        out.append(Rule(verdict, host, slash + path))
    if len(out) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules can travel with a plan")
    return sorted(out, key=lambda r: (-len(r.name), r.name))


def parts(urls: DataFrame) -> DataFrame:
    """Adds host and path to a table with a column url."""
    return urls.select("*", F.translate(F.coalesce(F.regexp_extract("url", URL, 1), F.lit("")), UPPER, LOWER).alias("host"),
                       F.coalesce(F.regexp_extract("url", URL, 2), F.lit("")).alias("path"))


def _count(text: Column, what: str) -> Column:
    """Characters of ``text`` among those of ``what``."""
    return F.length(text) - F.length(F.translate(text, what, ""))


def _entropy(text: Column) -> Column:
    n = F.length(text)
    shares = F.transform(F.array_distinct(F.split(text, "")), lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n)
    return F.when(n > 0, F.aggregate(shares, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))).otherwise(0.0)


def _features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    asked = F.when(F.instr(url, "?") > 0, F.substring_index(F.substring_index(url, "#", 1), "?", -1)).otherwise("")
    return {
        "length": F.length(url), "host_length": F.length(host), "path_length": F.length(path),
        "depth": _count(path, "/"), "labels": _count(host, "."), "hyphens": _count(url, "-"),
        "digit_ratio": _count(url, "0123456789") / F.greatest(F.length(url), F.lit(1)),
        "host_digits": _count(host, "0123456789"), "escapes": _count(url, "%"), "entropy": _entropy(url),
        "host_entropy": _entropy(host), "secure": url.startswith("https:").cast("int"),
        "parameters": F.when(F.length(asked) > 0, _count(asked, "&") + 1).otherwise(0), "query_length": F.length(asked),
        "fragment": F.instr(url, "#") > 0}


def _suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def _vectors(urls: DataFrame, suffixes: DataFrame) -> DataFrame:
    """``urls`` (url, host, path and others) with a column features."""
    url = F.coalesce("url", F.lit(""))
    own = _features(url, F.col("host"), F.col("path"))
    rows = (urls.withColumns({f"f_{k}": c.cast("double") for k, c in own.items()}).withColumn("suffix", _suffix(F.col("host")))
            .join(suffixes, "suffix"))
    return VectorAssembler(inputCols=[f"f_{k}" for k in own] + ["f_suffix_urls", "f_suffix_blocked"],
                           outputCol="features").transform(rows)


def judge(pages: DataFrame, chosen: list[Rule], labelled: DataFrame | None = None, sample: int = SAMPLE,
          trees: int = 20, depth: int = 4, seed: int = 7) -> DataFrame:
    """page_id, host, path, rule, verdict and blocked (the trees' probability; null where a rule decides).

    ``labelled``: url and blocked (0 or 1); by default the urls that a rule decides.
    """
    urls = parts(pick(pages, "page_id", "url"))
    host, path = F.col("host"), F.col("path")
    fits = [(r, r.fits(host, path)) for r in chosen]  # longest first
    urls = urls.select("*", F.coalesce(*[F.when(c, r.name) for r, c in fits], F.lit(None).cast("string")).alias("rule"),
                       F.coalesce(*[F.when(c, r.verdict) for r, c in fits], F.lit(None).cast("string")).alias("ruled"))
    known = (parts(pick(labelled, "url", "blocked")) if labelled is not None else
             urls.filter("ruled IS NOT NULL").withColumn("blocked", (F.col("ruled") == "block").cast("int")))
    known = known.filter(F.col("blocked").isin(0, 1)).select(
        "url", "host", "path", "blocked", *([F.col("page_id").alias("salt")] if labelled is None else [F.lit(0).alias("salt")]))
    taught = materialize(known.groupBy(_suffix(host).alias("suffix")).agg(F.sum("blocked").alias("b"), F.count("*").alias("n")), "taught")
    b, n = taught.agg(F.sum("b"), F.sum("n")).first()
    share = int(min(1.0, sample / max(n or 0, 1)) * (1 << 31))
    fitted_on = materialize(known.filter(F.pmod(F.xxhash64("url", "salt"), F.lit(1 << 31)) <= share).limit(2 * sample), "labelled_urls")
    kinds = {r[0] for r in fitted_on.select("blocked").distinct().collect()}
    if len(kinds) < 2:
        return urls.select("page_id", "host", "path", "rule",
                           F.coalesce("ruled", F.lit("block" if kinds == {1} else "allow")).alias("verdict"),
                           F.lit(None).cast("double").alias("blocked"))

    rate = b / n
    seen = urls.groupBy(_suffix(host).alias("suffix")).agg(F.count("*").alias("urls"))
    suffixes = materialize(seen.join(taught, "suffix", "full").select(
        "suffix", F.log1p(F.coalesce("urls", F.lit(0)).cast("double")).alias("f_suffix_urls"),
        ((F.coalesce("b", F.lit(0)) + 5 * rate) / (F.coalesce("n", F.lit(0)) + 5)).alias("f_suffix_blocked")), "suffixes")
    training = _vectors(fitted_on, suffixes).select("features", F.col("blocked").cast("double").alias("label"))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, checkpointInterval=-1).fit(training)
    from pyspark.ml.functions import vector_to_array
    scored = model.transform(_vectors(urls, suffixes)).withColumn("p", vector_to_array("probability")[1])
    ruled = F.col("ruled").isNotNull()
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("ruled", F.when(F.col("p") >= 0.5, "block").otherwise("allow")).alias("verdict"),
                         F.when(~ruled, F.col("p")).alias("blocked"))
