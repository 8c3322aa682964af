"""Quality classifier: document evidence combined with posteriors of hosts and paths by hierarchical empirical Bayes.

The document classifier is a naive Bayes over binned measurements of the text; its tables come from all labelled documents, by one
aggregation, and have a fixed size. Its evidence gives each document a first probability of low quality. Grouped sums of these give
each host a rate that is shrunk towards the global rate, and each path of a host a rate that is shrunk towards its host's; how
strongly, follows from the variance between hosts and between paths (method of moments). A document's final probability joins its
evidence with the rate of its path, from which its own share has been taken. Sites with few documents thus follow the rates above
them.
"""

from __future__ import annotations

import logging
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import indices, once, staged

GAPS = r"[\x20\x09-\x0D]+"
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1e6

#: Measurements (of m, the counts of a text) and the edges of their bins.
FEATURES = {
    "symbols": (lambda m: m["symbols"] / m["words"], (0.005, 0.02, 0.05, 0.1, 0.3, 1.0)),
    "capitals": (lambda m: m["capitals"] / m["chars"], (0.005, 0.02, 0.05, 0.1, 0.3, 0.5)),
    "word_length": (lambda m: m["chars"] / m["words"], (2.5, 3.5, 4.25, 5.75, 7.0, 9.0, 12.0)),
    "stutter": (lambda m: m["stutter"] / m["words"], (0.005, 0.02, 0.1, 0.3, 0.6)),
    "exclamations": (lambda m: m["exclamations"] / m["words"], (0.005, 0.05, 0.3, 1.0)),
    "variety": (lambda m: m["distinct"] / m["words"], (0.1, 0.2, 0.35, 0.5, 0.65, 0.8)),
    "digits": (lambda m: m["digits"] / m["chars"], (0.01, 0.05, 0.2)),
}


def bins_of(text: Column) -> Column:
    """A struct of one bin number per feature; a null text is measured as an empty one."""
    def counts(p: Column) -> Column:
        words, count = p["words"], lambda pattern: F.regexp_count(p["text"], F.lit(pattern))
        return F.struct(
            F.greatest(F.size(words), F.lit(1)).alias("words"), F.greatest(F.char_length(F.array_join(words, "")), F.lit(1)).alias("chars"),
            count(r"[#*$%&|<>]").alias("symbols"), count(r"\p{Lu}").alias("capitals"), count("!").alias("exclamations"), count(r"\p{Nd}").alias("digits"),
            F.size(F.array_distinct(words)).alias("distinct"), F.size(F.filter(indices(1, F.size(words) - 1), lambda i: F.get(words, i) == F.get(words, i - 1))).alias("stutter"))

    def bins(m: Column) -> Column:
        number = lambda ratio, edges: once(ratio(m), lambda x: sum(((x >= edge).cast("int") for edge in edges), F.lit(0)))
        return F.struct(*(number(*feature).alias(name) for name, feature in FEATURES.items()))

    whole = F.coalesce(text, F.lit(""))
    return once(once(F.struct(whole.alias("text"), F.array_remove(F.split(whole, GAPS), "").alias("words")), counts), bins)


def fit_evidence(bins: DataFrame, labels: DataFrame, id_column: str, low: str) -> tuple[dict[str, list[float]], float]:
    """Log-likelihood ratios (low against good) per feature and bin, and the smoothed share of low documents.

    Every labelled document counts, once for each of its labels. Without labels of both kinds there is no evidence: all ratios are 0.
    """
    marks = labels.select(F.col(id_column), F.expr(low).alias("_low")).filter("_low IS NOT NULL")
    marked = bins.join(marks, id_column)
    cells = F.array(*(F.struct(F.lit(name).alias("feature"), F.col(f"bins.{name}").alias("bin")) for name in FEATURES))
    table = marked.select("_low", F.explode(cells).alias("cell")).groupBy("cell.feature", "cell.bin").agg(F.count_if("_low").alias("low"), F.count_if(~F.col("_low")).alias("good"))
    counts = {(r["feature"], r["bin"]): (r["low"], r["good"]) for r in table.collect()}  # features times bins rows
    first = next(iter(FEATURES))
    n_low, n_good = (sum(v[i] for (feature, _), v in counts.items() if feature == first) for i in (0, 1))
    if bool(n_low) != bool(n_good):
        logging.getLogger(__name__).warning("all %d labelled documents are of one quality: there is no evidence, and every document stays", n_low + n_good)
    ratios = {}
    for name, (_, edges) in FEATURES.items():
        size = len(edges) + 1
        pairs = [counts.get((name, b), (0, 0)) for b in range(size)]
        ratios[name] = [math.log((a + 0.5) / (n_low + 0.5 * size)) - math.log((b + 0.5) / (n_good + 0.5 * size)) if n_low and n_good else 0.0 for a, b in pairs]
    return ratios, (n_low + 1) / (n_low + n_good + 2)


def evidence(ratios: dict[str, list[float]], bins: Column) -> Column:
    return once(bins, lambda b: sum((F.get(F.lit(values), b[name]) for name, values in ratios.items()), F.lit(0.0)))


def _logit(p: Column) -> Column:
    safe = F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(1e-9))
    return F.log(safe / (1 - safe))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _strength(spread: float, groups: int, over: int, n: float, rate: float) -> float:
    """Prior strength, in documents: the spread between groups beyond what `groups` in `over` of equal rates would show by chance."""
    noise = rate * (1 - rate)
    between = spread - max(groups - over, 0) * noise / n
    return min(max(noise / between - 1, LEAST_STRENGTH), MOST_STRENGTH) if between > 0 and noise > 0 else MOST_STRENGTH


def site_rates(scored: DataFrame) -> tuple[DataFrame, float]:
    """Rates of hosts and paths from rows of host, path and p, and the prior strength that paths were shrunk with.

    Documents are summed per path before the shuffle and paths per host after it, so a large host is no large group.
    """
    paths = staged(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    total = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_s").alias("s"), F.count("*").alias("hosts"), F.sum(F.col("host_s") * F.col("host_s") / F.col("host_n")).alias("squares")).head()
    n = float(total["n"] or 1)
    rate = (total["s"] or 0.0) / n
    host_strength = _strength((total["squares"] or 0.0) / n - rate * rate, total["hosts"], 1, n, rate)
    hosts = hosts.withColumn("host_rate", (F.col("host_s") + host_strength * rate) / (F.col("host_n") + host_strength))
    joined = paths.join(hosts.withColumnRenamed("host", "_host"), F.col("host").eqNullSafe(F.col("_host")))
    inside = paths.agg(F.sum(F.col("s") * F.col("s") / F.col("n")).alias("squares"), F.count("*").alias("paths")).head()
    path_strength = _strength(((inside["squares"] or 0.0) - (total["squares"] or 0.0)) / n, inside["paths"], total["hosts"], n, rate)
    rates = joined.select("host", "path", "host_rate", "n", "s", ((F.col("s") + path_strength * F.col("host_rate")) / (F.col("n") + path_strength)).alias("path_rate"))
    return rates, path_strength


def classified(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source", path_column: str = "lang", low: str = "quality = 0",
               learn_from: DataFrame | None = None) -> DataFrame:
    """Return `row` (the whole input row), evidence, host_rate, path_rate and p_low for every row.

    `low` is a condition over the columns of `labels` that marks low quality. A path is a pair of host and path; a null host or path
    is one of its own. The document classifier learns from the labelled documents of `learn_from`, if given, else of `docs`; rates of sites are those of
    `docs`. With labels of one kind only there is nothing to learn, and a warning says so. A null text is measured as an empty one. Repeated rows are documents of their own; an empty table gives an
    empty one; clashing column names stay inside `row`.
    """
    names = docs.select(F.struct("*").alias("row"), F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(host_column).alias("host"), F.col(path_column).alias("path"))
    bins = staged(names.select("id", "host", "path", bins_of(F.col("text")).alias("bins")), "bins")
    marks = labels.withColumnRenamed(id_column, "id")
    known = bins
    if learn_from is not None:
        known = learn_from.select(F.col(id_column).alias("id"), bins_of(F.col(text_column)).alias("bins"))  # bins meet the labels, not texts
    ratios, share = fit_evidence(known, marks, "id", low)
    prior = math.log(share / (1 - share))
    first = _sigmoid(evidence(ratios, F.col("bins")) + prior)
    rates, strength = site_rates(bins.select("host", "path", first.alias("p")))
    rates = staged(rates, "rates").withColumnsRenamed({"host": "_host", "path": "_path"})
    scored = names.select("row", "host", "path", evidence(ratios, bins_of(F.col("text"))).alias("evidence"))
    joined = scored.join(rates, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")), "left")
    others = (F.col("s") - _sigmoid(F.col("evidence") + prior) + strength * F.col("host_rate")) / (F.col("n") - 1 + strength)
    return joined.select("row", "evidence", "host_rate", "path_rate", _sigmoid(F.col("evidence") + _logit(others)).alias("p_low"))


def quality_classifier(docs: DataFrame, labels: DataFrame, most: float = 0.8, id_column: str = "doc_id", **options) -> DataFrame:
    """Return id, evidence, host_rate, path_rate, p_low and kept (p_low is at most `most`) for every row; see `classified`."""
    rows = classified(docs, labels, id_column, **options)
    return rows.select(F.col(f"row.{id_column}").alias(id_column), "evidence", "host_rate", "path_rate", "p_low", (F.col("p_low") <= most).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, most: float = 0.8, **options) -> DataFrame:
    """The rows, with all their columns, whose probability of low quality is at most `most`."""
    good = F.coalesce("p_low", F.lit(0.0)) <= most  # of a value that cannot be null, so that no null check is made for it below the join
    return classified(docs, labels, **options).filter(good).select("row.*")
