"""Quality classification of documents by hierarchical empirical Bayes.

What a document's own text says is a log-likelihood ratio: binned measures of the text (signs, capitals, word length,
words that repeat the one before), each with the ratio of its share among good and bad labelled documents. What its surroundings say is a
prior: the rate of good documents of its path, shrunk towards the rate of its host, itself shrunk towards the rate of
all documents. The strength of each shrinkage is estimated from how much the sites differ beyond chance, so a site
with few documents says little and a large one much. Rates count labelled documents by their label and others by
their own text's odds. The sum of prior log-odds and ratio gives the probability that a document is good.

Site rates come from grouped sums over all documents, combined in each task before they are shuffled, so a host of any
size is a few rows. Only the ratios, a fixed number of bins, pass through the driver.

The host is ``source`` and the path is ``source`` with ``lang``; nulls are sites of their own. A null text is an empty
one. Labels that disagree about a document count by their mean; without labels every document has even odds and is
kept. Rows that repeat an id are scored each. All columns come back, and an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import staged, text_of

SIGNS = r"[|!?*#$%&@^~=<>{}\[\]_+/]"
#: Lower edges of the bins of each measure.
EDGES = {
    "signs": (0.001, 0.003, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2),
    "capitals": (0.01, 0.02, 0.03, 0.05, 0.08, 0.15, 0.3, 0.5, 0.7),
    "word_length": (3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 10.0, 14.0),
    "repeats": (0.01, 0.03, 0.06, 0.1, 0.2, 0.4),
}
SPACE = "[ \\t\\n\\x0B\\f\\r]+"
#: Rejected below this probability of being good: clean documents are dearer than rejected ones.
LEAST = 0.1


def _bin(value: Column, edges: tuple[float, ...]) -> Column:
    return sum((F.when(value >= e, 1).otherwise(0) for e in edges), F.lit(0))


def bins(text: Column) -> Column:
    """The numbers of the bins a text falls in, one for each measure."""
    chars = F.greatest(F.length(text), F.lit(1))
    counted = lambda signs: F.regexp_count(text, F.lit(signs)) / chars
    words = F.split(F.trim(text), SPACE)
    # the split text is bound to a variable, or Spark would split it again for every word
    again = F.transform(F.array(words), lambda ws: F.struct(
        F.size(ws).alias("n"), F.size(F.filter(ws, lambda w, i: (i > 0) & (w == F.get(ws, i - 1)))).alias("same")))
    measured = F.transform(again, lambda a: F.struct(counted(SIGNS).alias("signs"), counted("[A-Z]").alias("capitals"), (chars / a["n"]).alias("word_length"),
                                                     (a["same"] / a["n"]).alias("repeats")))
    # bound likewise: every edge of a bin would count the signs of the text anew
    return F.transform(measured, lambda m: F.array(*[
        (_bin(m[name], edges) + 1000 * i).cast("int") for i, (name, edges) in enumerate(EDGES.items())]))[0]


@dataclass
class QualityModel:
    ratios: dict[int, float]
    #: source, lang, logit, host_rate, path_rate: a row for each path
    sites: DataFrame

    def ratio(self, own_bins: Column) -> Column:
        if not self.ratios:
            return F.lit(0.0)
        table = F.create_map(*[F.lit(x) for pair in sorted(self.ratios.items()) for x in pair])
        return F.aggregate(own_bins, F.lit(0.0), lambda held, b: held + F.coalesce(F.try_element_at(table, b), F.lit(0.0)))


def _logit(rate: Column) -> Column:
    return F.log(rate / (1 - rate))


def _strength(rates: DataFrame, rate: Column, prior: Column) -> float:
    """Prior strength in documents: how far the rates of sites lie from their prior beyond what chance explains."""
    chance = prior * (1 - prior) / F.col("n")
    moment = rates.agg((F.sum(F.col("n") * (F.pow(rate - prior, 2) - chance)) / F.sum("n")).alias("between"),
                       (F.sum(F.col("n") * prior * (1 - prior)) / F.sum("n")).alias("within")).first()
    between, within = moment["between"] or 0.0, moment["within"] or 0.25
    return min(1e6, max(1.0, within / between - 1)) if between > 0 else 1e6


def fit(measured: DataFrame, labels: DataFrame) -> QualityModel:
    """Fit to ``measured`` (doc_id, source, lang, bins: staged) and ``labels`` (doc_id, quality)."""
    known = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.avg("quality").alias("good")))
    told = measured.join(known, "doc_id").select("good", F.explode("bins").alias("bin"))
    counts = told.groupBy("bin").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")).collect()  # a row for each bin
    ratios: dict[int, float] = {}
    for measure in {r["bin"] // 1000 for r in counts}:
        own = [r for r in counts if r["bin"] // 1000 == measure]
        good, bad = sum(r["good"] for r in own) + len(own), sum(r["bad"] for r in own) + len(own)
        ratios |= {r["bin"]: log((r["good"] + 1) / good) - log((r["bad"] + 1) / bad) for r in own}
    measures = max(1, len({b // 1000 for b in ratios}))
    good, bad = sum(r["good"] for r in counts) / measures, sum(r["bad"] for r in counts) / measures
    overall = (good + 1) / (good + bad + 2)
    model = QualityModel(ratios, measured)
    odds = model.ratio(F.col("bins")) + log(overall / (1 - overall))
    soft = 1 / (1 + F.exp(-odds))
    each = measured.join(known, "doc_id", "left").select("source", "lang", F.coalesce("good", soft).alias("good"))
    paths = staged(each.groupBy("source", "lang").agg(F.sum("good").alias("good"), F.count("*").alias("n")), "paths")
    total = paths.agg((F.sum("good") + 1).alias("good"), (F.sum("n") + 2).alias("n")).first()
    rate = (total["good"] or 1.0) / (total["n"] or 2)
    hosts = paths.groupBy(F.col("source").alias("host")).agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    k = _strength(hosts, F.col("good") / F.col("n"), F.lit(rate))
    hosts = hosts.select("host", ((F.col("good") + k * rate) / (F.col("n") + k)).alias("host_rate"))
    both = paths.join(hosts, F.col("source").eqNullSafe(F.col("host"))).drop("host")
    k = _strength(both, F.col("good") / F.col("n"), F.col("host_rate"))
    path_rate = (F.col("good") + k * F.col("host_rate")) / (F.col("n") + k)
    bounded = F.least(F.greatest(path_rate, F.lit(1e-6)), F.lit(1 - 1e-6))
    model.sites = staged(both.select("source", "lang", "host_rate", bounded.alias("path_rate")), "sites")
    return model


def measure(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.col("lang").cast("string").alias("lang"), bins(text_of()).alias("bins"))


def scored(rows: DataFrame, model: QualityModel, own_bins: Column) -> DataFrame:
    """``row`` (the given column of that name), ``_ratio``, ``_host_rate``, ``_path_rate`` and ``_p`` of ``rows`` (row, source, lang, text or bins)."""
    sites = model.sites.select(F.col("source").alias("_source"), F.col("lang").alias("_lang"),
                               F.col("host_rate").alias("_host_rate"), F.col("path_rate").alias("_path_rate"))
    same = F.col("_source").eqNullSafe(F.col("source").cast("string")) & F.col("_lang").eqNullSafe(F.col("lang").cast("string"))
    odds = F.col("_ratio") + _logit(F.col("_path_rate"))
    return (rows.withColumn("_ratio", model.ratio(own_bins)).join(sites, same).drop("_source", "_lang")
            .withColumn("_p", 1 / (1 + F.exp(-odds))))


def quality(docs: DataFrame, labels: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, ratio, host_rate, path_rate, p_good and kept of every row of ``docs`` (doc_id, text, source, lang)."""
    measured = staged(measure(docs), "measured")
    found = scored(measured.withColumnRenamed("doc_id", "row"), fit(measured, labels), F.col("bins"))
    return found.select(F.col("row").alias("doc_id"), F.col("_ratio").alias("ratio"), F.col("_host_rate").alias("host_rate"),
                        F.col("_path_rate").alias("path_rate"), F.col("_p").alias("p_good"), (F.col("_p") >= least).alias("kept"))


def good_documents(docs: DataFrame, labels: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    model = fit(staged(measure(docs), "measured"), labels)
    rows = docs.select(F.struct("*").alias("row"), "source", "lang", "text")
    return scored(rows, model, bins(text_of())).filter(F.col("_p") >= least).select("row.*")
