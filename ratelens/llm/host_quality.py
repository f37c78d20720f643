"""Quality rules with host verdicts.

Each document is measured once (a linear pass and a sort of its word windows) and tested by the rules of ``RULES``. The
failures of each rule are summed by domain, with partial sums before the shuffle. A host's rate of
a rule is shrunk by an empirical beta prior: the rule's mean rate over the hosts and the spread of
their rates beyond what sampling explains (method of moments) give the prior's mean and strength, so
a host of few documents is judged mostly by the prior and a large one by its own rate. A host fails
a rule if its shrunk rate, less ``SURE`` standard deviations of the posterior, is above ``LIMIT``; a host that fails any
rule takes all its documents with it. Verdicts are joined back to the documents; only the failed
hosts are sent, broadcast if their measured size allows it.

Defined results: a null text has no words; a document with a null or empty domain has no host and is judged by
its own text; words are runs of characters other than blank, tab, line feed, vertical tab, form feed
and carriage return; texts are measured whole, whatever their length; repeated rows are documents of their
own, each counted by its host; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_BYTES, layer

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]

#: The rules: a document's failure, over its measures. The first two also fail the document itself.
BASE_RULES = {"short": "n_words < 20", "repetitive": "100 * n_repeat_words > 30 * n_words"}
HOST_RULES = {"symbols": "10 * n_symbols > n_words",
              "word_length": "n_words > 0 and (word_chars < 3 * n_words or word_chars > 10 * n_words)",
              "dup_lines": "100 * n_dup_lines > 30 * n_lines"}
RULES = BASE_RULES | HOST_RULES

#: A host fails a rule when its rate is surely above this.
LIMIT, SURE = 0.5, 2.0
#: Bounds of the prior's strength in documents; hosts that do not differ at all take the upper one.
WEAKEST, STRONGEST = 2.0, 10_000.0


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of ``WINDOW`` words that occur twice or more, the first included.

    Windows are named by doubling (pairs of words, of pairs, of fours), so equal names are equal windows.
    """
    n = len(words)
    if n <= WINDOW:
        return 0
    seen: dict[bytes, int] = {}
    names = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=n)
    step, top = 1, len(seen)
    while step < WINDOW:
        pairs = names[:-step] * top + names[step:]
        values, names, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        top, step = len(values), 2 * step
        if top == len(pairs):
            return 0
    cover = np.zeros(n + 1, dtype=np.int64)
    starts = np.flatnonzero(counts[names] > 1)
    cover[starts] += 1
    cover[starts + WINDOW] -= 1
    return int(np.count_nonzero(np.cumsum(cover[:n])))


def measure(text: str | None) -> tuple[int, ...]:
    """The ``MEASURES`` of a text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at exactly the six SPACES
    chars = len(text) - sum(text.count(c) for c in SPACES) if words else 0
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (len(words), chars, sum(text.count(c) for c in SYMBOLS), len(lines), len(lines) - len(set(lines)),
            repeated_words(words))


def measures(docs: DataFrame, domain: str) -> DataFrame:
    """(doc_id, domain, ``MEASURES``): a row a document."""
    rows = docs.select("doc_id", F.col(domain).cast("string").alias("domain"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([*rows.schema.fields[:2], *(T.StructField(m, T.LongType()) for m in MEASURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(t.as_py()) for t in batch.column(2)]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], *(pa.array(c, pa.int64()) for c in zip(*found, strict=True))], names=schema.names)

    return rows.mapInArrow(run, schema)


def host_of(url: Column) -> Column:
    """The host of a URL, lower case, without ``www.`` and port; null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def host_rates(measured: DataFrame) -> DataFrame:
    """(domain, rule, n, failed): a row a host and rule."""
    sums = measured.where("domain <> ''").groupBy("domain").agg(
        F.count("*").alias("n"), *(F.sum(F.expr(x).cast("long")).alias(r) for r, x in RULES.items()))
    return sums.unpivot(["domain", "n"], list(RULES), "rule", "failed")


def priors(rates: DataFrame) -> DataFrame:
    """(rule, mean, strength): the beta prior of each rule by the moments of the hosts' rates."""
    rate = F.col("failed") / F.col("n")
    sums = rates.groupBy("rule").agg(F.avg(rate).alias("mean"), F.var_samp(rate).alias("var"), F.avg(1 / F.col("n")).alias("inv"))
    binomial = F.col("mean") * (1 - F.col("mean"))
    # the variance of the true rates: what sampling n documents of each host does not explain
    true = (F.col("var") - binomial * F.col("inv")) / (1 - F.col("inv"))
    strength = F.when((F.col("inv") < 1) & (true > 0), binomial / true - 1).otherwise(F.lit(STRONGEST))
    return sums.select("rule", "mean", F.least(F.greatest(strength, F.lit(WEAKEST)), F.lit(STRONGEST)).alias("strength"))


def host_verdicts(rates: DataFrame) -> DataFrame:
    """``rates`` with the shrunk ``rate``, its deviation ``sd`` and the verdict ``host_failed``."""
    a = F.col("failed") + F.col("mean") * F.col("strength")
    total = F.col("n") + F.col("strength")
    shrunk = rates.join(F.broadcast(priors(rates)), "rule")  # a row a rule of RULES
    shrunk = shrunk.withColumn("rate", a / total)
    shrunk = shrunk.withColumn("sd", F.sqrt(F.col("rate") * (1 - F.col("rate")) / (total + 1)))
    return shrunk.withColumn("host_failed", F.col("rate") - SURE * F.col("sd") > LIMIT)


def judge(docs: DataFrame, domain: str = "source") -> DataFrame:
    """A row a document: doc_id, domain, the ``MEASURES``, base_failed, host_failed, failed_rules (the
    host's, comma-joined), kept."""
    measured = layer(measures(docs, domain), "quality-measures")
    verdicts = host_verdicts(layer(host_rates(measured), "quality-rates"))
    bad = layer(verdicts.where("host_failed").groupBy("domain").agg(
        F.array_join(F.array_sort(F.collect_list("rule")), ",").alias("failed_rules")), "quality-hosts")
    size = bad.agg(F.coalesce(F.sum(F.octet_length("domain") + F.octet_length("failed_rules") + 64), F.lit(0))).first()[0]
    joined = measured.join(F.broadcast(bad) if size <= BROADCAST_BYTES else bad, "domain", "left")
    base = F.lit(False)
    for rule in BASE_RULES.values():
        base = base | F.expr(rule)
    return (joined.withColumn("base_failed", base).withColumn("host_failed", F.col("failed_rules").isNotNull())
            .withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))
            .select("doc_id", "domain", *MEASURES, "base_failed", "host_failed", "failed_rules", "kept"))
