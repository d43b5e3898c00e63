"""Quality rules whose verdict is shared between the documents of one domain.

Each document is measured against a list of rules. Failures are summed by domain, and a domain's rate for
a rule is shrunk towards the corpus by a beta prior fitted to all domains by the method of moments: small domains
say little, large ones speak for themselves. A domain is rejected by a rule if its shrunk rate is above the
rule's limit, and the verdict goes back to its documents. Documents that fail a base rule go in any case.

Measuring is one pass of array work. Sums are combined before they are shuffled, so a domain with a third of all
rows is one row per task, and the verdict table (one row per domain) is joined by key, broadcast only if Spark
measures it to be small.

Defined results: null and wordless texts have no words and fail the base rules; rows without a domain form
one domain of their own; an empty table gives an empty result; a single domain has no spread to fit, so
the prior is the corpus rate with the least weight.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pulsefold.llm.tables import own_columns, stored
from pulsefold.llm.texts import Words, cut, mix, ngrams, slices

SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


@dataclass(frozen=True)
class Settings:
    """`limits`: the shrunk failure rate above which a domain goes, for each rule. `weight`: bounds of the prior's weight in documents."""

    min_words: int = 50
    repeat_percent: int = 50
    symbol_percent: int = 10
    dup_line_percent: int = 30
    least_mean_chars: float = 3.0
    most_mean_chars: float = 12.0
    limits: tuple[tuple[str, float], ...] = (
        ("few_words", 0.8), ("repeats", 0.5), ("symbols", 0.5), ("dup_lines", 0.5), ("word_length", 0.8))
    weight: tuple[float, float] = (1.0, 1000.0)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, domain and the counts of each text."""
    def run(batches):
        for piece in slices(batches, "text"):
            n = len(piece)
            words = cut(piece.column(2))
            hashes = words.hashes()
            total = lambda mask, doc: np.bincount(doc[mask], minlength=n).astype(np.int64)
            byte_doc = np.searchsorted(words.offsets, np.arange(len(words.data)), "right") - 1
            in_word = np.zeros(len(words.data) + 1, np.int64)
            in_word[words.starts] += 1
            np.subtract.at(in_word, words.ends, 1)
            in_word = np.cumsum(in_word)[:-1] > 0
            begins_char = (words.data & 0xC0) != 0x80
            # Lines: runs between line feeds; their identity is a hash of their bytes.
            line_doc, line_hash, with_word = lines(words)
            order = np.lexsort((np.arange(len(line_hash)), line_hash, line_doc))
            again = np.zeros(len(order), bool)
            again[1:] = (line_hash[order][1:] == line_hash[order][:-1]) & (line_doc[order][1:] == line_doc[order][:-1])
            dup = np.zeros(len(order), bool)
            dup[order] = again
            grams, at = ngrams(words, hashes, 3)
            owner = words.doc[at]
            _, which, count = np.unique(mix(grams) ^ mix(owner.astype(np.uint64) + np.uint64(1)), return_inverse=True, return_counts=True)
            edge = np.zeros(len(hashes) + 1, np.int64)
            twice = at[count[which] > 1]
            np.add.at(edge, twice, 1)
            np.add.at(edge, twice + 3, -1)
            yield pa.RecordBatch.from_arrays([
                piece.column(0), piece.column(1), pa.array(np.diff(words.first()).astype(np.int64)),
                pa.array(total(in_word & begins_char, byte_doc)), pa.array(total(SYMBOL[words.data], byte_doc)),
                pa.array(total(with_word, line_doc)), pa.array(total(dup & with_word, line_doc)),
                pa.array(total(np.cumsum(edge)[:-1] > 0, words.doc)),
            ], ["doc_id", "domain", *COUNTS])

    return docs.mapInArrow(run, "doc_id long, domain string, " + ", ".join(f"{c} long" for c in COUNTS))


def lines(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, hash and "has a word" of each line of each text."""
    data, offsets = words.data, words.offsets
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    starts = starts[starts < len(data)]
    doc = np.searchsorted(offsets, starts, "right") - 1
    ends = np.minimum(offsets[doc + 1], np.concatenate([breaks, [len(data)]])[np.searchsorted(breaks, starts)])
    filled = ends > starts
    hashes = np.zeros(len(starts), np.uint64)
    hashes[filled] = Words(data, offsets, starts[filled], ends[filled], doc[filled]).hashes()
    held = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    return doc, hashes, held


def rules(settings: Settings) -> dict:
    """Name and failing condition of each rule, in the order of reporting."""
    s, words = settings, F.col("n_words")
    mean = F.try_divide("word_chars", "n_words")
    return {
        "few_words": words < s.min_words,
        "repeats": 100 * F.col("n_repeat_words") > s.repeat_percent * words,
        "symbols": 100 * F.col("n_symbols") > s.symbol_percent * words,
        "dup_lines": 100 * F.col("n_dup_lines") > s.dup_line_percent * F.col("n_lines"),
        "word_length": F.coalesce((mean < s.least_mean_chars) | (mean > s.most_mean_chars), F.lit(True)),
    }


def verdicts(measured: DataFrame, settings: Settings) -> DataFrame:
    """domain, its documents, and for each rule the shrunk failure rate; `host_kept` says if all are within limits."""
    names = list(rules(settings))
    by_domain = measured.groupBy("domain").agg(F.count("*").alias("docs"), *[F.sum(F.col(f"fails_{r}").cast("long")).alias(r) for r in names])
    by_domain = stored(by_domain, "domains")
    # Moments over domains: the mean rate, and how far domains spread beyond what chance gives them.
    moments = by_domain.agg(
        F.sum("docs").alias("docs"), F.count("*").alias("domains"), F.sum(1 / F.col("docs")).alias("inverse"),
        *[F.sum(r).alias(f"sum_{r}") for r in names], *[F.avg(F.col(r) / F.col("docs")).alias(f"mean_{r}") for r in names],
        *[F.var_samp(F.col(r) / F.col("docs")).alias(f"var_{r}") for r in names])
    low, high = settings.weight
    priors = {}
    for r in names:
        rate, spread = F.col(f"mean_{r}"), F.col(f"var_{r}") - F.col(f"mean_{r}") * (1 - F.col(f"mean_{r}")) * F.col("inverse") / F.col("domains")
        weight = F.when(F.col(f"var_{r}").isNull(), F.lit(low)).when(spread <= 0, F.lit(high)).otherwise(rate * (1 - rate) / spread - 1)
        priors[f"rate_{r}"] = F.col(f"sum_{r}") / F.col("docs")
        priors[f"weight_{r}"] = F.least(F.greatest(weight, F.lit(low)), F.lit(high))
    prior = moments.select(*[v.alias(k) for k, v in priors.items()]).first()
    out, kept = {}, F.lit(True)
    for r, limit in settings.limits:
        # Nothing to shrink towards in an empty table.
        weight, rate = prior[f"weight_{r}"] or 0.0, prior[f"rate_{r}"] or 0.0
        out[f"{r}_rate"] = (F.col(r) + weight * rate) / (F.col("docs") + weight)
        kept = kept & (F.col(f"{r}_rate") <= limit)
    return by_domain.withColumns(out).withColumn("host_kept", kept)


def judge(documents: DataFrame, settings: Settings = Settings(), domain: str = "source") -> DataFrame:
    """Counts, base_failed, host_kept and kept for every row of `documents` (doc_id, text, `domain`)."""
    docs = own_columns(documents, "doc_id", domain, "text").withColumnRenamed(domain, "domain")
    failing = rules(settings)
    measured = stored(measures(docs), "measures").withColumns({f"fails_{r}": c for r, c in failing.items()})
    base = F.col("fails_few_words") | F.col("fails_repeats")
    hosts = verdicts(measured, settings).select(F.col("domain").alias("host"), "host_kept")
    rows = measured.join(hosts, F.col("domain").eqNullSafe(F.col("host")), "left")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
                       (~base & F.col("host_kept")).alias("kept"), "host_kept")
