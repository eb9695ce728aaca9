"""Quality rules judged by host: failures per host and rule, shrunk by an empirical beta prior."""

from __future__ import annotations

import re
from itertools import pairwise

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartrail.llm.common import WORD, map_texts, settled, written

HOST_LIMIT = 0.5
#: what a document's soft failures may weigh together; one of a host that fails as often as others weighs 1
SOFT_LIMIT = 1.0 - 1e-9
_WORD = re.compile(WORD)
_SYMBOL = re.compile(r"[#*$%&|<>]")
WINDOW = 5

#: a document fails a rule where its expression is true; the first two make ``base_failed``
RULES = {
    "short": "n_words < 10",
    "repeated": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "copied_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "n_words > 0 and (word_chars < 2 * n_words or word_chars > 20 * n_words)",
}
BASE_RULES = ("short", "repeated")
SOFT_RULES = ("symbols", "copied_lines", "word_length")
FEATURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[str], width: int = WINDOW) -> int:
    """How many words stand in a window of ``width`` words that occurs twice or more in the text."""
    windows = list(zip(*(words[i:] for i in range(width)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple[str, ...], int] = {}
    starts = set()
    for i, window in enumerate(windows):
        before = first.setdefault(window, i)
        if before != i:
            starts.update((before, i))
    ordered = sorted(starts)
    gaps = sum(min(width, b - a) for a, b in pairwise(ordered))
    return gaps + (width if ordered else 0)


def text_features(texts: list[str | None]) -> dict[str, list[int]]:
    """The counts of ``FEATURES`` for each text; NULL counts as empty."""
    found: dict[str, list[int]] = {name: [] for name in FEATURES}
    for text in texts:
        words = _WORD.findall(text or "")
        lines = [line for line in (text or "").split("\n") if _WORD.search(line)]
        found["n_words"].append(len(words))
        found["word_chars"].append(sum(map(len, words)))
        found["n_symbols"].append(len(_SYMBOL.findall(text or "")))
        found["n_lines"].append(len(lines))
        found["n_dup_lines"].append(len(lines) - len(set(lines)))
        found["n_repeat_words"].append(repeated_words(words))
    return found


def priors(hosts: DataFrame) -> dict[str, tuple[float, float]]:
    """By rule: mean and strength (a + b) of the beta distribution that the failure rates of the hosts follow.

    By moments, with hosts weighted by their documents: the variance between hosts is what exceeds the
    binomial one. Hosts that differ no more than chance get the strength of all documents together. One pass
    over the hosts brings two sums for each rule to the driver.
    """
    per_rule = []
    for rule in RULES:
        per_rule.append(F.sum(rule).alias(f"{rule}_failed"))
        per_rule.append(F.sum(F.col(rule) / F.col("documents") * F.col(rule)).alias(f"{rule}_spread"))
    sums = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("documents").alias("n"),
        F.sum(F.col("documents").cast("double") ** 2).alias("nn"),
        *per_rule,
    ).first()
    if not sums["hosts"]:
        return dict.fromkeys(RULES, (0.0, 1.0))
    found = {}
    n, others = float(sums["n"]), sums["hosts"] - 1
    freedom = n - sums["nn"] / n - others
    for rule in RULES:
        mean = sums[f"{rule}_failed"] / sums["n"]
        chance = mean * (1 - mean)
        strength = n
        if chance > 0 and freedom > 0:
            share = (sums[f"{rule}_spread"] - n * mean * mean - others * chance) / (chance * freedom)
            strength = n if share <= 0 else max(1 / min(share, 0.999) - 1, 1e-3)
        found[rule] = mean, strength
    return found


def host_verdicts(features: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """``(host, documents, <rule>_rate..., <soft rule>_weight..., rejected)``, one row per host, from documents
    with rule columns.

    A rate is the posterior mean under the prior of all hosts, so a host with few documents is judged much
    like the rest. The weight of a rule is the host's rate by that of all documents: how much more its failure
    says here than elsewhere. A host is rejected when a rate exceeds ``limit``. NULL is no host and is not in the
    table.
    """
    per_rule = [F.sum(F.col(rule).cast("long")).alias(rule) for rule in RULES]
    hosts = settled(features.where("host is not null").groupBy("host").agg(F.count(F.lit(1)).alias("documents"), *per_rule))
    found = priors(hosts)
    rates = {
        rule: (F.col(rule) + F.lit(mean * strength)) / (F.col("documents") + F.lit(strength))
        for rule, (mean, strength) in found.items()
    }
    weights = [
        (rates[rule] / F.lit(found[rule][0]) if found[rule][0] > 0 else F.lit(1.0)).alias(f"{rule}_weight") for rule in SOFT_RULES
    ]
    rejected = F.greatest(*rates.values()) > F.lit(limit)
    return hosts.select("host", "documents", *[r.alias(f"{n}_rate") for n, r in rates.items()], *weights, rejected.alias("rejected"))


def judge(
    docs: DataFrame, limit: float = HOST_LIMIT, doc_id: str = "doc_id", text: str = "text", host: str = "source"
) -> DataFrame:
    """Counts, failed rules and verdict of every document: ``doc_id, host, <FEATURES>, <RULES>, base_failed,
    soft_weight, host_rejected, kept``.

    ``kept`` is false for a document that fails a base rule, whose host is rejected, or whose failures of soft rules
    weigh ``SOFT_LIMIT`` or more together by the host's weights: a single one is forgiven on a host that, after
    shrinking, fails the rule less than all documents do. Without a host (NULL) each weighs 1. NULL and empty texts have no words and fail ``short``.
    Equal rows get equal verdicts; an empty table gives no rows; other columns are not looked at.
    """
    made = ", ".join(f"{name} long" for name in FEATURES)
    kept = [F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{host}`").cast("string").alias("host")]
    counted = map_texts(docs, kept, text, text_features, made)
    features = settled(counted.withColumns({name: F.expr(rule) for name, rule in RULES.items()}))
    weights = [f"{rule}_weight" for rule in SOFT_RULES]
    hosts = written(host_verdicts(features, limit).select(F.col("host").alias("__host"), "rejected", *weights))
    # every row finds one host at most and none are grouped afterwards, so a hot host's partition can be split
    joined = features.join(hosts, F.col("host") == F.col("__host"), "left")
    base = F.greatest(*[F.col(rule) for rule in BASE_RULES])
    soft = sum((F.when(F.col(r), F.coalesce(F.col(f"{r}_weight"), F.lit(1.0))).otherwise(0.0) for r in SOFT_RULES), F.lit(0.0))
    host_rejected = F.coalesce(F.col("rejected"), F.lit(False))
    return joined.select(
        "doc_id",
        "host",
        *FEATURES,
        *RULES,
        base.alias("base_failed"),
        soft.alias("soft_weight"),
        host_rejected.alias("host_rejected"),
        (~base & ~host_rejected & (soft < SOFT_LIMIT)).alias("kept"),
    )
