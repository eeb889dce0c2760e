"""URL filters: host and path rules, and a logistic regression on hashed character n-grams.

The model is trained on the driver from a small labelled URL table (:data:`LABELLED` spells it as
host words and a rule that builds urls from them, a few hundred rows whatever the size of the data);
its weights are one array of ``2**BITS`` numbers, which tasks use to score urls.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 14
SIZES = (3, 4, 5)
THRESHOLD = 0.5

#: (rule, verdict): host up to the first slash, then a path prefix.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

# Words that the labelled table builds its hosts and paths from.
LABELLED = {
    "block": ["cheap-pills", "casino-win", "free-bets", "adult-x", "spam-farm", "ads-track", "online-casino", "poker-bonus",
              "viagra-store", "buy-pills", "xxx-video", "sex-cam", "porn-tube", "click-ads", "ad-tracker", "bet-slots",
              "payday-loan", "free-money", "crack-keygen", "warez-download", "win-prize", "cheap-meds", "adult-chat", "link-farm"],
    "allow": ["news", "weather", "library", "science", "history", "travel", "garden", "kitchen", "music", "school",
              "museum", "forum", "wiki", "docs", "sports", "health", "theatre", "city", "river", "mountain",
              "stone", "bridge", "letter", "water", "ander", "entre"],
}
_SYLLABLES = ("th", "er", "in", "on", "tion", "an", "re", "ed", "ble", "wh", "nt", "st")  # plain made-up names are allowed
_PREFIXES = ("", "www.", "m.", "blog.")
_ENDS = (".com", ".org", ".net", ".example.com", ".example.org", ".example.net")
_COMMON_PATHS = ("/", "/en/12", "/de/345.html", "/fr/678/", "/es/90")
_PATHS = {"block": (*_COMMON_PATHS, "/bonus/win", "/buy/cheap"), "allow": (*_COMMON_PATHS, "/article/12", "/about/team")}


def labelled_urls() -> list[tuple[str, str, int]]:
    """(host, path, 1 for block) rows: every word once under each prefix, with ends and paths in turn."""
    rows = []
    names = LABELLED | {"allow": LABELLED["allow"] + [a + b + c for (a, b), c in zip(product(_SYLLABLES, _SYLLABLES), _SYLLABLES * 12, strict=True) if a != b]}
    for label, words in names.items():
        for k, (word, prefix) in enumerate(product(words, _PREFIXES)):
            rows.append((prefix + word + _ENDS[k % len(_ENDS)], _PATHS[label][k % len(_PATHS[label])], int(label == "block")))
    return rows


def features(host: str, path: str) -> np.ndarray:
    """Sorted distinct hashed n-grams; host and path are told apart by their border marks."""
    found = set()
    for mark, part in (("h", host), ("p", path)):
        text = f"^{part}$"
        for n in SIZES:
            for i in range(len(text) - n + 1):
                found.add(xxhash.xxh32_intdigest(f"{mark}{n}{text[i:i + n]}") & ((1 << BITS) - 1))
    return np.fromiter(sorted(found), dtype=np.int64)


def train(rows: list[tuple[str, str, int]], epochs: int = 300, rate: float = 0.5, decay: float = 2e-4) -> np.ndarray:
    """Weights (the last one is the bias) of an L2-regularised logistic regression, by full-batch
    gradient steps on length-normalised features; the two classes weigh alike."""
    lists = [features(h, p) for h, p, _ in rows]
    index = np.concatenate(lists)
    row = np.repeat(np.arange(len(rows)), [len(x) for x in lists])
    value = 1 / np.sqrt(np.array([len(x) for x in lists], dtype=float))[row]
    y = np.array([label for *_, label in rows], dtype=float)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    w = np.zeros((1 << BITS) + 1)
    step = np.zeros_like(w)
    for _ in range(epochs):
        z = np.bincount(row, w[index] * value, minlength=len(rows)) + w[-1]
        error = (1 / (1 + np.exp(-z)) - y) * weight
        grad = decay * w
        grad[:-1] += np.bincount(index, error[row] * value, minlength=1 << BITS)
        grad[-1] = error.sum()
        step = 0.9 * step + grad
        w -= rate * 10 * step
    return w


def block_probability(weights: np.ndarray, host: str, path: str) -> float:
    f = features(host, path)
    z = weights[f].sum() / np.sqrt(max(1, len(f))) + weights[-1]
    return float(1 / (1 + np.exp(-z)))


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for text, said in sorted(rules, key=lambda r: len(r[0])):  # longer ones are asked first
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def judge_urls(pages: DataFrame, rules=RULES, rows: list[tuple[str, str, int]] | None = None,
               threshold: float = THRESHOLD) -> DataFrame:
    """``pages`` with host, path, rule, score (the model's probability of block) and verdict.

    Columns of these names in ``pages`` are replaced.  Defined cases: a null url, or one without
    ``://``, has an empty host and path, fits no rule and goes to the model; an empty path fits no
    rule; equal rows get equal verdicts; very long urls are read whole; an empty table gives an
    empty table.
    """
    pages = pages.drop("host", "path", "rule", "score", "verdict")
    weights = pages.sparkSession.sparkContext.broadcast(train(rows or labelled_urls()))

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths in batches:
            yield pd.Series([block_probability(weights.value, h, p) for h, p in zip(hosts, paths, strict=True)], dtype=float)

    judged = pages.withColumns({"host": host_of(F.col("url").cast("string")), "path": path_of(F.col("url").cast("string"))})
    judged = judged.withColumn("score", score("host", "path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    model = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return judged.withColumns({"rule": rule, "verdict": F.coalesce(verdict, model)})
