"""URL verdicts: rules first, then naive Bayes over segmented host names and path words.

A host name is cut at dots, digits and hyphens; each name left is split into words by
Viterbi over a unigram model: the split with the largest product of word shares. The
model counts the words of all pages' text, and the words that hosts spell apart
(``cheap-pills``); it grows with the input and is never sent anywhere whole. Each distinct
host is joined with the words that occur in it instead, at most ``LONGEST_WORD`` for each of
its letters, and split where those arrive. The last label is one word as it stands.

Naive Bayes is multinomial over host words and path words. Its labels come from
``BLOCKED_WORDS``: hosts one of whose words is listed count as blocked, all others as
allowed. Shares are smoothed towards those of both kinds together, so a word known from
neither says nothing, and names that go with the listed words are learned beside them.
It is fitted on at most ``ROWS_PER_CLASS`` pages of each kind, chosen by hash; everything
else covers all pages.

A rule is a host and the beginning of a path and fits the host and its subdomains; the
longest that fits decides, whatever the model says.

Null urls and urls without ``://`` have an empty host and path: no rule, no words, and the
verdict of the prior. Names of more letters than a host can have (``LONGEST_NAME``) stay
whole. Repeated rows are judged alike, null ids as well. Extra columns are not looked at.
A host that holds a large part of all pages is spread over lanes in the only join of pages.
Without any page with a listed word every score is the prior's.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaseload.llm.common import written

LONGEST_NAME = 63
LONGEST_WORD = 20
ROWS_PER_CLASS = 20_000
# Weight of the common shares in those of a kind, in words.
SMOOTHING = 10.0
# A host is hot from this share of all pages on, so there are fewer hot hosts than HOT_PARTS.
HOT_PARTS = 1_000

# Words that mark a name as unwanted (gambling, adult, pills, spam, trackers).
BLOCKED_WORDS = """
adult ads adserver bet bets betting bingo casino casinos escort escorts gamble gambling jackpot lottery malware
phishing pill pills poker porn porno sex sexy slots spam tracker tracking viagra cialis warez webcam xxx
""".split()

_NAME = r"[^\x00-\x60\x7B-\x7F]+"
NAME = re.compile(_NAME)


def parts_of(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL, empty where there is no ``://``."""
    begin = F.instr(url, "://")
    rest = F.when(begin > 0, F.substr(url, begin + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    host = F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(F.substr(rest, F.length(raw) + 1), "^[^?#]*", 0)


@dataclass
class Rules:
    """Allow and block rules such as ``("block", "example.org/es/")``."""

    rules: tuple[tuple[str, str], ...]
    by_host: dict[str, list[tuple[str, str, str]]] = field(init=False)

    def __post_init__(self) -> None:
        self.by_host = {}
        for verdict, rule in self.rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, verdict))
        self.longest = max(map(len, self.by_host), default=0)

    def fitting(self, host: str, path: str) -> tuple[str | None, str | None]:
        """(rule, verdict) of the longest rule that fits, the one of the longer host among equals."""
        best: tuple[int, int, str, str] | None = None
        least = len(host) - self.longest
        starts = [0] if least <= 0 else []
        starts += [m for m in range(max(1, least), len(host) + 1) if host[m - 1] == "."]
        for start in starts:
            for beginning, rule, verdict in self.by_host.get(host[start:], ()):
                if path.startswith(beginning):
                    best = max(best or (-1, 0, "", ""), (len(rule), len(host) - start, rule, verdict))
        return best[2:] if best else (None, None)


def word_counts(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(word, n): words of all page texts, and words that hosts spell apart; listed words once at least."""
    text = F.lower(F.regexp_replace(F.coalesce("html", F.lit("")), "<[^<>]*>", " "))
    name = _NAME.replace("+", f"{{1,{LONGEST_WORD}}}")
    in_text = pages.select(F.explode(F.regexp_extract_all(text, F.lit(rf"(?<!{_NAME[:-1]}){name}(?!{_NAME[:-1]})"), F.lit(0))).alias("word"))
    # Labels with a hyphen or digit in them, without the last label.
    apart = hosts.select(F.explode(F.slice(F.split("host", r"\."), 1, F.greatest(F.size(F.split("host", r"\.")) - 1, F.lit(0)))).alias("label"))
    apart = apart.filter(F.col("label").rlike("[-0-9_]")).select(F.explode(F.regexp_extract_all("label", F.lit(_NAME), F.lit(0))).alias("word"))
    apart = apart.filter(F.length("word") <= LONGEST_WORD)
    listed = pages.sparkSession.createDataFrame([(w,) for w in BLOCKED_WORDS], "word string")
    return in_text.unionByName(apart).unionByName(listed).groupBy("word").agg(F.count("*").alias("n"))


def split_name(name: str, shares: dict[str, float], unknown: float) -> list[str]:
    """Words of a name by Viterbi. ``shares`` has logarithms; a word that it lacks costs
    ``unknown`` and one decimal more for each letter. Of equal splits the one with the
    longer last word."""
    if len(name) > LONGEST_NAME:
        return [name]
    best = [0.0] + [-np.inf] * len(name)
    back = [0] * (len(name) + 1)
    for end in range(1, len(name) + 1):
        for begin in range(end):
            word = name[begin:end]
            value = best[begin] + shares.get(word, unknown - (end - begin) * np.log(10))
            if value > best[end]:
                best[end], back[end] = value, begin
    words, end = [], len(name)
    while end:
        words.append(name[back[end] : end])
        end = back[end]
    return words[::-1]


def names_of(host: str) -> tuple[list[str], list[str]]:
    """(names to split, words as they stand) of a host."""
    *labels, last = host.split(".")
    if not labels:
        labels, last = [last], ""
    return NAME.findall(".".join(labels)), NAME.findall(last)


def segmented(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """``hosts`` with ``words``: the words of each host in order."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    unknown = float(np.log(10.0 / total))

    @F.pandas_udf("array<string>")
    def pieces(host: pd.Series) -> pd.Series:
        def of(text: str) -> list[str]:
            found = {
                n[i:j] for n in names_of(text)[0] if len(n) <= LONGEST_NAME
                for i in range(len(n)) for j in range(i + 1, min(len(n), i + LONGEST_WORD) + 1)
            }
            return sorted(found)

        return host.map(of)

    @F.pandas_udf("array<string>")
    def split(host: pd.Series, known: pd.Series, logs: pd.Series) -> pd.Series:
        out = []
        for text, words, values in zip(host, known, logs):
            shares = dict(zip(words, values)) if words is not None else {}
            to_split, whole = names_of(text)
            out.append([w for n in to_split for w in split_name(n, shares, unknown)] + whole)
        return pd.Series(out)

    spelled = hosts.select("host", F.explode(pieces("host")).alias("word")).join(counts, "word")
    # At most LONGEST_WORD words for each letter of a name, and names are short.
    known = spelled.groupBy("host").agg(
        F.collect_list(F.struct("word", F.log(F.col("n") / total).alias("log"))).alias("known")
    )
    beside = hosts.join(known.withColumnRenamed("host", "known_host"), F.col("host") == F.col("known_host"), "left")
    return beside.select(*hosts.columns, split("host", F.col("known.word"), F.col("known.log")).alias("words"))


def path_words(path: str) -> list[str]:
    """Words of a path; runs of digits are one word whatever their value."""
    return ["0" if w.isdigit() else w for w in re.findall(r"[0-9]+|[^\x00-\x60\x7B-\x7F]+", path.lower())]


@dataclass
class Model:
    """Naive Bayes: a weight (logarithm of odds) per host word and path word, and the prior's."""

    host: dict[str, float]
    path: dict[str, float]
    prior: float

    def score(self, host_words: list[str], path: str) -> float:
        odds = self.prior + sum(self.host.get(w, 0.0) for w in host_words)
        odds += sum(self.path.get(w, 0.0) for w in path_words(path))
        return float(1 / (1 + np.exp(-np.clip(odds, -500, 500))))


def fit(rows: list[tuple[list[str], str, int]], blocked_hosts: int, allowed_hosts: int) -> Model:
    """Model from (host words, path, blocked) and the numbers of hosts of each kind."""
    counts = {(kind, y): Counter() for kind in ("host", "path") for y in (0, 1)}
    for host_words, path, blocked in rows:
        counts["host", blocked].update(host_words)
        counts["path", blocked].update(path_words(path))

    def weights(kind: str) -> dict[str, float]:
        good, bad = counts[kind, 0], counts[kind, 1]
        n_good, n_bad = sum(good.values()), sum(bad.values())
        if not n_good or not n_bad:
            return {}
        out = {}
        for w in good.keys() | bad.keys():
            # Each kind's share with the mean share of both kinds as its prior.
            common = SMOOTHING * (good[w] / n_good + bad[w] / n_bad) / 2
            out[w] = float(np.log((bad[w] + common) / (n_bad + SMOOTHING)) - np.log((good[w] + common) / (n_good + SMOOTHING)))
        return out

    prior = float(np.log((blocked_hosts + 1) / (allowed_hosts + 1)))
    return Model(weights("host"), weights("path"), min(prior, 0.0))


def sampled(pages: DataFrame, rows_per_class: int) -> Iterator[tuple[list[str], str, int]]:
    """At most ``rows_per_class`` pages of each kind, by hash of host and path."""
    order = [F.xxhash64("host", "path"), F.col("host"), F.col("path")]
    for blocked in (0, 1):
        picked = pages.filter((F.col("blocked") == blocked) & (F.col("host") != "")).orderBy(*order).limit(rows_per_class)
        for row in picked.select("words", "path").toLocalIterator():
            yield list(row.words), row.path, blocked


def judged(pages: DataFrame, rules: tuple[tuple[str, str], ...], rows_per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, words) of every page."""
    host, path = parts_of(F.col("url"))
    places = pages.select("page_id", host.alias("host"), path.alias("path"))
    hosts = written(places.groupBy("host").agg(F.count("*").alias("n")), "url-hosts")
    counts = written(word_counts(pages, hosts), "url-words")
    has_listed = F.arrays_overlap("words", F.array(*[F.lit(w) for w in BLOCKED_WORDS]))
    named = written(
        segmented(hosts, counts).withColumn("blocked", F.coalesce(has_listed, F.lit(False)).cast("int")), "url-names"
    )
    totals = named.agg(F.sum("n").alias("pages"), F.sum("blocked").alias("bad"), F.count("*").alias("hosts")).first()

    # Hot hosts: fewer than HOT_PARTS, since each holds more than that part of all pages.
    share = F.col("n") * HOT_PARTS / F.lit(totals.pages or 1)
    hot = named.filter(share > 1).select(F.col("host").alias("hot_host"), F.ceil(share).cast("int").alias("lanes"))
    spread = places.join(F.broadcast(hot), F.col("host") == F.col("hot_host"), "left")
    lane = F.when(F.col("lanes") > 1, F.pmod(F.xxhash64("page_id", "path"), F.col("lanes"))).otherwise(0).cast("int")
    spread = spread.select("page_id", "host", "path", lane.alias("lane"))
    in_lanes = named.withColumn("lane", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(share).cast("int"), F.lit(1)) - 1)))
    joined = spread.join(in_lanes.select("host", "lane", "words", "blocked"), ["host", "lane"])
    joined = written(joined.select("page_id", "host", "path", "words", "blocked"), "url-places")

    model = fit(list(sampled(joined, rows_per_class)), totals.bad or 0, (totals.hosts or 0) - (totals.bad or 0))
    shared = pages.sparkSession.sparkContext.broadcast((model, Rules(rules)))

    @F.pandas_udf("struct<rule:string,verdict:string,score:double>")
    def verdicts(host: pd.Series, path: pd.Series, words: pd.Series) -> pd.DataFrame:
        fitted, given = shared.value
        out = []
        for h, p, ws in zip(host, path, words):
            rule, verdict = given.fitting(h, p)
            score = fitted.score(list(ws), p)
            out.append((rule, verdict or ("block" if score >= 0.5 else "allow"), score))
        return pd.DataFrame(out, columns=["rule", "verdict", "score"])

    found = joined.withColumn("found", verdicts("host", "path", "words"))
    return found.select("page_id", "host", "path", "found.rule", "found.verdict", "found.score", "words")
