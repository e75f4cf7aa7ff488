"""URL filter: rules for hosts and paths, and for the rest a logistic regression on hashed character n-grams.

The regression is fitted on a small labelled table, and the probability from which on it blocks is chosen on rows of
that table that were held out. A null address, or one without ``://``, has an empty host and path. Equal rows
are judged alike; an empty table has no rows. The number of labelled addresses is the size of the table given.
"""

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.frames import lower_ascii, plain_names, table
from lakestrata.session import work_folder

#: (verdict, host and the beginning of the path). A rule holds for the host and all of its subdomains.
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
    ("block", "com/de/"))
GRAMS = (3, 4, 5)
BUCKETS = 1 << 17
#: Share of the ordinary held-out addresses that the limit for blocking may cost; one host in so many is held out.
SPARED, HELD_OUT = 0.01, 4
#: The ridge penalty; the number of addresses is small against that of n-grams.
PENALTY = 0.01
STEPS = 50

#: Words of addresses to block and of ordinary ones, by kind of site. The labelled table combines them by a rule.
BLOCKED_WORDS = {
    "gambling": "casino poker slots bets betting jackpot roulette lottery bingo wager blackjack gamble",
    "adult": "adult porn xxx sex cams escort nude erotic fetish milf hentai",
    "pharmacy": "pills viagra cialis meds pharma drugs tablets steroids tramadol",
    "spam": "spam linkfarm bulkmail backlinks mailblast spammer junkmail",
    "advertising": "ads adserver track tracker banner popup pixel clicks affiliate doubleclick",
    "fraud": "crack keygen warez torrent replica fake payday loans prize winner hack cheat",
}
BAIT = "free best hot cheap win online bonus top buy fast deal 24 club king zone vip now instant super mega easy direct discount"
ORDINARY_WORDS = {
    "learning": "school college university library history science physics chemistry biology lesson museum archive dictionary student",
    "home": "garden kitchen recipe furniture cooking family mother children house baking pottery flower window table",
    "food": "bread cheese coffee dinner fruit vegetable butter restaurant breakfast potato soup wine",
    "nature": "forest lake ocean valley desert weather winter summer autumn animal bird horse river mountain island",
    "news": "news politics journal magazine gazette herald times radio report daily opinion interview",
    "places": "city town harbour village station airport bridge castle travel hotel street market square region",
    "work": "office company finance insurance bank industry engineering software project consulting factory employment",
    "leisure": "music theatre cinema football cycling hiking camping chess sailing photography books painting dance",
    "public": "council hospital police parliament ministry court church charity embassy railway education health",
    "words": "answer brother change different everything father great hundred important letter morning number other people question thing",
}
COMPANIONS = "green old north central little national modern open world blue royal union first our spring stone west guide forum"
PREFIXES, ENDINGS = ("", "www.", "m.", "blog."), ("com", "org", "net")
PATHS = ("/en/{n}", "/fr/{n}.html", "/de/{n}/", "/es/{n}", "/", "/index.html", "/page/{n}", "/{word}/{n}")


def labelled_table() -> tuple[tuple[str, int], ...]:
    """Addresses under names reserved for examples: (url, 1 to block). Every word comes with several companions.

    What surrounds the words (subdomains, endings, paths) is dealt out alike to both kinds, so only words tell.
    """
    rows = []
    for label, words, others, each in ((1, BLOCKED_WORDS, BAIT, 5), (0, ORDINARY_WORDS, COMPANIONS, 5)):
        companions = others.split()
        for kind in words.values():
            for word in kind.split():
                for i in range(each):
                    n = len(rows)
                    other = companions[(n * 7 + i) % len(companions)]
                    name = (word, f"{word}-{other}", f"{other}-{word}", f"{other}{word}")[(i + n) % 4]
                    path = PATHS[n % len(PATHS)].format(n=n * 37 % 9001, word=word)
                    rows.append((f"https://{PREFIXES[n % 4]}{name}.example.{ENDINGS[n % 3]}{path}", label))
    return tuple(rows)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both are empty without ``://``, and for null."""
    place = F.locate("://", url)
    rest = F.when(place > 0, F.substring(url, place + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)?", 1)


def matching_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none does. Of equal lengths the first given wins."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(reversed(rules), key=lambda r: len(r[1])):  # the last that fits stays
        rule_host, _, rest = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        name, verdict = F.when(fits, text).otherwise(name), F.when(fits, said).otherwise(verdict)
    return name, verdict


def grams(text: Column, lengths: tuple = GRAMS) -> Column:
    """All character n-grams of the text between marks for its ends, and the whole of it; for empty text the two marks."""
    marked = F.concat(F.lit("^"), text, F.lit("$"))
    size = F.length(marked)

    def of(n: int) -> Column:
        return F.when(size >= n, F.transform(
            F.sequence(F.lit(1), size - n + 1), lambda place: F.substring(marked, place, F.lit(n)))).otherwise(
            F.array().cast("array<string>"))

    return F.concat(F.array(marked), *[of(n) for n in lengths])


def features(urls: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``features`` from the columns ``host`` and ``path``: n-grams of either, told apart by a letter, in ``2 * buckets``."""
    def of(part: str) -> Column:
        return F.transform(grams(F.col(part)), lambda gram: F.concat(F.lit(part[0]), gram))

    both = F.concat(of("host"), of("path"))
    return HashingTF(inputCol="url_grams", outputCol="features", numFeatures=2 * buckets, binary=True).transform(
        urls.withColumn("url_grams", both)).drop("url_grams")


@dataclass
class UrlModel:
    """A fitted regression, and the probability from which on it blocks."""

    regression: LogisticRegressionModel
    limit: float


def _scores(weights: np.ndarray, rows: list[list[int]]) -> np.ndarray:
    """Sums of the weights of each row's features, and the last weight, the intercept. Every row has a feature."""
    starts = np.cumsum([0, *map(len, rows)])[:-1]
    return np.add.reduceat(weights[np.concatenate(rows).astype(np.int64)], starts) + weights[-1]


def small_fit(rows: list[list[int]], labels: np.ndarray, size: int, penalty: float, steps: int = 150) -> np.ndarray:
    """The weights of the same ridge regression for a few rows of binary features, by accelerated gradient steps."""
    flat, lengths = np.concatenate(rows).astype(np.int64), list(map(len, rows))
    ridge = np.append(np.full(size, penalty), 0.0)
    rate = 1 / (0.25 * (max(lengths) + 1) + penalty)  # the curvature is at most its inverse
    weights, ahead, momentum = np.zeros(size + 1), np.zeros(size + 1), 1.0
    for _ in range(steps):
        wrong = (1 / (1 + np.exp(-_scores(ahead, rows))) - labels) / len(rows)
        slope = np.append(np.bincount(flat, np.repeat(wrong, lengths), size), wrong.sum()) + ridge * ahead
        step, faster = ahead - rate * slope, (1 + math.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead = step + (momentum - 1) / faster * (step - weights)
        weights, momentum = step, faster
    return weights


def held_out_limit(
    rows: list[list[int]], labels: np.ndarray, held: np.ndarray, size: int, penalty: float, spared: float = SPARED,
) -> float:
    """The probability that a share of ``spared`` of the held-out ordinary rows reaches in a regression without held-out rows.

    It is one half at least, so that an address of which nothing is known stays.
    """
    seen, judged = np.flatnonzero(~held), np.flatnonzero(held & (labels == 0))
    if not len(seen) or not len(judged):
        return 0.5
    weights = small_fit([rows[i] for i in seen], labels[seen], size, penalty)
    found = np.sort(1 / (1 + np.exp(-_scores(weights, [rows[i] for i in judged]))))[::-1]
    return max(0.5, float(found[int(spared * len(found))]))


def train(
    spark: SparkSession, labelled: tuple | None = None, buckets: int = BUCKETS, penalty: float = PENALTY,
) -> UrlModel:
    """A ridge regression on a small table of (url, 1 to block), with its limit from held-out hosts of that table."""
    given = [(u, float(y)) for u, y in (labelled_table() if labelled is None else labelled)]
    urls = spark.createDataFrame(given, "url string, label double")
    host, path = url_parts(F.col("url"))
    rows = features(urls.select(host.alias("host"), path.alias("path"), "label").coalesce(1), buckets).cache()
    fitted = LogisticRegression(regParam=penalty, maxIter=STEPS, tol=1e-6, standardization=False).fit(rows)
    # the labelled table is small
    given = rows.select("features", "label", (F.pmod(F.xxhash64("host"), F.lit(HELD_OUT)) == 0).alias("held")).collect()
    rows.unpersist()
    limit = held_out_limit([r.features.indices.tolist() for r in given], np.array([r.label for r in given]),
                           np.array([r.held for r in given], bool), 2 * buckets, penalty)
    # a fitted model drags its training summary, and with it the session, into every task; a stored one does not
    path = work_folder(spark, "url-model")
    fitted.write().save(path)
    return UrlModel(LogisticRegressionModel.load(path), limit)


def judge_urls(
    pages: DataFrame, model: UrlModel, url_col: str = "url", rules: tuple = RULES, buckets: int = BUCKETS,
) -> DataFrame:
    """Adds ``host, path, rule, verdict, p_block``, replacing such columns. ``p_block`` is the model's probability.

    A row without a usable address has no host and is judged by the model alone, as an empty address. Other columns
    stay whatever their names are.
    """
    added = ["host", "path", "rule", "verdict", "p_block"]
    inner, named = plain_names(pages)
    host, path = url_parts(F.col(named[url_col]))
    parts = features(inner.withColumns({"host": host, "path": path}), buckets)
    scored = model.regression.transform(parts).withColumn("p_block", vector_to_array("probability")[1])
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("p_block") >= model.limit, "block").otherwise("allow")
    judged = scored.withColumns({"rule": rule, "verdict": F.coalesce(verdict, learned)})
    kept = [(new, old) for old, new in named.items() if old.lower() not in added or old == url_col]
    return judged.select(*[F.col(new).alias(old) for new, old in kept], *[c for c in added if c != url_col])


def query(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), train(spark)).drop("url")
