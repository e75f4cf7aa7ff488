"""Quality rules judged by host, with DataFrame functions only.

Every document is measured and held against a few rules. The share of a host's documents that fail is shrunk
toward the share of all hosts with a beta prior that is fitted to the hosts (method of moments), so a host with
few documents is not judged by chance. The host's verdict goes back to its documents: a trusted host keeps all
of them, a watched host keeps those that fail no rule, a condemned host keeps none. Documents that fail the base
rule always go. The corpus names a ``source`` for each document, which is taken as its host.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.frames import stored, table
from lakestrata.llm.tokens import SPACE_RUN, SPACES

SYMBOLS = "#*$%&|<>"
WINDOW = 3
LEAST_WORDS, MOST_REPEATED = 50, 50
#: A document fails if it has more symbols per hundred words, or more repeated lines per hundred, than this.
MOST_SYMBOLS, MOST_DUP_LINES = 10, 30
#: Mean characters of a word outside of these bounds are a failure, too.
LEAST_MEAN, MOST_MEAN = 2, 15
#: Shrunk failure rates of a host from which it is watched, and condemned.
WATCHED, CONDEMNED = 0.01, 0.6
#: Weight of the prior, in documents, if the hosts' rates do not tell one.
LEAST_PRIOR, MOST_PRIOR = 1.0, 1000.0


def _repeated_positions(sorted_windows: Column) -> Column:
    """Places of the windows whose hash another window of the text has, in order. Windows are (hash, place)."""
    def same(x: Column, i: Column, step: int) -> Column:
        return F.get(sorted_windows, i + step)["h"] == x["h"]

    twice = F.filter(sorted_windows, lambda x, i: F.coalesce(same(x, i, -1), F.lit(False))
                     | F.coalesce(same(x, i, 1), F.lit(False)))
    return F.sort_array(F.transform(twice, lambda x: x["i"]))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``doc_id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words``; null text is empty.

    ``n_lines`` counts the lines with a word. Words of repeated windows are counted once each.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), text.alias("text"))
    split = read.select(
        "doc_id", "host", F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0).alias("lines"),
        F.filter(F.split("text", SPACE_RUN), lambda word: word != "").alias("words"))
    words = F.col("words")
    n = F.size(words)
    windows = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.struct(F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]).alias("h"), i.alias("i"))))
    found = split.select(
        "doc_id", "host", "word_chars", "n_symbols", n.cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(windows).alias("windows"))
    placed = found.withColumn("places", _repeated_positions(F.col("windows"))).drop("windows")
    # each window adds the words that the one before does not reach
    start = F.struct(F.lit(0).alias("covered"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate("places", start, lambda s, x: F.struct(
        (s["covered"] + F.least(F.lit(WINDOW), x - s["last"])).alias("covered"), x.alias("last")))
    return placed.withColumn("n_repeat_words", F.coalesce(covered["covered"], F.lit(0)).cast("long")).drop("places")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def rule_failed() -> Column:
    """Any of the rules, the base rule among them."""
    return (
        base_failed() | (100 * F.col("n_symbols") > MOST_SYMBOLS * F.col("n_words"))
        | (100 * F.col("n_dup_lines") > MOST_DUP_LINES * F.col("n_lines"))
        | (F.col("word_chars") < LEAST_MEAN * F.col("n_words")) | (F.col("word_chars") > MOST_MEAN * F.col("n_words")))


def host_verdicts(measured: DataFrame) -> DataFrame:
    """``host, rate, verdict``: the shrunk failure rate and trusted, watched or condemned. Null is a host, too.

    With the mean ``m`` and the variance ``v`` of the hosts' rates (hosts by their documents), the prior weighs
    ``m * (1 - m) / v - 1`` documents, of which the share ``m`` fails.
    """
    hosts = stored(measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(rule_failed()).alias("failed")), "hosts")
    moments = hosts.agg(
        (F.sum("failed") / F.sum("n")).alias("m"),
        (F.sum(F.col("failed") * F.col("failed") / F.col("n")) / F.sum("n")).alias("square"))
    m, square = moments.select("m").scalar(), moments.select("square").scalar()
    weighed = hosts.select("host", "n", "failed", m.alias("m"), (square - m * m).alias("v"))
    weight = F.when(F.col("v") > 1e-12, F.greatest(F.lit(LEAST_PRIOR), F.least(
        F.lit(MOST_PRIOR), F.col("m") * (1 - F.col("m")) / F.col("v") - 1))).otherwise(F.lit(MOST_PRIOR))
    rate = (F.col("failed") + F.col("m") * weight) / (F.col("n") + weight)
    verdict = F.when(F.col("rate") >= CONDEMNED, "condemned").when(F.col("rate") >= WATCHED, "watched").otherwise("trusted")
    return weighed.select("host", rate.alias("rate")).withColumn("verdict", verdict)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """A row per document: the measures, ``base_failed``, the host's ``rate`` and ``verdict``, and ``kept``."""
    measured = stored(measure(docs, id_col, text_col, host_col), "quality-measures")
    hosts = host_verdicts(measured).withColumnRenamed("host", "of_host")
    judged = measured.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).drop("of_host")
    kept = (F.col("verdict") == "trusted") | ((F.col("verdict") == "watched") & ~rule_failed())
    return judged.withColumns({"base_failed": base_failed(), "kept": ~base_failed() & kept})


ORACLE = r"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
grams AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + 2), ' ') AS g
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS i FROM w WHERE len(words) >= 3)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM twice)
  GROUP BY doc_id),
m AS (
  SELECT w.doc_id, source, len(words) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id)),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
r AS (
  SELECT *, base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS failed FROM f),
hosts AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (failed) AS DOUBLE) AS k FROM r GROUP BY source),
prior AS (SELECT sum(k) / sum(n) AS m, sum(k * k / n) / sum(n) - (sum(k) / sum(n)) * (sum(k) / sum(n)) AS v FROM hosts),
rates AS (
  SELECT source, (k + m * s) / (n + s) AS rate FROM hosts, (
    SELECT m, CASE WHEN v > 1e-12 THEN greatest(1.0, least(1000.0, m * (1 - m) / v - 1)) ELSE 1000.0 END AS s FROM prior))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (rate < 0.01 OR rate < 0.6 AND NOT failed) AS kept
FROM r JOIN rates ON r.source IS NOT DISTINCT FROM rates.source"""


def query(spark, sf_dir):
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
