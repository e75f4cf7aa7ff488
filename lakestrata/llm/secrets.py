"""Secret scans: fixed patterns, and sliding windows of high Shannon entropy, with DataFrame functions only.

Three base patterns find assignments to names like ``token``, access keys and long hexadecimal runs. Beyond them,
each alphabet of ``CLASSES`` has its candidates, the runs of its characters. A window of fixed width slides over a
candidate and keeps the count of every character: one character enters, one leaves, and the sum of
``n * log2(n)`` over the counts changes by two table entries. The entropy is ``log2(width) - sum / width``, so a
window is conspicuous if the sum is at most a limit; overlapping ones make one span. ``n * log2(n)`` is held in
whole numbers, so sums neither drift nor depend on the order. The spans of a candidate on the allow list
(words, numbers, UUIDs, public checksums, alphabets, examples) are suppressed; base spans always stay.

Everything happens inside a row, so no row is moved and no group can be hot. Matches come with the pieces between
them, whose running lengths are the positions; long candidates are taken in stretches that hand on the counts.
A null or empty text has no spans. Rows are judged one by one, so null and repeated ids do not matter. Only the
id and the text are read.
"""

import math
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.frames import table

ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
          r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
#: Characters that the value of an assignment has at least.
ASSIGNED = 8
#: Runs are taken whole, so a shorter one cannot hide a longer one and the length may stand in the pattern.
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
BASE = ("assign", "access", "hex")


class CharClass(NamedTuple):
    """An alphabet whose windows of ``width`` characters are conspicuous from an entropy of ``bits`` on."""

    kind: str
    alphabet: str
    width: int
    bits: float


CLASSES = (
    CharClass("entropy16", "0123456789abcdefABCDEF", 20, 3.2),
    CharClass("entropy64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 24, 4.0),
)
#: Candidates that hold no secret, as patterns for a whole candidate or, without anchors, for any part of it.
ALLOWED = (
    r"^[0-9]+$", r"^[A-Za-z]+([-+/_=]+[A-Za-z]+)*[-+/_=]*$",
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$", r"^sha(1|256|384|512)[-=]",
    r"[Ee][Xx][Aa][Mm][Pp][Ll][Ee]", r"[Aa][Bb][Cc][Dd][Ee][Ff][Gg][Hh][Ii][Jj][Kk][Ll]", r"0123456789",
)
#: Units of the whole numbers that stand for ``n * log2(n)``.
_UNIT = 1 << 20
#: Characters of a candidate that are held one by one at a time, and lengths that are added up together.
STRETCH, TOGETHER = 4096, 256
_SPAN = "struct<start: int, end: int>"
_SPANS = "array<struct<start: int, rank: int, end: int>>"


def n_log_n(n: int) -> int:
    """``n * log2(n)`` in units."""
    return round(n * math.log2(n) * _UNIT) if n else 0


def most_of(kind: CharClass) -> int:
    """The largest sum of a conspicuous window."""
    return math.floor((math.log2(kind.width) - kind.bits) * kind.width * _UNIT)


def pattern_of(kind: CharClass) -> str:
    return f"[{re.escape(kind.alphabet[-5:])}{kind.alphabet[:-5]}]{{{kind.width},}}"


def let(value: Column, body) -> Column:
    """``body(value)``, with the value computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(lengths: Column) -> Column:
    """The sums of the first 1, 2, ... lengths, with work in proportion but for a small factor."""
    def sums(values: Column, first: Column) -> Column:
        return F.slice(F.aggregate(
            values, F.array(first), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n))), 2, TOGETHER)

    groups = F.transform(
        F.sequence(F.lit(0), F.size(lengths) - 1, F.lit(TOGETHER)), lambda at: F.slice(lengths, at + 1, TOGETHER))
    zero = F.lit(0)
    return let(groups, lambda parts: let(
        F.aggregate(parts, F.array(zero), lambda done, part: F.concat(done, F.array(
            F.element_at(done, -1) + F.aggregate(part, zero, lambda a, b: a + b)))),
        lambda before: F.flatten(F.zip_with(parts, F.slice(before, 1, F.size(parts)), sums))))


def matches(text: Column, pattern: str, width: int) -> Column:
    """``start, end, match`` of every match from left to right; code points, the end is exclusive.

    ``width`` is the greatest number of characters in front of which a text cannot match.
    """
    nothing = F.array().cast("array<struct<start: int, end: int, match: string>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(F.length(text) < width, nothing).otherwise(let(found, lambda hits: F.when(
        F.size(hits) == 0, nothing).otherwise(F.zip_with(
            hits, running(F.zip_with(
                hits, F.slice(F.split(text, pattern, -1), 1, F.size(hits)), lambda hit, gap: F.length(gap) + F.length(hit))),
            lambda hit, end: F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("match"))))))


def conspicuous(candidate: Column, kind: CharClass) -> Column:
    """The spans of a candidate that windows of high entropy cover, relative to its start."""
    width, most = kind.width, most_of(kind)
    nobody = F.array_repeat(F.lit(-1), width)
    change = F.array(*[F.lit(n_log_n(n + 1) - n_log_n(n)) for n in range(width + 1)])
    state = F.struct(
        F.array_repeat(F.lit(0), len(kind.alphabet)).alias("counts"), F.lit(0).alias("total"), F.lit(0).alias("seen"),
        F.lit(-1).alias("start"), F.lit(-1).alias("end"), F.array().cast(f"array<{_SPAN}>").alias("done"))

    def closed(s: Column) -> Column:
        return F.when(s["start"] < 0, s["done"]).otherwise(
            F.concat(s["done"], F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))))

    def step(s: Column, moved: Column) -> Column:
        enter, leave = moved["enter"], moved["leave"]
        entered = s["total"] + F.get(change, F.get(s["counts"], enter))
        left = F.when(leave < 0, entered).when(leave == enter, s["total"]).otherwise(
            entered - F.get(change, F.get(s["counts"], leave) - 1))
        counts = F.when(leave == enter, s["counts"]).otherwise(F.transform(
            s["counts"], lambda n, i: n + F.when(i == enter, 1).when(i == leave, -1).otherwise(0)))
        return let(left, lambda total: let(
            (s["seen"] + 1 >= width) & (total <= most), lambda hit: let(
                hit & ((s["start"] < 0) | (s["seen"] + 1 - width > s["end"])), lambda new: F.struct(
                    counts.alias("counts"), total.alias("total"), (s["seen"] + 1).alias("seen"),
                    F.when(new, s["seen"] + 1 - width).otherwise(s["start"]).alias("start"),
                    F.when(hit, s["seen"] + 1).otherwise(s["end"]).alias("end"),
                    F.when(new, closed(s)).otherwise(s["done"]).alias("done")))))

    def stretch(held: Column, at: Column) -> Column:
        codes = F.transform(
            F.filter(F.split(F.substr(candidate, at + 1, F.lit(STRETCH)), "", -1), lambda c: c != ""),
            lambda c: F.instr(F.lit(kind.alphabet), c) - 1)
        return let(codes, lambda entering: let(F.concat(held["tail"], entering), lambda row: F.struct(
            F.aggregate(F.zip_with(
                entering, F.slice(row, 1, F.size(entering)),
                lambda enter, leave: F.struct(enter.alias("enter"), leave.alias("leave"))), held["state"], step).alias("state"),
            F.slice(row, F.lit(-width), F.lit(width)).alias("tail"))))

    return F.aggregate(
        F.sequence(F.lit(0), F.length(candidate) - 1, F.lit(STRETCH)),
        F.struct(state.alias("state"), nobody.alias("tail")), stretch, lambda held: closed(held["state"]))


def entropy_spans(text: Column, kind: CharClass, rank: int, allowed: tuple = ALLOWED) -> Column:
    """Spans of the text that stand out in one character class, without candidates on the allow list."""
    candidates = F.filter(matches(text, pattern_of(kind), kind.width), lambda m: ~m["match"].rlike("|".join(allowed)))
    return F.flatten(F.transform(candidates, lambda m: F.transform(
        conspicuous(m["match"], kind), lambda s: F.struct(
            (m["start"] + s["start"]).alias("start"), F.lit(rank).alias("rank"), (m["start"] + s["end"]).alias("end")))))


def base_spans(text: Column) -> Column:
    """Spans of the three fixed patterns."""
    def of(found: Column, rank: int) -> Column:
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end")))

    assigned = F.filter(matches(text, ASSIGN, 1), lambda m: F.length(F.regexp_extract(m["match"], ASSIGN, 2)) >= ASSIGNED)
    return F.concat(of(assigned, 0), of(matches(text, ACCESS, 16), 1), of(matches(text, HEX, 32), 2))


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes: tuple = CLASSES, allowed: tuple = ALLOWED,
) -> DataFrame:
    """``doc_id, base, found`` of every row: spans (start, rank, end) in order of start, then of the kinds.

    ``rank`` is the number of the kind in ``kinds(classes)``.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    added = [entropy_spans(text, kind, len(BASE) + i, allowed) for i, kind in enumerate(classes)]
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.array_sort(base_spans(text)).alias("base"),
        F.concat(*added, F.array().cast(_SPANS)).alias("added"))
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", "added")).alias("found"))


def kinds(classes: tuple = CLASSES) -> list[str]:
    return [*BASE, *[kind.kind for kind in classes]]


def joined(spans: Column, names: list[str]) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    label = F.array(*[F.lit(name) for name in names])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(label, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes: tuple = CLASSES,
         allowed: tuple = ALLOWED) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``."""
    found, names = find_secrets(docs, id_col, text_col, classes, allowed), kinds(classes)

    def number(rank: int) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")

    return found.select(
        "doc_id", *[number(rank).alias(f"n_{name}") for rank, name in enumerate(BASE)],
        F.sha2(joined(F.col("base"), names).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found"), names).alias("spans"))


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _located(kind: str, rank: int, pattern: str) -> str:
    return f"""
  SELECT '{kind}' AS kind, {rank} AS rank, doc_id, m, e - length(m) AS s, e FROM (
    SELECT doc_id, m, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM (
      SELECT doc_id, unnest(m) AS m, unnest(g[1:len(m)]) AS gap, generate_subscripts(m, 1) AS i FROM (
        SELECT doc_id, regexp_extract_all(text, {_quoted(pattern)}) AS m, string_split_regex(text, {_quoted(pattern)}) AS g FROM t)))"""


def _windows(kind: CharClass) -> str:
    table_ = ", ".join(str(n_log_n(n)) for n in range(1, kind.width + 1))
    return f"""
  SELECT kind, rank, doc_id, s + w AS ws, {kind.width} AS width FROM (
    SELECT kind, rank, doc_id, s, w, c, count(*) AS n FROM (
      SELECT *, substr(m, w + unnest(range(1, {kind.width + 1})), 1) AS c FROM (
        SELECT *, unnest(range(0, length(m) - {kind.width - 1})) AS w FROM allowed WHERE kind = '{kind.kind}'))
    GROUP BY ALL)
  GROUP BY kind, rank, doc_id, s, w HAVING sum([{table_}][n]) <= {most_of(kind)}"""


ORACLE = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
base AS (SELECT * FROM ({_located("assign", 0, ASSIGN)}) WHERE length(regexp_extract(m, {_quoted(ASSIGN)}, 2)) >= {ASSIGNED}
  UNION ALL {_located("access", 1, ACCESS)} UNION ALL {_located("hex", 2, HEX)}),
allowed AS (SELECT * FROM ({" UNION ALL ".join(_located(k.kind, 3 + i, pattern_of(k)) for i, k in enumerate(CLASSES))})
  WHERE NOT regexp_matches(m, {_quoted("|".join(ALLOWED))})),
flagged AS ({" UNION ALL ".join(_windows(kind) for kind in CLASSES)}),
islands AS (SELECT *, sum(CASE WHEN ws <= before + width THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, kind ORDER BY ws) AS island
  FROM (SELECT *, lag(ws) OVER (PARTITION BY doc_id, kind ORDER BY ws) AS before FROM flagged)),
found AS (
  SELECT kind, rank, doc_id, s, e, true AS base FROM base
  UNION ALL
  SELECT kind, rank, doc_id, min(ws), max(ws) + any_value(width), false FROM islands GROUP BY kind, rank, doc_id, island),
j AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, rank) FILTER (base) AS base,
    string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, rank) AS spans
  FROM found GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN j USING (doc_id)"""


def query(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"))
