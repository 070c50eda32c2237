"""Secret scan: pattern matches, and random-looking strings by two Markov models.

Native: DataFrame expressions only. Three patterns give the base spans. Runs of
20 or more key characters, a digit among them (names in mixed case have none),
that no base span touches are candidates; each is
scored by the log-likelihood ratio of two first-order character models, one of
random strings and one of ordinary identifiers, and added as kind ``random``
where the ratio reaches ``MIN_RATIO``.

The models are trained from labelled samples. A run of 12 or more key characters
in the corpus is random where it lies in a base span, ordinary elsewhere if it
has no digit or no letter; the others carry no label, so that no string is
judged by a model that has learned it as ordinary. Random samples of known origin (``SYNTHETIC`` digests in base 64,
so that letters outside hexadecimal are seen) are added. Only the transition
counts, at most one row for each pair of the alphabet's 67 characters, come to
the driver.

Spans are in code points, end exclusive. Null and empty texts have no spans;
repeated rows stay; input columns named like an output column are replaced.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh_name, table

# The base patterns (group 2 of assign has 8 characters or more).
ASSIGN = (r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
          r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")

ALPHABET = 67                       # [A-Za-z0-9_+/=-]
SAMPLE = r"[A-Za-z0-9_+/=-]{12,}"   # labelled samples
CANDIDATE = r"[A-Za-z0-9_+/=-]{20,}"
#: Tried only where a run starts: the same runs, found sooner.
RUN_START = r"(?<![A-Za-z0-9_+/=-])"
SYNTHETIC = 4096
MIN_RATIO = 15.0                    # nats
REDACTED = "[SECRET]"


NONE = "cast(array() as array<struct<s:int,e:int,k:int>>)"


def _let(value: Column, then) -> Column:
    """``then`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _walk(items: Column, empty: str, step) -> Column:
    """Parts (at, out) of a walk through ``items`` from place 0: ``step(at, item)`` gives the
    next place and an array to put out. The walk goes in blocks of about the root of the number
    of items, so that no long array is copied for each item."""
    begin = lambda at: F.struct(at.alias("at"), F.expr(empty).alias("out"))
    side = lambda xs: F.greatest(F.ceil(F.sqrt(F.size(xs))).cast("int"), F.lit(1))
    blocks = _let(items, lambda xs: F.transform(
        F.sequence(F.lit(0), F.floor(F.greatest(F.size(xs) - 1, F.lit(0)) / side(xs)).cast("int")),
        lambda i: F.slice(xs, i * side(xs) + 1, side(xs))))

    def put(acc: Column, x: Column) -> Column:
        at, out = step(acc["at"], x)
        return F.struct(at.alias("at"), F.concat(acc["out"], out).alias("out"))

    return F.aggregate(blocks, F.array(begin(F.lit(0))), lambda acc, block: F.concat(
        acc, F.array(F.aggregate(block, begin(F.element_at(acc, -1)["at"]), put))))


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (s, e, v, own): the matches, and how long their ``group`` is."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), F.length)
    own = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found, F.length)
    steps = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("v"), own.alias("own"))

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        start, end = at + x["gap"], at + x["gap"] + F.length(x["v"])
        return end, F.array(F.struct(start.alias("s"), end.alias("e"), x["v"].alias("v"), x["own"].alias("own")))

    empty = "cast(array() as array<struct<s:int,e:int,v:string,own:int>>)"
    walked = F.flatten(F.transform(_walk(steps, empty, step), lambda part: part["out"]))
    return F.when(text.rlike(pattern), walked).otherwise(F.expr(empty))


def _placed(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Array of (s, e, k) of the matches; of those whose ``group`` has ``least`` characters."""
    found = _matches(text, pattern, group)
    return F.transform(F.filter(found, lambda x: x["own"] >= least) if least else found,
                       lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("k")))


def base_spans(text: Column) -> Column:
    """All base spans of a text, by start, then kind."""
    return F.array_sort(F.concat(
        _placed(text, ASSIGN, 0, group=2, least=8), _placed(text, ACCESS, 1), _placed(text, HEX, 2)))


def _overlaps(spans: Column, run: Column) -> Column:
    """Whether a run overlaps one of ``spans`` (in order, disjoint): halving
    finds the first that ends after the run's start."""
    def halve(a: Column, _: Column) -> Column:
        middle = F.shiftright(a["lo"] + a["hi"], 1)
        return F.when(a["lo"] >= a["hi"], a).when(
            F.get(spans, middle)["e"] > run["s"], F.struct(a["lo"].alias("lo"), middle.alias("hi"))).otherwise(
            F.struct((middle + 1).alias("lo"), a["hi"].alias("hi")))

    first = F.aggregate(F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + 1)).cast("int")),
                        F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi")), halve, lambda a: a["lo"])
    return F.coalesce(F.get(spans, first)["s"] < run["e"], F.lit(False))


def _runs(text: Column, base: Column, pattern: str) -> Column:
    """(s, e, v, touched): runs, and whether a base span touches each."""
    kind = lambda k: F.filter(base, lambda x: x["k"] == k).alias(KINDS[k])
    return _let(F.struct(kind(0), kind(1), kind(2)), lambda spans: F.transform(
        _matches(text, RUN_START + pattern), lambda r: F.struct(
            r["s"].alias("s"), r["e"].alias("e"), r["v"].alias("v"),
            (_overlaps(spans[KINDS[0]], r) | _overlaps(spans[KINDS[1]], r) | _overlaps(spans[KINDS[2]], r)).alias("touched"))))


def samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """(sample, is_random) from the corpus and of known origin."""
    t = F.coalesce(F.col(text), F.lit(""))
    spans, run = fresh_name(docs, "spans"), fresh_name(docs, "run")
    own = (docs.select(t.alias(text)).filter(F.col(text).rlike(RUN_START + SAMPLE))
           .withColumn(spans, base_spans(F.col(text)))
           .select(text, F.explode(_runs(F.col(text), F.col(spans), SAMPLE)).alias(run))
           .select(F.col(run)["v"].alias("sample"), F.col(run)["touched"].alias("is_random"))
           .filter(F.col("is_random") | ~F.col("sample").rlike("[0-9]") | ~F.col("sample").rlike("[A-Za-z]")))
    made = docs.sparkSession.range(SYNTHETIC).select(
        F.base64(F.unhex(F.sha2(F.concat(F.lit("sample "), F.col("id").cast("string")), 256))).alias("sample"),
        F.lit(True).alias("is_random"))
    return own.union(made)


def train(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratio of each transition, at 128 * first + second, from
    (sample, is_random) rows: counts with one added for each character."""
    pairs = labelled.filter(F.length("sample") > 1).select(
        "is_random", F.explode(F.transform(
            F.sequence(F.lit(1), F.length("sample") - 1), lambda i: F.col("sample").substr(i, F.lit(2)))).alias("pair"))
    counts = {(r["is_random"], r["pair"]): r["n"] for r in pairs.groupBy("is_random", "pair").agg(F.count("*").alias("n")).collect()}
    first: dict = {}
    for (kind, pair), n in counts.items():
        first[kind, pair[0]] = first.get((kind, pair[0]), 0) + n
    log_p = lambda kind, a, b: math.log((counts.get((kind, a + b), 0) + 1) / (first.get((kind, a), 0) + ALPHABET))
    return [log_p(True, chr(i >> 7), chr(i & 127)) - log_p(False, chr(i >> 7), chr(i & 127)) for i in range(128 * 128)]


def ratio(value: Column, model: Column) -> Column:
    """Log-likelihood ratio of an ASCII string of two characters or more."""
    return F.aggregate(
        F.sequence(F.lit(1), F.length(value) - 1), F.lit(0.0),
        lambda acc, i: acc + F.get(model, F.ascii(value.substr(i, F.lit(1))) * 128 + F.ascii(value.substr(i + 1, F.lit(1)))))


def scan(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with an array of (s, e, k) spans, by start, then kind (KINDS[k])."""
    model = F.lit(train(samples(docs, text)))
    docs = docs.drop(spans) if spans != text else docs
    base = fresh_name(docs, "base_spans")
    t = F.coalesce(F.col(text), F.lit(""))
    added = F.when(t.rlike(RUN_START + CANDIDATE), F.transform(
        F.filter(_runs(t, F.col(base), CANDIDATE), lambda r: ~r["touched"] & r["v"].rlike("[0-9]") & (ratio(r["v"], model) >= MIN_RATIO)),
        lambda r: F.struct(r["s"].alias("s"), r["e"].alias("e"), F.lit(3).alias("k"))))
    return (docs.withColumn(base, base_spans(t))
            .withColumn(spans, F.array_sort(F.concat(F.col(base), F.coalesce(added, F.expr(NONE)))))
            .drop(base))


def redact(scanned: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``scanned`` with REDACTED in place of every span (overlapping ones count as one)."""
    none = "cast(array() as array<string>)"
    walked = _walk(F.col(spans), none, lambda at, x: (F.greatest(at, x["e"]), F.when(x["s"] >= at, F.array(
        F.col(text).substr(at + 1, x["s"] - at), F.lit(REDACTED))).otherwise(F.expr(none))))
    cut = _let(walked, lambda parts: F.concat(
        F.array_join(F.flatten(F.transform(parts, lambda part: part["out"])), ""),
        F.col(text).substr(F.element_at(parts, -1)["at"] + 1, F.length(F.col(text)))))
    return scanned.withColumn(text, F.when(F.size(spans) > 0, cut).otherwise(F.col(text)))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def op9_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    count = lambda k: F.size(F.filter("spans", lambda x: x["k"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(F.filter("spans", lambda x: x["k"] < 3)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))
