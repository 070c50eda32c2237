"""Document quality by a linear-chain conditional random field over lines.

Every line of a text is labelled good or bad. A line's features are its own and
those of its neighbours; a table of moves ties the labels of lines that follow
each other. Forward-backward gives each line's probability of being good, the
mean of these, weighted by line length, is the document's raw score, and a
logistic curve fitted on the training documents makes it a probability of
label 1.

Training takes a bounded sample of labelled documents, at most ``SAMPLE`` of
either label, chosen by a hash of the id, and of these as many as have ``LINES``
lines together (a document that would go over it is left out of the sample);
each line takes its document's label.
Conditional likelihood is climbed from the lines' marginals. Features come from
the text alone, never from labels, lang, source or ids.

A line is what stands between line feeds, if it isn't blank; a text without one
(null, empty) has a single empty line. Labels that are null, or differ for one
id, don't train. With one label only, the score is that label's share.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import crc_mod5, table, with_outputs
from .hmm_scores import by_step

SAMPLE = 3000
LINES = 150_000
STEPS = 250
RATE = 0.05
RIDGE = 1e-3
THRESHOLD = 0.3
HELD_LINES = 200_000

#: Frequent words of the four languages.
STOP = frozenset(
    "a and are as at be by for from has he in is it not of on or that the this to was were which with you "
    "au aux ce dans de des du elle en est et il je la le les mais ne nous ou par pas plus pour que qui sur un une vous "
    "als auch auf aus bei das dem den der die ein eine es für ich im ist mit nicht sich sie sind und von war wie zu "
    "al como con del el ella entre era es esta este fue ha las los más muy no o para pero por se si sin son su una y".split())
UPPER = bytes(range(65, 91))
DIGIT = bytes(range(48, 58))
LETTER = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
SYMBOL = b"#$%&*+<=>@\\^_`{}~"
BARS = b"|"
SPACE = b" \t\r"


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(features by line, line lengths in code points)."""
    lines = [x for x in (text or "").split("\n") if x.strip()] or [""]
    seen: dict[str, int] = {}
    rows = []
    for x in lines:
        raw = x.encode()
        n, size = max(1, len(raw)), len(raw)
        count = lambda drop: (size - len(raw.translate(None, drop))) / n
        words = x.lower().split()
        k = max(1, len(words))
        distinct = len(set(words))
        rows.append((
            math.log1p(len(x)), math.log1p(len(words)), min(30.0, len(x) / k), distinct / k, math.log1p(len(words) - distinct),
            count(UPPER), count(DIGIT), count(LETTER), count(SYMBOL), count(BARS), count(SPACE), count(b"!?"), count(b".,;:"),
            sum(map(STOP.__contains__, words)) / k, sum(a == b for a, b in zip(words, words[1:])) / k,
            x.rstrip()[-1:] in ".!?" if x else 0.0, x.lstrip()[:1].isupper(), min(3, seen.get(x, 0))))
        seen[x] = seen.get(x, 0) + 1
    own = np.array(rows, np.float64)
    none = np.zeros((1, own.shape[1]))
    edge = np.zeros((len(own), 3))
    edge[:, 0], edge[0, 1], edge[-1, 2] = 1, 1, 1
    return (np.concatenate([own, np.concatenate([none, own[:-1]]), np.concatenate([own[1:], none]), edge], 1),
            np.array([max(1, len(x)) for x in lines], np.float64))


def marginals(odds: np.ndarray, move: np.ndarray, at: np.ndarray, begin: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each line is good, and the expected moves, given each
    line's own log odds, the log weights of moves, and ``by_step``'s layout."""
    e = 1 / (1 + np.exp(-np.clip(odds[at], -30, 30)))
    e = np.stack([1 - e, e], 1)
    m = np.exp(move - move.max())
    a, scale = np.empty_like(e), np.empty(len(e))
    for t in range(len(begin) - 1):
        s, end = begin[t], begin[t + 1]
        x = e[s:end] if t == 0 else (a[begin[t - 1] : begin[t - 1] + end - s] @ m) * e[s:end]
        scale[s:end] = x.sum(1)
        a[s:end] = x / scale[s:end, None]
    b, moves = np.ones((begin[1], 2)), np.zeros((2, 2))
    for t in range(len(begin) - 2, -1, -1):
        s, end = begin[t], begin[t + 1]
        if t < len(begin) - 2:
            j = begin[t + 2] - end
            x = e[end : end + j] * b[:j] / scale[end : end + j, None]
            moves += (a[s : s + j].T @ x) * m
            b[:j] = x @ m.T
        a[s:end] *= b[: end - s]
    p = np.empty(len(odds))
    p[at] = a[:, 1] / a.sum(1)
    return p, moves


def layout(sizes: list[int]) -> tuple[np.ndarray, list[int]]:
    ends = np.cumsum(sizes)
    _, at, begin = by_step([np.arange(e - n, e) for n, e in zip(sizes, ends)])
    return at, begin


class Field:
    """The fitted model."""

    def __init__(self, docs: list[tuple[np.ndarray, np.ndarray]], labels: list[int], share: float):
        """share: of label 1 among all training documents, whatever the sample's."""
        self.share = share
        self.fitted = len(set(labels)) == 2
        if not self.fitted:
            return
        x = np.concatenate([d[0] for d in docs])
        sizes = [len(d[0]) for d in docs]
        y = np.repeat(np.array(labels, float), sizes)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        self.mean[-3], self.scale[-3] = 0, 1                            # the constant
        x = self.scaled(x)
        at, begin = layout(sizes)
        # A document counts once however many lines it has, and both labels alike.
        k = np.array(labels)
        per_doc = np.where(k == 1, 0.5 / k.sum(), 0.5 / (len(k) - k.sum())) / np.array(sizes)
        weight = np.repeat(per_doc, sizes)
        self.w, self.move = np.zeros(x.shape[1]), np.zeros((2, 2))
        # Steps by Adam's rule; the moves' gradient is taken over all documents alike.
        told = np.zeros((2, 2))
        for n, lab in zip(sizes, labels):
            told[lab, lab] += n - 1
        first, second = np.zeros(len(self.w) + 4), np.zeros(len(self.w) + 4)
        for i in range(1, STEPS + 1):
            p, moves = marginals(x @ self.w, self.move, at, begin)
            g = np.concatenate([x.T @ (weight * (y - p)) - RIDGE * self.w, ((told - moves) / max(1.0, told.sum()) - RIDGE * self.move).ravel()])
            first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
            step = RATE * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.99**i)) + 1e-8)
            self.w = self.w + step[:-4]
            self.move = np.clip(self.move + step[-4:].reshape(2, 2), -4, 4)
        raw = self.raw([d[0] for d in docs], [d[1] for d in docs])
        # The curve: logistic in the raw log odds, documents weighted to the labels' true shares.
        z = np.stack([np.ones(len(raw)), self.logit(raw)], 1)
        v = np.where(k == 1, share / k.mean(), (1 - share) / (1 - k.mean()))
        c = np.array([0.0, 0.5])
        for _ in range(50):
            q = 1 / (1 + np.exp(-np.clip(z @ c, -30, 30)))
            h = (z * (v * q * (1 - q))[:, None]).T @ z + 1e-3 * len(z) * np.eye(2) * [0, 0.01]
            c = c + np.linalg.solve(h + 1e-9 * np.eye(2), z.T @ (v * (k - q)) - 1e-5 * len(z) * c * [0, 1])
            c[1] = max(c[1], 0.01)
        self.curve = c

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    @staticmethod
    def logit(p: np.ndarray) -> np.ndarray:
        p = np.clip(p, 1e-4, 1 - 1e-4)
        return np.log(p / (1 - p))

    def raw(self, xs: list[np.ndarray], lengths: list[np.ndarray]) -> np.ndarray:
        """Length-weighted marginals of whole documents."""
        sizes = [len(x) for x in xs]
        at, begin = layout(sizes)
        p, _ = marginals(self.scaled(np.concatenate(xs)) @ self.w, self.move, at, begin)
        n = np.concatenate(lengths)
        starts = np.cumsum(sizes) - sizes
        return np.add.reduceat(p * n, starts) / np.add.reduceat(n, starts)

    def score(self, xs: list[np.ndarray], lengths: list[np.ndarray]) -> np.ndarray:
        if not self.fitted:
            return np.full(len(xs), self.share)
        z = self.curve[0] + self.curve[1] * self.logit(self.raw(xs, lengths))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def within(sizes: list[tuple[int, int, int]], most: int) -> list[int]:
    """Of (id, label, lines), the ids taken one after the other while each label's lines stay within ``most``."""
    total: dict[int, int] = {}
    out = []
    for doc_id, label, n in sizes:
        if total.get(label, 0) + n <= most:
            total[label] = total.get(label, 0) + n
            out.append(doc_id)
    return out


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, lines: int = LINES) -> Field:
    """Fits the field on ``docs`` (doc_id, text) and ``labels`` (doc_id, quality)."""
    told = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id")
            .agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).filter("quality = most")
            .select("doc_id", "quality", F.xxhash64("doc_id").alias("h")))
    share = told.agg(F.avg("quality")).first()[0]
    some = [told.filter(F.col("quality") == q).orderBy("h", "doc_id").limit(sample) for q in (0, 1)]
    # At most 2 * sample rows of three numbers.
    chosen = F.broadcast(some[0].union(some[1]))
    rows = (docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id", "quality", "h")
            .agg(F.min("text").alias("text")))
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n"))
    sizes = rows.select("doc_id", "quality", n_lines.alias("n"), "h").collect()
    taken = within([(r.doc_id, r.quality, r.n) for r in sorted(sizes, key=lambda r: (r.h, r.doc_id))], lines)
    if len(taken) < len(sizes):
        rows = rows.join(F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in taken], "doc_id long")), "doc_id", "left_semi")
    rows = rows.select("doc_id", "quality", "text")
    schema = "doc_id long, quality int, n int, x binary, length binary"
    arrow = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("n", pa.int32()), ("x", pa.binary()), ("length", pa.binary())])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [line_features(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column(0).cast(pa.int64()), b.column(1).cast(pa.int32()), pa.array([len(x) for x, _ in made], pa.int32()),
                pa.array([x.astype("<f4").tobytes() for x, _ in made], pa.binary()), pa.array([n.astype("<f4").tobytes() for _, n in made], pa.binary())],
                schema=arrow)

    got = sorted(rows.mapInArrow(features, schema).collect(), key=lambda r: r.doc_id)
    return Field([(np.frombuffer(r.x, "<f4").reshape(r.n, -1).astype(float), np.frombuffer(r.length, "<f4").astype(float)) for r in got],
                 [r.quality for r in got], 0.5 if share is None else float(share))


def score(docs: DataFrame, field: Field, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the probability that each text is of label 1."""
    full, kept = with_outputs(docs, f"`{score}` double")
    arrow = to_arrow_schema(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at, xs, ns, lines = 0, [], [], 0
            texts = whole.column(text)
            for i in range(whole.num_rows):
                x, n = line_features(texts[i].as_py())
                xs.append(x)
                ns.append(n)
                lines += len(x)
                if lines >= HELD_LINES or i == whole.num_rows - 1:
                    b = whole.slice(at, i + 1 - at)
                    yield pa.RecordBatch.from_arrays(
                        [*(b.column(c).cast(arrow.field(c).type) for c in kept), pa.array(field.score(xs, ns))], schema=arrow)
                    at, xs, ns, lines = i + 1, [], [], 0

    return docs.mapInArrow(run, full)


def fitted(spark, docs: DataFrame, sf_dir: str) -> Field:
    """Trained on the labelled rows that aren't held out."""
    told = table(spark, sf_dir, "labels").filter(crc_mod5("doc_id") != 0)
    return train(docs, told)


def op3_quality_crf(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fitted(spark, docs, sf_dir))
    return scored.select("doc_id", F.coalesce(crc_mod5("doc_id") == 0, F.lit(True)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
