"""Quality classifier from weak labels: heuristics vote, EM weighs them, a hashed linear scorer learns the result."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.llm import hashed
from airloom.llm.common import free_name, put_aside, sampled, save

GOOD, BAD, NONE = 1, 0, -1
#: The labellers, in the order of their votes.
LABELLERS = ("symbols", "letters", "marked", "capitals", "variety", "top_word", "repeated_lines", "sentences", "word_length")
_SYMBOLS = b"#$%&*|!<>{}[]=~^_\\@+"
_CAPITALS, _SMALL, _OTHER = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(128, 256))
_MARKS = bytes(0x21 if b in b"!" + _SYMBOLS else b for b in range(256))


def votes(text: str | None) -> list[int]:
    """One vote of each labeller over the whole text: 1 good, 0 bad, -1 none."""
    data = text.encode("utf-8", "replace") if text else b""
    tokens = data.split()
    if not tokens:
        return [NONE] * len(LABELLERS)
    n, size = len(tokens), sum(map(len, tokens))
    count = lambda of: len(data) - len(data.translate(None, of))
    capitals, small = count(_CAPITALS), count(_SMALL)
    blocks = [tokens[i : i + 100] for i in range(0, n, 100)]
    variety = sum(len(set(b)) for b in blocks) / n
    top = max(max(b.count(w) for w in set(b)) if len(set(b)) <= 12 else 0 for b in blocks) / min(n, 100)
    lines = [x for x in data.split(b"\n") if x.strip()]
    ends = data.count(b".") + data.count(b"?")
    marks = data.translate(_MARKS)
    marked = sum(map(marks.count, (b"! ", b"!\n"))) + marks.endswith(b"!")
    letters, symbols, loud = (capitals + small + count(_OTHER)) / size, count(_SYMBOLS) / size, capitals / max(1, capitals + small)
    vote = lambda bad, good: BAD if bad else GOOD if good else NONE
    return [
        vote(symbols > 0.04, symbols < 0.01),
        vote(letters < 0.75, letters > 0.9) if n >= 20 else NONE,
        vote(marked / n > 0.2, marked / n < 0.05),
        vote(loud > 0.3, loud < 0.1) if n >= 20 else NONE,
        vote(variety < 0.35, variety > 0.5) if n >= 20 else NONE,
        vote(top > 0.3, top < 0.15) if n >= 20 else NONE,
        vote(len(set(lines)) < 0.6 * len(lines), len(set(lines)) > 0.9 * len(lines)) if len(lines) > 2 else NONE,
        vote(not 0.005 <= ends / n <= 0.6, 0.02 <= ends / n <= 0.35) if n >= 20 else NONE,
        vote(not 2 <= size / n <= 15, 3 <= size / n <= 10),
    ]


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _votes(text: pa.Array) -> pa.Array:
    return pa.array([votes(t) for t in text.to_pylist()], pa.list_(pa.int32()))


def weigh(patterns: Sequence[Sequence[int]], counts: Sequence[int], rounds: int = 500, close: float = 1e-9) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns: log share of each class, and log chance of each labeller's vote (none, bad, good) in it.

    Class 0 is good text; each labeller has a class of bad text, because junk of different kinds is seen by
    different, overlapping labellers. Given the class, labellers err independently; no vote says nothing.
    The start: a text is good unless labellers object, else of their classes alike. One vote of either
    kind is added to every count. The good chances of class 0 are the labellers' estimated accuracies.
    """
    votes_, n = np.asarray(patterns, int).reshape(len(counts), -1), np.asarray(counts, float)
    m = votes_.shape[1]
    outcome = np.stack([votes_ == v for v in (NONE, BAD, GOOD)], axis=2).astype(float)  # pattern, labeller, vote
    outcome[:, :, 0] = 0
    bad = outcome[:, :, 1] + 1e-3
    flagged = (votes_ == BAD).any(axis=1)
    part = np.column_stack((np.where(flagged, 0.1, 0.99), np.where(flagged, 0.9, 0.01)[:, None] * bad / bad.sum(axis=1, keepdims=True)))
    for _ in range(rounds):
        cast = np.einsum("pc,pjv->cjv", n[:, None] * part, outcome)[:, :, 1:] + 1
        chance = np.zeros((m + 1, m, 3))
        chance[:, :, 1:] = np.log(cast / cast.sum(axis=2, keepdims=True))
        share = np.log((n[:, None] * part).sum(axis=0) + 1)
        total = share + np.einsum("pjv,cjv->pc", outcome, chance)
        new = np.exp(total - total.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        done = np.abs(new - part).max(initial=0) < close
        part = new
        if done:
            break
    return share - np.log(np.exp(share).sum()), chance


def weak_label(votes_: Sequence[int], share: np.ndarray, chance: np.ndarray) -> float:
    """The posterior of good text for one pattern of votes."""
    total = share + sum(chance[:, j, v + 1] for j, v in enumerate(votes_))
    return float(np.exp(total[0] - total.max()) / np.exp(total - total.max()).sum())


def _posterior(share: np.ndarray, chance: np.ndarray):
    @F.arrow_udf(T.DoubleType())
    def weak(text: pa.Array) -> pa.Array:
        return pa.array([weak_label(votes(t), share, chance) for t in text.to_pylist()], pa.float64())

    return weak


def rate_quality(docs: DataFrame, fit_rows: int = 10_000, size: int = 1 << 15, least: float = 0.3) -> DataFrame:
    """Adds weak (the labellers' posterior), quality (the scorer's probability of a good text) and keep.

    Heuristic labellers vote on every whole text. Their votes are counted by pattern over all documents
    (at most 3^9 patterns, whatever the table's size), EM estimates each labeller's accuracy, and every
    vote pattern gets a posterior. A linear scorer on hashed features learns the posteriors: it is
    fitted on a sample of about `fit_rows` documents at most, chosen by a seeded hash of id and text,
    each as a good and a bad example weighted by its posterior, and rates all documents. keep: quality
    is `least` or more.

    Null texts and texts without words have null weak and quality and are not kept. Repeated rows: each
    is rated, with equal results. Empty table, or one without words: no model, nothing kept. Columns called
    weak, quality or keep are replaced; all others stay.
    """
    docs = docs.drop("weak", "quality", "keep")
    filled = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x09-\x0D\x20]")
    patterns = docs.where(filled).groupBy(_votes("text").alias("votes")).count().collect()
    if not patterns:
        return docs.withColumns({"weak": F.lit(None).cast("double"), "quality": F.lit(None).cast("double"), "keep": F.lit(False)})
    weak = _posterior(*weigh([r["votes"] for r in patterns], [r["count"] for r in patterns]))
    total = sum(r["count"] for r in patterns)
    sample = sampled(docs.where(filled), fit_rows, total, "doc_id", "text")
    sample = sample.withColumn("good", weak("text"))
    sample = sample.withColumn("digest", F.xxhash64("text"))
    examples = hashed.with_vector(sample, "text", "vector", size).select("doc_id", "digest", "vector", F.explode(F.array(
        F.struct(F.lit(1.0).alias("class"), F.col("good").alias("weight")),
        F.struct(F.lit(0.0).alias("class"), (1 - F.col("good")).alias("weight")))).alias("e")).select("doc_id", "digest", "vector", "e.class", "e.weight")
    examples = save(hashed.in_order(examples.where("weight > 0"), "doc_id", "digest", "class").drop("doc_id", "digest"), "examples")
    model = hashed.fit(examples, size, 2)
    kind = free_name(docs, "kind")
    rated = hashed.score(docs, model, "text", kind, size)
    quality = F.when(filled, F.get(f"{kind}.chances", F.lit(1)))
    return rated.withColumns({
        "weak": F.when(filled, weak("text")), "quality": quality,
        "keep": F.coalesce(quality >= least, F.lit(False))}).drop(kind)


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The documents that the classifier keeps, with their columns as they were."""
    held, aside = put_aside(docs, "weak", "quality", "keep")
    kept = rate_quality(held, **options).where("keep").drop("weak", "quality", "keep")
    return kept.withColumnsRenamed(aside).select(*[f"`{c}`" for c in docs.columns])
