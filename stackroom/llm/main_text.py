"""Main text of web pages: the stretch of the page with the highest score.

A page is a row of words and tags.  Words score by where they stand, positive in what looks like main
text; tags cost something each.  One scan over the row finds the contiguous stretch with the highest sum,
and what stands in it is the main text, save for blocks in elements that are never part of an article
(menus, headers, footers, asides, forms, and elements named after adverts, notices or comments).

The weights come from labelled pages: those with exactly one ``article`` (or else ``main``) element, words
inside being main text.  A logistic model of the words' place (their block's element, the elements and
names around it, its length, whether it is linked or ends like a sentence) gives a word's score, its
log-odds; on every other labelled page the labelling element is withheld, so that pages without one are
judged by the rest.  Names of boilerplate start from a prior, as labelled pages need not show them.  A tag
costs the more the more often it stands outside main text.

The model is fitted on a bounded sample (``labelled`` pages, those with the smallest hashes of their
text, copies once, and their ``patterns`` most frequent kinds of blocks); every page is read whole.
A null or empty page, and one without a stretch of positive score, has empty text.  Columns beside key and
url are not kept; they may have any name.  Repeated rows are extracted one by one.  Without labelled pages
the priors decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackroom.llm.html_blocks import APART, BOILERPLATE_NAMES, CONTENT_NAMES, Block, read_blocks
from stackroom.llm.words import values

BASE = "any"
#: Log-odds beyond which a word's score does not go.
MOST = 3.0


def prior(feature: str) -> float:
    """A feature's weight before any page is seen."""
    kind, _, name = feature.partition(":")
    if kind == "name":
        return -4.0 if name in BOILERPLATE_NAMES else 1.0 if name in CONTENT_NAMES else 0.0
    if kind == "in":
        return -4.0 if name in APART else 1.0 if name in ("article", "main") else 0.0
    if kind == "tag":
        return -1.0 if name.endswith("+a") else 0.5 if name in ("p", "blockquote", "pre") else 0.0
    return 0.5 if kind == BASE else 0.0


@dataclass
class Weights:
    features: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)

    def word(self, features: tuple[str, ...]) -> float:
        total = self.features.get(BASE, prior(BASE))
        for feature in features:
            weight = self.features.get(feature)
            total += prior(feature) if weight is None else weight
        return max(-MOST, min(MOST, total))

    def tag(self, tag: str) -> float:
        return self.tags.get(tag, -0.05)


def best_stretch(blocks: list[Block], weights: Weights, known: dict | None = None) -> tuple[int, int]:
    """First block of the stretch with the highest sum, and the one behind it; equal if none is positive."""
    known = {} if known is None else known
    best, best_from, best_to = 0.0, 0, 0
    total, begun = 0.0, 0
    for i, block in enumerate(blocks):
        between = sum(map(weights.tag, block.before))
        if total + between > 0:
            total += between
        else:
            total, begun = 0.0, i
        score = known.get(block.features)
        if score is None:
            score = known[block.features] = weights.word(block.features)
        total += score * block.words + sum(map(weights.tag, block.within))
        if total > best:
            best, best_from, best_to = total, begun, i + 1
        if total <= 0:
            total, begun = 0.0, i + 1
    return best_from, best_to


def main_text(page: str | None, weights: Weights, known: dict | None = None) -> str:
    """The main text of one page, blocks apart by an empty line."""
    if not page:
        return ""
    blocks = read_blocks(page)[0]
    first, end = best_stretch(blocks, weights, known)
    return "\n\n".join(b.text for b in blocks[first:end] if not b.apart)


def _observations(page: str, withheld: bool) -> Iterator[tuple[str, str, bool, int]]:
    """(kind, name, in main text, count): kinds of blocks and tags of a labelled page."""
    blocks, behind, holder = read_blocks(page)
    if holder is None or not any(b.labelled for b in blocks):
        return
    inside = False
    for block in blocks:
        for tag in block.before:
            # The tags around the holding element itself stand outside.
            inside = (inside or tag == holder) and tag != "/" + holder
            yield "tag", tag, inside and tag != holder, 1
        for tag in block.within:
            yield "tag", tag, block.labelled, 1
        kept = [f for f in block.features if not (withheld and f == f"in:{holder}")]
        yield "block", " ".join(kept), block.labelled, 1
    for tag in behind:
        yield "tag", tag, False, 1


def fit(patterns: list[tuple[str, int, int]], ridge: float = 0.1, steps: int = 50) -> dict[str, float]:
    """Weights of features by (features, blocks in main text, blocks outside), shrunk towards priors.

    Newton steps for a logistic model with a Gaussian prior.
    """
    names = sorted({f for features, _, _ in patterns for f in features.split()} | {BASE})
    place = {name: i for i, name in enumerate(names)}
    rows = np.zeros((len(patterns), len(names)))
    for r, (features, _, _) in enumerate(patterns):
        rows[r, [place[f] for f in features.split()] + [place[BASE]]] = 1
    inside = np.array([a for _, a, _ in patterns], float)
    n = inside + np.array([b for _, _, b in patterns], float)
    n_all = max(n.sum(), 1.0)
    # Seen blocks count as a thousand in all, whatever their number, beside the prior's ridge.
    inside, n = inside * 1000 / n_all, n * 1000 / n_all
    mean = np.array([prior(name) for name in names])
    weights = mean.copy()
    for _ in range(steps):
        share = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (inside - n * share) - ridge * (weights - mean)
        curve = (rows * (n * share * (1 - share))[:, None]).T @ rows + ridge * np.eye(len(names))
        step = np.linalg.solve(curve, slope)
        weights += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return dict(zip(names, weights.tolist(), strict=True))


def learn(
    pages: DataFrame, html: str = "html", labelled: int = 2000, patterns: int = 2000
) -> Weights:
    """Weights from up to ``labelled`` pages that say where their main text is."""
    column = F.col(f"`{html}`")
    hinted = pages.select(column.alias("page"), F.xxhash64(column).alias("at")).filter(
        F.lower(column).rlike(r"<(article|main)[\s>]")
    )
    chosen = hinted.select("at").distinct().orderBy("at").limit(labelled)
    last = chosen.agg(F.max("at")).first()[0]
    if last is None:
        return Weights()
    sample = hinted.filter(F.col("at") <= last).groupBy("at").agg(F.min("page").alias("page"))

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[str, str], list[int]] = {}
            for at, page in zip(values(batch, "at"), values(batch, "page"), strict=True):
                for kind, name, inside, n in _observations(page, at % 2 == 0):
                    counts.setdefault((kind, name), [0, 0])[0 if inside else 1] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in counts], pa.string()), pa.array([n for _, n in counts], pa.string()),
                 pa.array([c[0] for c in counts.values()], pa.int64()),
                 pa.array([c[1] for c in counts.values()], pa.int64())],
                names=["kind", "name", "inside", "outside"],
            )

    seen = (
        sample.mapInArrow(observe, "kind string, name string, inside bigint, outside bigint")
        .groupBy("kind", "name")
        .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
        .orderBy((F.col("inside") + F.col("outside")).desc(), "kind", "name")
        .limit(patterns)
        .collect()
    )
    blocks = [(r["name"], r["inside"], r["outside"]) for r in seen if r["kind"] == "block"]
    tags = {}
    for r in seen:
        if r["kind"] == "tag":
            odds = np.log((r["outside"] + 1) / (r["inside"] + 1))
            tags[r["name"]] = -float(min(MOST, max(0.01, odds)))
    return Weights(fit(blocks) if blocks else {}, tags)


def extract(
    pages: DataFrame, weights: Weights, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """``key``, ``url``, the main text and its length in code points, of every page."""
    types = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in (key, url))

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, ...], float] = {}
        for batch in batches:
            if len(known) > 10000:
                known.clear()
            texts = [main_text(page, weights, known) for page in values(batch, html)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=[key, url, "text", "n_chars"],
            )

    return pages.select(f"`{key}`", f"`{url}`", f"`{html}`").mapInArrow(
        per_batch, f"{types}, text string, n_chars bigint"
    )
