"""URL filter: host rules first, then a ratio of two character language models.

URLs that a rule decides train the models: one of accepted and one of rejected URLs.  Both
are variable-order Markov models over a fixed alphabet.  The chance of a character after
the three before it is interpolated with its chance after two, one and none, each longer
context weighing as much as it was seen.  A URL's score is the mean over its characters of
the log ratio of both chances; it is accepted at or above a threshold calibrated on the
scores of the URLs with rules.

Everything is built-in expressions.  URLs become strings over ``ALPHABET`` (digits are one
symbol), so there are at most 40^4 different 4-grams: the model is a table of bounded size, whatever
the number of URLs, and may be broadcast.

Defined results: a null URL or one without ``://`` has an empty host and path and meets no
rule; a URL without characters has a null score and is allowed; with no accepted or no rejected
URL to learn from, both models are alike and every URL without a rule scores 0; the threshold is
0 then, so it is allowed.  Repeated rows give repeated results.  Columns of the input other than
the key and the URL are not looked at, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackroom.llm.store import stored

LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Symbols of the models; "0" stands for any digit, "~" for any other character, "^" for the start.
ALPHABET = LETTERS + "0/.-_?&=#%:~^"
ORDER = 3
#: Weight of the shorter context in each interpolation step.
SMOOTHING = 2.0
#: Width of the score classes in which the threshold is calibrated.
CLASS_WIDTH = 0.01
#: Scores are clipped to plus or minus this in calibration, which bounds the number of classes.
CLASS_LIMIT = 10.0


@dataclass(frozen=True)
class Rule:
    """``pattern`` is host and path, as in ``example.net/en/``."""

    pattern: str
    verdict: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, LETTERS.upper(), LETTERS)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL, both empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Pattern and verdict of the longest rule that fits, else nulls."""
    pattern, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        pattern = F.when(fits, F.lit(rule.pattern)).otherwise(pattern)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return pattern, verdict


def symbols(url: Column) -> Column:
    """The URL behind its scheme, spelled in ``ALPHABET``, with ORDER starts before it."""
    rest = ascii_lower(F.regexp_replace(url, r"(?s)^.*?://", ""))
    rest = F.translate(rest, "123456789", "000000000")
    rest = F.regexp_replace(rest, r"(?s)[^a-z0/._?&=#%:-]", "~")
    return F.concat(F.lit("^" * ORDER), rest)


def _grams(urls: DataFrame, *columns: str) -> DataFrame:
    """One row for each character: it and the ORDER symbols before it, as ``gram``."""
    length = F.length("symbols") - ORDER
    starts = F.when(length > 0, F.sequence(F.lit(1), length))
    return urls.select(*columns, "symbols", F.explode(starts).alias("start")).select(
        *columns, F.col("symbols").substr(F.col("start"), F.lit(ORDER + 1)).alias("gram")
    )


def train(urls: DataFrame) -> DataFrame:
    """(gram, ratio) for every 4-gram of ``urls`` (symbols, verdict, copies).

    The count of each gram is summed over all URLs; ``ratio`` is the log of its last symbol's
    chance among accepted URLs over that among rejected ones.
    """
    counts = _grams(urls, "verdict", "copies").groupBy("gram").agg(
        F.sum(F.when(F.col("verdict") == "allow", F.col("copies")).otherwise(0)).alias("n_allow"),
        F.sum(F.when(F.col("verdict") == "block", F.col("copies")).otherwise(0)).alias("n_block"),
    )
    counts = stored(counts, "url-grams")
    chance = {side: F.lit(1.0 / len(ALPHABET)) for side in ("allow", "block")}
    model = counts
    for order in range(ORDER + 1):
        # Sums over all grams that share the last `order` symbols before the character.
        suffix, context = f"suffix{order}", f"context{order}"
        spelled = {
            suffix: F.substring("gram", ORDER + 1 - order, order + 1),
            context: F.substring("gram", ORDER + 1 - order, order),
        }
        rows = counts.withColumns(spelled)
        model = model.withColumns(spelled)
        for key, name in ((suffix, "seen"), (context, "total")):
            sums = rows.groupBy(key).agg(
                F.sum("n_allow").alias(f"{name}{order}_allow"),
                F.sum("n_block").alias(f"{name}{order}_block"),
            )
            model = model.join(F.broadcast(sums), key)
        chance = {
            side: (F.col(f"seen{order}_{side}") + SMOOTHING * shorter)
            / (F.col(f"total{order}_{side}") + SMOOTHING)
            for side, shorter in chance.items()
        }
    return model.select("gram", F.log(chance["allow"] / chance["block"]).alias("ratio"))


def _threshold(scored: DataFrame) -> DataFrame:
    """One row: the class border at which both kinds are wrongly judged least often.

    Shares, not numbers, count, so that neither kind outweighs the other.  Of several
    best borders the one nearest to 0 is taken.
    """
    clipped = F.greatest(F.lit(-CLASS_LIMIT), F.least(F.lit(CLASS_LIMIT), F.col("score")))
    classes = (
        scored.filter(F.col("verdict").isNotNull() & F.col("score").isNotNull())
        .groupBy(F.floor(clipped / CLASS_WIDTH).alias("class"))
        .agg(
            F.sum(F.when(F.col("verdict") == "allow", F.col("copies")).otherwise(0)).alias("a"),
            F.sum(F.when(F.col("verdict") == "block", F.col("copies")).otherwise(0)).alias("b"),
        )
    )
    # At most 2 * CLASS_LIMIT / CLASS_WIDTH rows, so their lists fit one row.
    lists = classes.agg(
        F.array_sort(F.collect_list(F.struct("class", "a", "b"))).alias("classes"),
        F.sum("a").alias("all_a"),
        F.sum("b").alias("all_b"),
    )

    def border(i):
        """Half way between a class and the one before it, and the error there."""
        at = (F.get("classes", i)["class"] + F.get("classes", i - 1)["class"] + 1) / 2
        wrong = F.aggregate(
            "classes",
            F.lit(0.0),
            lambda total, c: total
            + F.when(c["class"] < at, c["a"] / F.col("all_a")).otherwise(c["b"] / F.col("all_b")),
        )
        return F.struct(F.round(wrong, 12).alias("wrong"), F.abs(at).alias("far"), at.alias("at"))

    steps = F.sequence(F.lit(1), F.size("classes") - 1)
    borders = F.when(F.size("classes") > 1, F.transform(steps, border))
    best = F.coalesce(F.array_min(borders)["at"] * CLASS_WIDTH, F.lit(0.0))
    both = (F.col("all_a") > 0) & (F.col("all_b") > 0)
    return lists.select(F.when(both, best).otherwise(0.0).alias("threshold"))


def judge(
    pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url"
) -> DataFrame:
    """key, host, path, rule, verdict, score and threshold for each row of ``pages``."""
    rows = pages.select(F.col(key).alias("_key"), F.col(url).cast("string").alias("_url"))
    host, path = url_parts(F.col("_url"))
    rows = rows.withColumns({"host": host, "path": path})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns(
        {"rule": rule, "ruled": verdict, "symbols": symbols(F.coalesce("_url", F.lit("")))}
    )
    # A URL that many rows share is counted and scored once.
    urls = rows.groupBy("symbols", F.col("ruled").alias("verdict")).agg(
        F.count("*").alias("copies")
    )
    model = F.broadcast(train(urls))
    scored = (
        _grams(urls, "symbols", "verdict", "copies")
        .join(model, "gram")
        .groupBy("symbols", "verdict", "copies")
        .agg(F.round(F.avg("ratio"), 9).alias("score"))
    )
    threshold = _threshold(scored)
    scores = scored.select("symbols", F.col("verdict").alias("ruled"), "score")
    judged = rows.alias("r").join(
        scores.alias("s"),
        (F.col("r.symbols") == F.col("s.symbols")) & F.col("r.ruled").eqNullSafe(F.col("s.ruled")),
        "left",
    )
    limit = threshold.scalar()
    by_model = F.when(F.col("score") < limit, "block").otherwise("allow")
    return judged.select(
        F.col("_key").alias(key),
        "host",
        "path",
        "rule",
        F.coalesce("r.ruled", by_model).alias("verdict"),
        "score",
        limit.cast(T.DoubleType()).alias("threshold"),
    )
