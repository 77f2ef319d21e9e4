"""Licence scan: lines and whole texts against licence templates by Dice over word bigrams.

A text is normalised (A-Z lowered, ASCII characters other than letters and digits as breaks)
and becomes the set of its word bigrams. Its Dice coefficient with a template of b bigrams can reach
t only if its own number lies between b * t / (2 - t) and b * (2 - t) / t, so templates are
joined by the sizes they admit. Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.templates import TEMPLATES

THRESHOLD = 0.8
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normalised(text: Column) -> Column:
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(lowered, _BREAKS, " "))


def bigrams(words: Column) -> Column:
    """Distinct pairs of neighbours in an array of words."""
    pairs = F.zip_with(
        F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.array_distinct(pairs)


def template_bigrams(templates: dict[str, str]) -> list[tuple[str, list[str]]]:
    """Licence and sorted distinct bigrams of each template that has two words or more."""
    found = []
    for name, text in templates.items():
        for paragraph in text if isinstance(text, list) else [text]:
            words = "".join(c if c.isalnum() else " " for c in paragraph.lower()).split()
            pairs = sorted({f"{a} {b}" for a, b in zip(words, words[1:])})
            if pairs:
                found.append((name, pairs))
    return found


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """Numbers of bigrams, both included, with which a template of ``size`` can match."""
    return (
        math.ceil(size * threshold / (2 - threshold) - 1e-9),
        math.floor(size * (2 - threshold) / threshold + 1e-9),
    )


def _may_fit(words: Column, sizes: set[int]) -> Column:
    """False only where the words' distinct bigrams cannot have one of the admitted sizes.

    Their number lies between the distinct words less one and all words less one, which is
    known before any bigram is made.
    """
    runs: list[list[int]] = []
    for size in sorted(sizes):
        if runs and size == runs[-1][1] + 1:
            runs[-1][1] = size
        else:
            runs.append([size, size])
    most, least = F.size(words) - 1, F.size(F.array_distinct(words)) - 1
    fits = F.lit(False)
    for low, high in runs:
        fits = fits | ((most >= low) & (least <= high))
    return fits


def licence_matches(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    templates: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, license, dice, line, n_lines): the licences found in each document.

    Each line, and the text as a whole (line -1) if it has several lines, takes the template
    with the largest coefficient, ties by name; ``dice`` and the first such ``line`` are the
    licence's best in the document, ``n_lines`` the number of its lines. Null, empty and one-word texts match nothing;
    rows that share an id count as one document, equal lines of theirs once. Documents
    without a licence give no row.
    """
    spark = documents.sparkSession
    sizes = [
        (size, name, pairs)
        for name, pairs in template_bigrams(TEMPLATES if templates is None else templates)
        for low, high in [size_bounds(len(pairs), threshold)]
        for size in range(low, high + 1)
    ]
    # at most as many rows as the templates have bigrams times the width of their bounds
    admitted = spark.createDataFrame(sizes, "size int, license string, template array<string>")
    text = F.col(text_column)
    lines = F.split(text, "\n")
    whole = F.when(F.size(lines) > 1, F.array(F.struct(F.lit(-1).alias("line"), text.alias("t"))))
    segments = F.concat(
        F.coalesce(whole, F.array().cast("array<struct<line:int,t:string>>")),
        F.transform(lines, lambda t, k: F.struct(k.alias("line"), t.alias("t"))),
    )
    cut = documents.select(F.col(id_column).alias("id"), F.explode(segments).alias("s"))
    words = F.split(normalised(F.col("s.t")), " ")
    cut = cut.select("id", "s.line", words.alias("words"))
    cut = cut.where((F.size("words") > 1) & _may_fit(F.col("words"), {s for s, _, _ in sizes}))
    # a match has at least t / (2 - t) of its own bigrams in common, and every word that no
    # template has spoils one bigram for each two such words
    known = sorted({w for _, _, pairs in sizes for pair in pairs for w in pair.split(" ")})
    strange = F.size(F.array_except("words", F.split(F.lit(" ".join(known)), " ")))
    spoilt = (1 - threshold / (2 - threshold)) * (F.size("words") - 1)
    cut = cut.where(strange <= 2 * spoilt + 1e-6)
    cut = cut.select("id", "line", bigrams(F.col("words")).alias("own"))
    near = cut.withColumn("size", F.size("own")).join(F.broadcast(admitted), "size")
    common = F.size(F.array_intersect("own", "template"))
    dice = 2.0 * common / (F.size("own") + F.size("template"))
    near = near.withColumn("dice", dice).where(F.col("dice") >= threshold)
    best = near.groupBy("id", "line").agg(
        F.min(F.struct((-F.col("dice")).alias("d"), "license")).alias("best")
    )
    return best.groupBy("id", F.col("best.license").alias("license")).agg(
        (-F.min("best.d")).alias("dice"),
        F.min(F.struct("best.d", "line"))["line"].alias("line"),
        F.count("*").alias("n_lines"),
    )
