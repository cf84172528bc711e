r"""License scans by diagonal voting, in DataFrame operations only.

Texts are lower-cased (A-Z) and cut into words; every rolling word 2-gram is
hashed and joined to the positions of the same gram in the templates (a small
broadcast table; the words themselves must agree too). A hit votes for the
diagonal word position - template position. A diagonal is merged with those at
most GAP after it, so that a span may have words more or less than its template.
A span is verified by order: its hits must be a chain of rising template positions
and word positions, which gives its extent; it counts if the chain reaches the
template's share, and no better covered span overlaps it.

Base templates are short phrases that must be covered whole on one diagonal;
other templates are notices whose labels are added to the base ones.

Defined results
* null or empty text, or one word: no hits, score 0. Very long texts are read
  whole; their grams are streamed through the join, not kept.
* repeated rows and null identifiers are rows of their own (rows are told apart
  by an internal number); an empty table gives an empty result; other columns
  are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import text_of

#: The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Notices that the method finds beyond the base phrases: words and label.
NOTICES = {
    "released under the mit license": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "licensed under the gnu lesser general public license": "lgpl",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under the creative commons attribution 4 0 international license": "cc-by-4.0",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}

#: Diagonals merged, the share of a notice's grams that a span must cover, and words of a template at most.
GAP, COVER, MOST_WORDS = 2, 0.8, 63


def words_of(text: Column) -> Column:
    """Words after lower-casing A-Z.

    lower() also changes other letters, but only the two replaced here become ASCII
    by it; all others stay word characters, so words and matches are the same.
    """
    text = F.replace(F.replace(text, F.lit("K"), F.lit("é")), F.lit("İ"), F.lit("é"))
    return F.array_remove(F.split(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def templates(spark: SparkSession, base: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """A row for each gram of each template; its size depends on the templates alone."""
    rows = []
    for n, (phrase, label, is_base) in enumerate([(p, x, True) for p, x in base.items()] + [(p, x, False) for p, x in notices.items()]):
        words = phrase.split()
        if not 2 <= len(words) <= MOST_WORDS:
            raise ValueError(f"a template has 2 to {MOST_WORDS} words: {phrase}")
        rows += [(n, label, is_base, len(words) - 1, i, a, b) for i, (a, b) in enumerate(zip(words, words[1:]))]
    out = spark.createDataFrame(rows, "_t int, _label string, _base boolean, _grams int, _at int, _ta string, _tb string")
    return out.withColumn("_th", F.xxhash64("_ta", "_tb"))


def _in_order(near: str, grams: str) -> Column:
    """The longest chains of hits on neighbouring diagonals: n, and the first and last word position.

    A chain takes template positions in order, and its diagonals only rise (the text has words more) or only fall
    (the text lacks words), so that words stand in the template's order. One entry for each of the two ways.
    """
    none = F.struct(F.lit(0).alias("n"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))

    def chain(diagonals: Column) -> Column:
        def step(best: Column, at: Column) -> Column:  # best: for each diagonal, the best chain that ends on it or before it
            def on(done: Column, d: Column) -> Column:
                k = F.size(done)
                here, before = F.get(best, k), F.get(done, k - 1)
                up = F.when(before.isNull() | (here["n"] >= before["n"]), here).otherwise(before)
                seen = F.getbit(d["_seen"], at) == 1
                pos = (d["_diag"] + at).cast("int")
                more = F.struct((up["n"] + 1).alias("n"), F.coalesce(up["first"], pos).alias("first"), pos.alias("last"))
                return F.concat(done, F.array(F.when(seen, more).otherwise(up)))

            return F.aggregate(diagonals, F.slice(best, 1, 0), on)

        return F.element_at(F.aggregate(F.sequence(F.lit(0), F.col(grams) - 1), F.transform(diagonals, lambda _: none), step), -1)

    return F.when(F.size(near) == 1, F.array(chain(F.col(near)))).otherwise(F.array(chain(F.col(near)), chain(F.reverse(F.col(near)))))


def scan(
    docs: DataFrame, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES, id_col: str = "doc_id", text_col: str = "text", gap: int = GAP, cover_share: float = COVER
) -> DataFrame:
    """One row per input row: id_col, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    spans: label, first word and end word (exclusive) of the notices found.
    """
    words = docs.select(F.monotonically_increasing_id().alias("_u"), F.col(id_col).alias("_id"), words_of(text_of(text_col)).alias("_w"))
    grams = words.select(
        "_u",
        "_id",
        F.size("_w").alias("_n"),
        F.posexplode_outer(F.zip_with("_w", F.slice("_w", 2, F.greatest(F.size("_w"), F.lit(1))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("_pos", "_gram"),
    )
    grams = grams.withColumn("_gh", F.xxhash64("_gram.a", "_gram.b"))
    known = F.broadcast(templates(docs.sparkSession, base, notices))
    same = (F.col("_gh") == F.col("_th")) & (F.col("_gram.a") == F.col("_ta")) & (F.col("_gram.b") == F.col("_tb"))
    votes = (
        grams.join(known, same, "left")
        .filter("_t is not null or _pos is null or _pos = 0")  # the first gram stands for the text, hit or not
        .groupBy("_u", "_t", (F.col("_pos") - F.col("_at")).alias("_diag"))
        .agg(
            F.first("_id").alias("_id"),
            F.first("_n").alias("_n"),
            F.first("_label").alias("_label"),
            F.first("_base").alias("_base"),
            F.first("_grams").alias("_grams"),
            F.bit_or(F.expr("shiftleft(1L, _at)")).alias("_seen"),
        )
    )
    # merge: a diagonal and those at most `gap` after it, which are few; the vote that starts a span is the lowest
    line = Window.partitionBy("_u", "_t").orderBy("_diag").rangeBetween(0, gap)
    merged = votes.withColumn("_near", F.when(~F.col("_base"), F.sort_array(F.collect_list(F.struct("_diag", "_seen")).over(line))))
    spans = merged.select("_u", "_id", "_n", "_label", "_base", "_grams", "_diag", "_seen", F.explode_outer(F.when(~F.col("_base"), _in_order("_near", "_grams"))).alias("_chain"))
    cover = F.when(F.col("_base"), F.bit_count("_seen")).otherwise(F.col("_chain.n")) / F.col("_grams")
    spans = spans.select(
        "_u", "_id", "_n", "_label", "_base", "_diag", cover.alias("_cover"),
        F.col("_chain.first").alias("_first"), F.least(F.col("_chain.last") + 2, "_n").alias("_end"),
    )
    place = F.col("_base") & (F.col("_cover") == 1)
    # of notices that overlap, the best covered: all that overlap one start near it
    around = Window.partitionBy("_u").orderBy("_first").rangeBetween(-2 * MOST_WORDS, 2 * MOST_WORDS)
    good = spans.withColumn("_good", ~F.col("_base") & (F.col("_cover") >= F.lit(cover_share))).withColumn("_at", F.when(F.col("_good"), F.struct("_first", "_end", "_cover")))
    rivals = F.collect_set("_at").over(around)
    beaten = F.exists("_rivals", lambda y: (y["_cover"] > F.col("_cover")) & (y["_first"] < F.col("_end")) & (F.col("_first") < y["_end"]))
    good = good.withColumn("_rivals", F.when(F.col("_good"), rivals)).withColumn("_good", F.col("_good") & ~beaten).drop("_rivals", "_at")
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    span = F.struct(F.col("_first").alias("first_word"), F.col("_end").alias("end_word"), F.col("_label").alias("label"), F.col("_cover").alias("cover"))
    out = good.groupBy("_u").agg(
        F.first("_id").alias(id_col),
        F.first("_n").cast("bigint").alias("n_words"),
        F.count(F.when(place, 1)).alias("n_base"),
        F.min(F.when(place, F.col("_diag"))).cast("bigint").alias("first_word"),
        F.max(F.when(place, F.col("_diag"))).cast("bigint").alias("last_word"),
        F.collect_set(F.when(place, F.col("_label"))).alias("_places"),
        F.coalesce(F.max("_cover"), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_set(F.when(F.col("_good"), span))).alias("spans"),
    )
    return out.select(
        id_col, "n_words", "n_base", "first_word", "last_word", joined(F.col("_places")).alias("base_labels"),
        joined(F.array_union("_places", F.transform("spans", lambda x: x["label"]))).alias("labels"), "score", "spans",
    )
