"""License phrases in texts by diagonal voting, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cohortloom.llm.common import whole_text

# The phrases asked for, and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further templates, wordings of well-known licenses.
FURTHER = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under the gnu general public license version 3": "gpl-3",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "subject to the terms of the mozilla public license v 2 0": "mpl-2",
}
GRAM = 2  # words in a rolling hash; the shortest template has three words
MAX_SHIFT = 2  # diagonals of one place may be this many words apart: words put in or left out
MIN_COVERAGE = 0.8  # of a template's words, for a label by the method
END = "\x00end"  # no word holds a NUL


def _gram(words: Column, i: Column) -> Column:
    return F.xxhash64(*[F.get(words, i + j) for j in range(GRAM)])


def _place(pos: Column, gram: Column, words: Column) -> Column:
    return F.struct(pos.alias("pos"), gram.alias("gram"), words.alias("gram_words"))


def template_grams(spark: SparkSession) -> DataFrame:
    """Every k-gram of every template with its place, and the mark that ends a document.

    A few rows by construction (fixed values above), hence safe to broadcast.
    """
    rows = [
        (i, label, phrase in BASE, phrase.split())
        for i, (phrase, label) in enumerate([*BASE.items(), *FURTHER.items()])
    ]
    templates = spark.createDataFrame(rows, "template int, label string, base boolean, template_words array<string>")
    grams = templates.withColumn(
        "at", F.explode(F.sequence(F.lit(0), F.size("template_words") - GRAM))
    ).withColumn("gram", _gram(F.col("template_words"), F.col("at")))
    ends = spark.range(1).select(
        F.lit(-1).alias("template"),
        F.lit(None).cast("string").alias("label"),
        F.lit(False).alias("base"),
        F.array().cast("array<string>").alias("template_words"),
        F.lit(0).alias("at"),
        F.xxhash64(F.lit(END)).alias("gram"),
    )
    return grams.unionByName(ends)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its license places, labels and score.

    All rolling k-gram hashes of a document meet the template positions in one join; a match votes
    for the diagonal (document place less template place). Every match is verified by its words, so a
    diagonal with all votes of a template is a place where its words stand consecutively. Votes of
    diagonals at most ``MAX_SHIFT`` apart are merged; places that cover ``MIN_COVERAGE`` of a template
    give its label too, and the best coverage is the score.

    Texts are scanned whole where they are read and aren't shuffled: matches and one end mark per
    document are. Null and empty texts have no words, no labels and score 0. Rows are told apart by id
    and text; a row given twice is returned once for each time, with counts of one.
    """
    lower = F.translate(whole_text(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    read = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(whole_text(text_col)).alias("text_hash"),
        F.filter(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "").alias("words"),
    )
    # A gram's row has its own words alone; with a text's words in every row the work would grow with their square.
    grams = F.transform("words", lambda w, i: _place(i, _gram(F.col("words"), i), F.slice("words", i + 1, GRAM)))
    end = _place(F.size("words"), F.xxhash64(F.lit(END)), F.array().cast("array<string>"))
    own = F.slice("template_words", F.col("at") + 1, GRAM)
    matches = (
        read.select("doc_id", "text_hash", F.inline(F.concat(grams, F.array(end))))
        .join(F.broadcast(template_grams(docs.sparkSession)), "gram")
        .where(F.when(F.col("template") < 0, F.size("gram_words") == 0).otherwise(F.col("gram_words") == own))
    )
    keys = ["doc_id", "text_hash"]
    diagonals = matches.groupBy(*keys, "template", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.first("label").alias("label"),
        F.first("base").alias("base"),
        F.first(F.size("template_words")).alias("length"),
        F.collect_set("at").alias("ats"),
        F.count("*").alias("n_matches"),
    )
    # A row given k times has k end marks, and k matches for each vote.
    along = Window.partitionBy(*keys, "template").orderBy("diagonal")
    merged = (
        diagonals.withColumn("previous", F.lag("diagonal").over(along))
        .withColumn("starts", F.coalesce((F.col("diagonal") - F.col("previous") > MAX_SHIFT).cast("int"), F.lit(0)))
        .withColumn("place", F.sum("starts").over(along))
    )
    whole = F.col("base") & (F.size("ats") == F.col("length") - GRAM + 1)
    places = merged.groupBy(*keys, "template", "place").agg(
        F.first("label").alias("label"),
        F.first("length").alias("length"),
        F.max(F.when(F.col("template") < 0, F.col("diagonal"))).cast("long").alias("n_words"),
        F.max(F.when(F.col("template") < 0, F.col("n_matches"))).alias("n_rows"),
        F.sum(F.when(whole, 1).otherwise(0)).alias("n_base"),
        F.min(F.when(whole, F.col("diagonal"))).alias("first_word"),
        F.max(F.when(whole, F.col("diagonal"))).alias("last_word"),
        F.array_distinct(
            F.flatten(F.collect_set(F.transform("ats", lambda a: F.sequence(a, a + GRAM - 1))))
        ).alias("covered"),
    )
    covered = F.size(F.array_distinct(F.flatten("covered")))
    coverage = F.when(F.col("template") < 0, F.lit(0.0)).otherwise(covered / F.col("length"))
    found = places.withColumn("coverage", coverage).groupBy(*keys).agg(
        F.max("n_words").alias("n_words"),
        F.max("n_rows").alias("n_rows"),
        F.sum("n_base").cast("long").alias("n_base"),
        F.min("first_word").cast("long").alias("first_word"),
        F.max("last_word").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("n_base") > 0, F.col("label")))), ",").alias("base_labels"),
        F.array_join(
            F.array_sort(F.collect_set(F.when((F.col("n_base") > 0) | (F.col("coverage") >= MIN_COVERAGE), F.col("label")))),
            ",",
        ).alias("labels"),
        F.max("coverage").alias("score"),
    )
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int")))).drop(
        "copy", "n_rows", "text_hash"
    )
