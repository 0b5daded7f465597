"""License scan: an exact set-similarity join of text blocks with license
templates, in DataFrame operations only.

A block is a run of consecutive words of a document, wherever its lines break,
as its set of words; a template is a set of words too.  The blocks held against a
template are all runs that are a quarter longer than it (``window``), and one
matches when it holds at least 80 % of the template's words.  The words of all
templates are ordered by their frequency in the whole corpus, rarest first.  A
matching block must hold one of the first ``n - need + 1`` words of a template of n
words (prefix filter), so blocks are opened at the places of such words only: the
words around a place are cut out, and joined with the templates on the word.  They
must hold at least ``need`` template words at all (length filter), and enough of
them on either side of the shared one in the order (positional filter).  Of a
candidate, every block over the place is verified by its exact overlap.  Templates
are fixed and few, so they are broadcast.

Beside the join, whole texts are scanned for the base phrases.

Defined cases: a null text counts as empty: no words, no labels, score 0, null
first and last word; rows equal in id and text get equal results; a null id
is kept; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closeledger.llm.common import read_table

# Base phrases with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices as the licenses' own texts recommend them.
TEMPLATES = {
    "apache-2.0-notice": "licensed under the apache license version 2 0",
    "apache-2.0-header": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "bsd-terms": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by-nc-4.0-notice": "licensed under cc by nc 4 0",
    "cc-by-4.0-notice": "licensed under a creative commons attribution 4 0 international license",
    "gpl-3.0-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-header": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "mit-notice": "released under the mit license",
    "mit-terms": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction",
}

PERCENT = 80
#: Runs of characters that are in no word (words keep their case here).
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def template_words() -> dict[str, list[str]]:
    return {label: sorted(set(text.split())) for label, text in TEMPLATES.items()}


def window(label: str) -> int:
    """Words of the blocks that are held against a template."""
    return -(-5 * len(TEMPLATES[label].split()) // 4)


def required(n: int) -> int:
    return -(-PERCENT * n // 100)


def lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def may_hold(text: Column, words: list[str]) -> Column:
    """False only for texts in which no word of ``words`` can be; cheap."""
    low = F.lower(text)
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])


def padded(text: Column) -> Column:
    """All words, each with a space on either side; empty without words."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(text, SEPARATORS, "  ")), F.lit(" "))


def _places(text: Column, part: str) -> Column:
    """How often ``part`` is in ``text``."""
    gone = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(part), F.lit("")))
    return (gone / len(part)).cast("long")


def _n_words(text: Column) -> Column:
    """Words of a padded text (two spaces a word; none is two spaces)."""
    return F.when(F.octet_length(text) <= 2, F.lit(0).cast("long")).otherwise((_places(text, " ") / 2).cast("long"))


def base_columns() -> dict[str, Column]:
    """n_base, first_word, last_word and base labels from n_words and
    _cl_low, the padded words in lower case (empty where no phrase can be)."""
    words, n_words = F.col("_cl_low"), F.col("n_words")
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in PHRASES.items():
        part = "".join(f" {w} " for w in phrase.split())
        found = F.contains(words, F.lit(part))
        counts.append(F.when(found, _places(words, part)).otherwise(F.lit(0).cast("long")))
        firsts.append(F.when(found, _n_words(F.substring_index(words, part, 1))))
        lasts.append(F.when(found, n_words - _n_words(F.substring_index(words, part, -1)) - len(phrase.split())))
        labels.append(F.when(found, F.lit(label)))
    return {
        "n_base": reduce(lambda a, b: a + b, counts),
        "first_word": F.least(*firsts),
        "last_word": F.greatest(*lasts),
        "_cl_labels": F.array_compact(F.array(*labels)),
    }


def word_order(rows: DataFrame) -> list[str]:
    """The templates' words, rarest in the corpus first.  At most one count
    per template word reaches the driver."""
    vocabulary = sorted(set().union(*template_words().values()))
    words = F.split(F.regexp_replace("text", SEPARATORS, " "), " ")
    found = rows.select(F.explode(words).alias("w")).select(F.lower("w").alias("w")).where(F.col("w").isin(vocabulary))
    counts = {r["w"]: r["n"] for r in found.groupBy("w").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def template_hits(rows: DataFrame, order: list[str]) -> DataFrame:
    """doc_id, _cl_hash, template, containment of the blocks of ``rows``
    (doc_id, _cl_hash, text) that match; the best of those over one place."""
    spark = rows.sparkSession
    rank = {w: i for i, w in enumerate(order)}
    entries = []
    for label, words in template_words().items():
        ranks, need = sorted(rank[w] for w in words), required(len(words))
        entries += [(r, at, label, ranks, words, need, window(label)) for at, r in enumerate(ranks[: len(ranks) - need + 1])]
    names = "token int, _t_at int, template string, _t_ranks array<int>, _t_words array<string>, _t_need int, _t_window int"
    prefixes = spark.createDataFrame(entries, names)
    least, widest = min(e[5] for e in entries), max(e[6] for e in entries)
    ranks_of = F.create_map(*[F.lit(x) for w in order for x in (w, rank[w])])

    rare = sorted({order[e[0]] for e in entries})
    words = F.split(F.regexp_replace(lowered(F.col("text")), SEPARATORS, " "), " ")
    texts = rows.where(may_hold(F.col("text"), rare)).select("doc_id", "_cl_hash", words.alias("words"))
    places = texts.select("doc_id", "_cl_hash", "words", F.posexplode("words").alias("_p", "_w")).where(F.col("_w").isin(rare))
    first = F.greatest(F.col("_p") - (widest - 1), F.lit(0))
    around = F.slice("words", first + 1, F.col("_p") - first + widest)
    places = places.select("doc_id", "_cl_hash", "_w", (F.col("_p") - first).alias("_at"), around.alias("words"))
    places = places.withColumn("known", F.array_intersect("words", F.array(*[F.lit(w) for w in order]))).where(F.size("known") >= least)
    ranks = F.array_sort(F.transform("known", lambda w: ranks_of[w]))
    places = places.select("doc_id", "_cl_hash", "_at", "words", ranks.alias("ranks"), ranks_of[F.col("_w")].alias("token"))
    place = F.array_position("ranks", F.col("token")).cast("int") - 1
    before = F.least(place, F.col("_t_at"))
    after = F.least(F.size("ranks") - place, F.size("_t_ranks") - F.col("_t_at"))
    candidates = places.join(F.broadcast(prefixes), "token").where((F.size("ranks") >= F.col("_t_need")) & (before + after >= F.col("_t_need")))
    starts = F.sequence(F.greatest(F.col("_at") - F.col("_t_window") + 1, F.lit(0)), F.col("_at"))
    shared = F.array_max(F.transform(starts, lambda i: F.size(F.array_intersect(F.slice(F.col("words"), i + 1, F.col("_t_window")), F.col("_t_words")))))
    verified = candidates.withColumn("shared", shared).where(F.col("shared") >= F.col("_t_need"))
    return verified.select("doc_id", "_cl_hash", "template", (F.col("shared") / F.size("_t_ranks")).alias("containment"))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score (the best containment of a matching block)."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text", F.octet_length("text")).alias("_cl_hash"), "text")
    hits = template_hits(rows, word_order(rows))
    hits = hits.groupBy(F.col("doc_id").alias("_h_id"), F.col("_cl_hash").alias("_h_hash")).agg(
        F.collect_set("template").alias("_h_templates"), F.max("containment").alias("_h_score")
    )
    maybe = may_hold(F.col("text"), sorted({phrase.split()[-1] for phrase in PHRASES}))
    base = rows.select("doc_id", "_cl_hash", maybe.alias("_cl_maybe"), padded(F.col("text")).alias("_cl_words"))
    low = F.when(F.col("_cl_maybe"), lowered(F.col("_cl_words"))).otherwise(F.lit(""))
    base = base.select("doc_id", "_cl_hash", _n_words(F.col("_cl_words")).alias("n_words"), low.alias("_cl_low"))
    base = base.select("doc_id", "_cl_hash", "n_words", *[c.alias(n) for n, c in base_columns().items()])
    out = base.join(hits, F.col("doc_id").eqNullSafe(F.col("_h_id")) & (F.col("_cl_hash") == F.col("_h_hash")), "left")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return out.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        joined(F.col("_cl_labels")).alias("base_labels"),
        joined(F.concat("_cl_labels", F.coalesce("_h_templates", F.array().cast("array<string>")))).alias("labels"),
        F.coalesce("_h_score", F.lit(0.0)).alias("score"),
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every whole document."""
    return scan(read_table(spark, sf_dir, "documents"))


def oracle_sql() -> str:
    """The same in DuckDB SQL: of every text with enough of a template's words,
    all blocks that begin with one of them (a block that begins otherwise holds no
    more words than the one that begins at the next)."""
    words = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    starts = []
    for phrase, label in PHRASES.items():
        parts = " and ".join(f"w[i + {k}] = '{p}'" for k, p in enumerate(phrase.split()))
        starts.append(f"select r, i - 1 as place, '{label}' as label from places where {parts}")
    templates = ", ".join(f"('{label}', {ws!r}, {len(ws)}, {required(len(ws))}, {window(label)})" for label, ws in template_words().items())
    return f"""
with docs as (
  select row_number() over () as r, doc_id,
         translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') as t
  from documents),
tokens as (select r, doc_id, t, {words.format("t")} as w from docs),
places as (select r, w, unnest(range(1, len(w) + 1)) as i from tokens),
base as ({" union all ".join(starts)}),
templates(template, tw, n, need, size) as (values {templates}),
likely as (select r, w, template, tw, n, need, size from tokens, templates where len(list_intersect(list_distinct(w), tw)) >= need),
starts as (select *, unnest(range(1, len(w) + 1)) as i from likely),
blocks as (select r, template, n, need, len(list_intersect(w[i:i + size - 1], tw)) as shared from starts where list_contains(tw, w[i])),
hits as (select r, template as label, max(shared) as shared, n from blocks group by r, template, n, need having max(shared) >= need),
labels as (
  select r, string_agg(distinct label, ',' order by label) as labels
  from (select r, label from base union all select r, label from hits) group by r),
based as (
  select r, count(*) as n_base, min(place) as first_word, max(place) as last_word,
         string_agg(distinct label, ',' order by label) as base_labels from base group by r),
best as (select r, max(shared / n) as score from hits group by r)
select doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
       coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0) as score
from tokens left join based using (r) left join labels using (r) left join best using (r)"""
