"""License notices in documents: phrases word by word, and templates by an exact set-similarity join. DataFrame functions only.

Method. A text's words are cut into blocks of 2c words that begin every c words,
for every power of two c that some template needs, so that a notice of up to c
words lies whole in one block. A block fits a template if it holds at least
``threshold`` percent of the template's distinct words. All blocks that fit are
found, without comparing every block to every template:

* order: template words are ranked by the number of documents that hold them,
  rarest first, counted over the whole table; other words can't be in an overlap
  and are dropped from blocks, which tightens the length filter;
* prefix: sets of sizes b and m that share at least k words share one among the
  first b - k + 1 and the first m - k + 1; only blocks that hold a prefix word of
  some template are made at all;
* length: a block of fewer than k ranked words is left out;
* position: what prefixes share, and the shorter of the rests behind the last
  shared word, bound the overlap from above;
* what is left is intersected.

The templates are a bounded parameter, so every text meets them in its own row,
as in a broadcast join: the scan moves no text and gathers no group, and a hot
source or a text with thousands of copies is spread as its rows are. The one
aggregate counts template words and has as many rows as there are such words.

Defined results: a null text counts as empty. An empty text has no words, no
places, no labels and the score 0. Letters A-Z are lower-cased, others are not.
Phrases may overlap; each place counts. The score is the largest share of a
template's words that one block holds, if it fits, and 1 for a place of a phrase.
Repeated rows, ids and null ids each give a row. A text of any length is read
whole: its blocks are slices of its words, so time is linear. Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What parts words: ASCII other than digits and small letters.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Labels and the phrases that stand for them.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]

#: Labels and the wording of public license notices, as words.
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("gpl", "this work is licensed under the gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
#: Percent of a template's distinct words that a block has to hold.
THRESHOLD = 90
#: The smallest step of blocks, in words.
STEP = 8


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), GAPS), "")


def step_of(template: str) -> int:
    """The power of two, STEP at least, that is no less than the template's words."""
    return max(STEP, 1 << (len(template.split()) - 1).bit_length())


def least_shared(template: str, threshold: int) -> int:
    """The fewest distinct words that reach the threshold."""
    return max(1, -(-threshold * len(set(template.split())) // 100))


def ranked(docs: DataFrame, templates: Sequence[tuple[str, str]], text_col: str = "text") -> list[str]:
    """All template words, those of the fewest documents first; ties by the word."""
    tokens = sorted({w for _, t in templates for w in t.split()})
    held = docs.select(F.explode(F.array_intersect(words_of(F.col(text_col).cast("string")), F.array(*[F.lit(w) for w in tokens]))).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}  # as many rows as there are template words
    return sorted(tokens, key=lambda w: (counts.get(w, 0), w))


def followed(word: str):
    return lambda so_far, w: so_far & (w == word)


def places(words: Column, lower: Column, phrase: str) -> Column:
    """Starts, from 0, of all places where the phrase's words stand one after another."""
    first, *others = phrase.split()
    flags = F.transform(words, lambda w: w == first)
    for i, word in enumerate(others):
        flags = F.zip_with(flags, F.slice(words, F.lit(i + 2), F.size(words)), followed(word))
    found = F.filter(F.transform(flags, lambda f, i: F.when(f, i)), lambda i: i.isNotNull())
    # a text without the letters of every word can't hold the phrase
    possible = reduce(lambda a, b: a & b, [F.contains(lower, F.lit(w)) for w in [first, *others]])
    return F.when(possible, found).otherwise(F.array().cast("array<int>"))


def literal(values: Sequence[int]) -> Column:
    return F.array(*[F.lit(int(v)) for v in values]).cast("array<int>")


def fitting(blocks: Column, label: str, template: str, rank: dict[str, int], threshold: int) -> Column:
    """label, first, words and score of the blocks (first, words, ranks) that fit a template."""
    own = sorted(rank[w] for w in set(template.split()))
    size, least = len(own), least_shared(template, threshold)
    whole, prefix = literal(own), literal(own[: size - least + 1])

    def fits(b: Column) -> Column:
        ranks = b["ranks"]
        n = F.size(ranks)
        shared = F.array_intersect(F.slice(ranks, F.lit(1), n - least + 1), prefix)
        last = F.array_max(shared)
        bound = F.size(shared) + F.least(n - F.array_position(ranks, last), F.lit(size) - F.array_position(whole, last))
        by_length = n >= least
        return F.when(by_length, F.when(F.size(shared) > 0, (bound >= least) & (F.size(F.array_intersect(ranks, whole)) >= least)).otherwise(False)).otherwise(False)

    return F.transform(F.filter(blocks, fits), lambda b: F.struct(F.lit(label).alias("label"), b["first"].alias("first"), b["words"].alias("words"), (F.size(F.array_intersect(b["ranks"], whole)) / F.lit(float(size))).alias("score")))


def marked_blocks(words: Column, marks: Column, universe: Column, step: int) -> Column:
    """first, words and sorted ranks of the blocks of 2 x step words that hold one of the places ``marks``."""
    c = F.lit(step)
    numbers = F.array_distinct(F.flatten(F.transform(marks, lambda i: F.filter(F.array(F.floor(i / c).cast("int") - 1, F.floor(i / c).cast("int")), lambda b: b >= 0))))
    # the words of a block are a slice, so all blocks together cost no more than twice the text
    blocks = F.transform(numbers, lambda b: F.struct((b * c).alias("first"), F.slice(words, b * c + 1, 2 * c).alias("own")))
    ranks = lambda own: F.array_sort(F.array_distinct(F.filter(F.transform(own, lambda w: F.array_position(universe, w).cast("int")), lambda r: r > 0)))
    return F.transform(blocks, lambda b: F.struct(b["first"].alias("first"), F.size(b["own"]).alias("words"), ranks(b["own"]).alias("ranks")))


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks and found of every row.

    ``found`` lists the blocks that fit a template: label, first word, number of
    words, share of the template's words.
    """
    if not 1 <= threshold <= 100 or any(not t.split() for _, t in [*templates, *phrases]):
        raise ValueError("templates and phrases need words, the threshold is 1 to 100 percent")
    kind = "array<struct<label:string,first:int,words:int,score:double>>"
    order = ranked(docs, templates, text_col) if templates else []
    rank = {w: i + 1 for i, w in enumerate(order)}
    prefixes = {w for _, t in templates for w in sorted(set(t.split()), key=rank.get)[: len(set(t.split())) - least_shared(t, threshold) + 1]}
    steps = sorted({step_of(t) for _, t in templates})
    lower = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER)
    # words, marks and blocks are each used by several columns of the next step, so they are computed once a row
    rows = docs.select(F.col(id_col).alias("doc_id"), lower.alias("lower")).withColumn("words", F.array_remove(F.split("lower", GAPS), ""))
    spots = [places(F.col("words"), F.col("lower"), p).alias(f"place{i}") for i, (_, p) in enumerate(phrases)]
    rare = F.array(*[F.lit(w) for w in sorted(prefixes)]).cast("array<string>")
    marks = F.when(F.arrays_overlap("words", rare), F.filter(F.transform("words", lambda w, i: F.when(w.isin(sorted(prefixes)), i)), lambda i: i.isNotNull())).otherwise(F.array().cast("array<int>"))
    located = rows.select("doc_id", "words", F.size("words").cast("long").alias("n_words"), marks.alias("marks"), *spots)
    universe = F.array(*[F.lit(w) for w in order])
    sets = [F.when(F.size("marks") > 0, marked_blocks(F.col("words"), F.col("marks"), universe, c)).alias(f"blocks{c}") for c in steps]
    marked = located.select("doc_id", "n_words", *[f"place{i}" for i in range(len(phrases))], *sets)
    found = [F.coalesce(fitting(F.col(f"blocks{step_of(t)}"), label, t, rank, threshold).cast(kind), F.array().cast(kind)) for label, t in templates]
    told = marked.select(
        "doc_id",
        "n_words",
        F.concat(F.array().cast("array<int>"), *[F.col(f"place{i}") for i in range(len(phrases))]).alias("places"),
        F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(F.size(f"place{i}") > 0, F.lit(label)) for i, (label, _) in enumerate(phrases)])).alias("base"),
        F.concat(F.array().cast(kind), *found).alias("found"),
    )
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return told.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        joined(F.col("base")).alias("base_labels"),
        joined(F.concat("base", F.transform("found", lambda b: b["label"]))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("found", lambda b: b["score"])), F.lit(0.0))).alias("score"),
        F.size("found").cast("long").alias("n_blocks"),
        "found",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandline.llm.frames import read

    return scan(read(spark, sf_dir, "documents")).drop("found")


def oracle(templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES, threshold: int = THRESHOLD) -> str:
    """The plain way: every block against every template."""
    listed = lambda t: "[" + ", ".join(f"'{w}'" for w in t) + "]"
    wanted = ", ".join(f"({i}, '{label}', {step_of(t)}, {len(set(t.split()))}, {least_shared(t, threshold)}, {listed(sorted(set(t.split())))})" for i, (label, t) in enumerate(templates))
    spoken = ", ".join(f"('{label}', {len(p.split())}, {listed(p.split())})" for label, p in phrases)
    return rf"""
with texts as (
  select doc_id, row_number() over () as r,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{GAPS}'), lambda w: w <> '') as w
  from documents),
templates(i, label, c, m, least, own) as (values {wanted}),
phrases(label, k, own) as (values {spoken}),
places as (
  select r, label, unnest(list_filter(range(1, len(w) + 1), lambda i: w[i:i + k - 1] = own)) - 1 as place
  from texts cross join phrases),
base as (
  select r, count(*) as n_base, min(place) as first_word, max(place) as last_word, list_distinct(list(label)) as base from places group by r),
blocks as (
  select r, c, list_distinct(w[b * c + 1:b * c + 2 * c]) as own
  from texts cross join (select distinct c from templates), unnest(range((len(w) + c - 1) // c)) as n(b)),
fits as (
  select r, label, len(list_intersect(t.own, b.own)) as shared, m, least from blocks b join templates t on b.c = t.c),
found as (
  select r, count(*) as n_blocks, max(shared / m::double) as score, list_distinct(list(label)) as more from fits where shared >= least group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
       array_to_string(list_sort(coalesce(base, [])), ',') as base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ',') as labels,
       case when n_base > 0 then 1.0::double else coalesce(score, 0.0)::double end as score, coalesce(n_blocks, 0) as n_blocks
from texts left join base using (r) left join found using (r)
"""


ORACLE = oracle()
