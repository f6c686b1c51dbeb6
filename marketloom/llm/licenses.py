"""Licence scan by a positional rare-token index.

The index is three small tables of the templates: their words in order with a mandatory key phrase,
postings (word, template, position), and all template words in order of document frequency over the
whole table, rarest first. A file whose words hold every word of some key phrase looks up its own
``RAREST`` template words of highest inverse document frequency, and of every such template the two
rarest words of the key phrase. Each place of such a word and each of its postings vote for a start of
the template; starts with two votes are compared: the key phrase must stand in place, and
``min_score`` of the template's words must agree.

Nothing is missed: where a template counts, its key phrase stands, so its two rarest words vote for
that start. Base phrases are templates that are a key phrase and nothing else.

Only DataFrame functions; the text is read twice (document frequencies, scan) and never shuffled. The
index is as large as the templates, whatever the files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.sqlwords import ascii_lower, let, words

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str  # a phrase of the text, of two different words at least, that must stand in place
    base: bool = False

    def __post_init__(self):
        if len(set(self.key.split())) < 2 or self.key_at < 0:
            raise ValueError(f"{self.key!r} is no phrase of two words of {self.text!r}")

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_at(self) -> int:
        w, k = self.words, self.key.split()
        return next((i for i in range(len(w)) if w[i:i + len(k)] == k), -1)


#: Base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Notices as licences word them, lower-cased, without punctuation.
NOTICES = (
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
             "software and associated documentation files the software to deal in the software without "
             "restriction", "permission is hereby granted free of charge"),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of "
             "the license at http www apache org licenses license 2 0", "apache org licenses license 2 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-nc", "creative commons attribution noncommercial 4 0 international license",
             "commons attribution noncommercial"),
    Template("cc-by", "creative commons attribution 4 0 international license", "commons attribution 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by-sa", "creative commons attribution sharealike 4 0 international license",
             "commons attribution sharealike"),
    Template("cc-by-nd", "creative commons attribution noderivatives 4 0 international license",
             "commons attribution noderivatives"),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or "
             "neighboring rights to this work", "waived all copyright and related"),
    Template("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the "
             "gnu general public license as published by the free software foundation either version 2 of the "
             "license or at your option any later version",
             "gnu general public license as published by the free software foundation either version 2"),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3",
             "gnu general public license version 3"),
    Template("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the "
             "gnu general public license as published by the free software foundation either version 3 of the "
             "license or at your option any later version",
             "gnu general public license as published by the free software foundation either version 3"),
    Template("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public "
             "license as published by the free software foundation", "gnu lesser general public license"),
    Template("agpl-3", "you can redistribute it and or modify it under the terms of the gnu affero general public "
             "license as published by the free software foundation", "gnu affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are "
             "permitted provided that the following conditions are met",
             "redistribution and use in source and binary forms"),
    Template("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to "
             "endorse or promote products derived from this software without specific prior written permission",
             "endorse or promote products derived from this software"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without "
             "fee is hereby granted provided that the above copyright notice and this permission notice appear in "
             "all copies", "and or distribute this software for any purpose with or without fee"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
             "mozilla public license v 2"),
    Template("epl-2", "this program and the accompanying materials are made available under the terms of the eclipse "
             "public license 2 0", "eclipse public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software"),
    Template("zlib", "this software is provided as is without any express or implied warranty in no event will the "
             "authors be held liable for any damages arising from the use of this software",
             "authors be held liable for any damages arising from the use"),
    Template("bsl-1", "boost software license version 1 0", "boost software license"),
    Template("wtfpl", "do what the fuck you want to public license", "want to public license"),
    Template("artistic-2", "you may distribute under the terms of the artistic license 2 0", "artistic license 2"),
    Template("ofl-1", "this font software is licensed under the sil open font license version 1 1",
             "sil open font license"),
    Template("cddl-1", "the contents of this file are subject to the terms of the common development and distribution "
             "license", "common development and distribution license"),
    Template("eupl-1", "licensed under the eupl version 1 2", "the eupl version"),
)
TEMPLATES = tuple(Template(label, phrase, phrase, base=True) for phrase, label in BASE.items()) + NOTICES
MIN_SCORE = 0.6
RAREST = 8
#: A vote is template * START + start of the template + SHIFT; a template may start before the text.
START, SHIFT = 1 << 40, 1 << 32


# -- the index --------------------------------------------------------------------------------------
def template_table(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    rows = [F.struct(
        F.lit(n).alias("template"), F.lit(t.label).alias("label"), F.lit(t.base).alias("base"),
        F.split(F.lit(t.text), " ").alias("words"), F.split(F.lit(t.key), " ").alias("key"), F.lit(t.key_at).alias("key_at"),
    ) for n, t in enumerate(templates)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def postings(table: DataFrame) -> DataFrame:
    """(word, template, position) of every word of every template."""
    return table.select("template", F.posexplode("words").alias("position", "word"))


def document_frequencies(docs: DataFrame, table: DataFrame, text: str = "text") -> DataFrame:
    """(word, files): for every word of the templates, the files that hold it."""
    vocabulary = postings(table).select("word").distinct()
    wanted = vocabulary.agg(F.collect_list("word")).scalar()
    held = docs.select(F.explode(F.array_intersect(words(ascii_lower(F.col(text)), GAP), wanted)).alias("word"))
    found = held.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return vocabulary.join(found, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("files"))


def rarest_first(frequencies: DataFrame) -> DataFrame:
    """One row: the words in order of document frequency, equal ones by name."""
    return frequencies.agg(F.transform(
        F.array_sort(F.collect_list(F.struct("files", "word"))), lambda s: s["word"]).alias("ranked"))


def _index(docs: DataFrame, templates: tuple[Template, ...], text: str) -> list[Column]:
    table = template_table(docs.sparkSession, templates)
    whole = F.array_sort(F.collect_list(F.struct("template", "label", "base", "words", "key", "key_at")))
    return [
        table.agg(whole).scalar().alias("templates"),
        table.agg(F.array_distinct(F.flatten(F.collect_list("key")))).scalar().alias("key_words"),
        postings(table).agg(F.collect_list(F.struct("word", "template", "position"))).scalar().alias("postings"),
        rarest_first(document_frequencies(docs, table, text)).scalar().alias("ranked"),
    ]


# -- one file ----------------------------------------------------------------------------------------
def _indexes(items: Column) -> Column:
    return F.when(F.size(items) > 0, F.sequence(F.lit(0), F.size(items) - 1)).otherwise(F.array().cast("array<int>"))


def _lookup_words(x: Column, possible: Column) -> Column:
    """The file's rarest template words, and the two rarest key words of each possible template."""
    pivots = F.transform(possible, lambda t: F.slice(F.array_intersect(x["ranked"], t["key"]), 1, 2))
    return F.array_union(F.slice(F.array_intersect(x["ranked"], x["w"]), 1, RAREST), F.flatten(pivots))


def _starts(x: Column, possible: Column) -> Column:
    """Starts of possible templates with two votes, as numbers."""
    def vote(s):
        at = lambda i: F.transform(
            F.filter(s["postings"], lambda p: p["word"] == F.get(x["w"], i)),
            lambda p: p["template"] * F.lit(START) + F.lit(SHIFT) + i - p["position"])
        places = F.filter(_indexes(x["w"]), lambda i: F.array_contains(s["lookup"], F.get(x["w"], i)))
        return F.array_sort(F.flatten(F.transform(places, at)))

    def with_lookup(c):
        wanted = F.filter(x["postings"], lambda p: F.array_contains(c, p["word"])
                          & F.exists(possible, lambda t: t["template"] == p["template"]))
        return let(F.struct(c.alias("lookup"), wanted.alias("postings")), vote)

    return let(let(_lookup_words(x, possible), with_lookup),
               lambda v: F.array_distinct(F.filter(v, lambda y, i: (i > 0) & (F.get(v, i - 1) == y))))


def _compared(x: Column, start: Column, min_score: float) -> Column:
    """(label, base, at, score) of a template at a start, null if the key phrase isn't in place there."""
    def at(s):
        t, o = s["t"], s["o"]
        key_at = o + t["key_at"]
        in_place = (key_at >= 0) & (F.slice(x["w"], F.greatest(key_at, F.lit(0)) + 1, F.size(t["key"])) == t["key"])
        agree = F.size(F.filter(_indexes(t["words"]), lambda k: F.coalesce(
            F.get(x["w"], o + k) == F.get(t["words"], k), F.lit(False))))
        score = agree / F.size(t["words"]).cast("double")
        return F.when(in_place, let(score, lambda y: F.when(y >= min_score, F.struct(
            t["label"].alias("label"), t["base"].alias("base"), o.cast("long").alias("at"), y.alias("score")))))

    template = F.get(x["templates"], F.floor(start / START).cast("int"))
    offset = (start % START - SHIFT).cast("int")
    return let(F.struct(template.alias("t"), offset.alias("o")), at)


def _scan(x: Column, min_score: float) -> Column:
    possible = let(F.array_intersect(x["w"], x["key_words"]), lambda held: F.filter(
        x["templates"], lambda t: F.size(F.array_except(t["key"], held)) == 0))
    starts = let(possible, lambda p: F.when(F.size(p) > 0, _starts(x, p)).otherwise(F.array().cast("array<bigint>")))
    found = F.filter(F.transform(starts, lambda s: _compared(x, s, min_score)), lambda f: f.isNotNull())
    return F.struct(F.size(x["w"]).cast("long").alias("n_words"), found.alias("found"))


def scan_licenses(docs: DataFrame, id: str = "doc_id", text: str = "text",
                  templates: tuple[Template, ...] = TEMPLATES, min_score: float = MIN_SCORE) -> DataFrame:
    """One row per input row: id, n_words, found: array of (label, base, at, score), one for every place
    where a template counts. ``at`` is the word where the template starts, below 0 if its first words
    are cut off.

    Null and empty texts have no words, places or labels. Rows are independent of each other, so
    repeated rows give repeated results; other columns of the input are not read. An empty table gives
    no rows. Words that no file holds count as the rarest; equal ones are looked up by name.
    """
    # Subqueries may not stand inside lambdas, so the index is in columns first.
    indexed = docs.select(F.col(id).alias("_id"), words(ascii_lower(F.col(text)), GAP).alias("w"), *_index(docs, templates, text))
    out = indexed.select("_id", let(
        F.struct("w", "templates", "key_words", "postings", "ranked"), lambda x: _scan(x, min_score)).alias("_s"))
    return out.select(F.col("_id").alias(id), "_s.n_words", "_s.found")


def license_digest(docs: DataFrame) -> DataFrame:
    """Counts, places and labels of the scan, one row per document."""
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    scanned = scan_licenses(docs).withColumn("base_places", F.filter("found", lambda f: f["base"]))
    return scanned.select(
        "doc_id", "n_words",
        F.size("base_places").cast("long").alias("n_base"),
        F.array_min("base_places.at").alias("first_word"),
        F.array_max("base_places.at").alias("last_word"),
        labels(F.col("base_places.label")).alias("base_labels"), labels(F.col("found.label")).alias("labels"),
        F.coalesce(F.array_max("found.score"), F.lit(0.0)).alias("score"),
    )


def digest_sql() -> str:
    """The digest in SQL: every template is tried at every place, without an index."""
    def quoted(s: str) -> str:
        return "'" + s + "'"

    rows = ",\n    ".join(
        f"({n}, {quoted(t.label)}, {str(t.base).lower()}, string_split({quoted(t.text)}, ' '), {t.key_at}, {len(t.key.split())})"
        for n, t in enumerate(TEMPLATES))
    join = "array_to_string(list_sort(list_distinct(coalesce(%s, []))), ',')"
    return f"""
WITH templates(template, label, base, words, key_at, key_size) AS (VALUES
    {rows}),
parts AS (
  SELECT template, unnest(words) AS word, unnest(range(len(words))) AS position FROM templates),
word_lists AS (
  SELECT row_number() OVER () AS row_no, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
places AS (
  SELECT row_no, unnest(w) AS word, unnest(range(len(w))) AS place FROM word_lists),
agreed AS (
  SELECT row_no, template, place - position AS start_at, count(*) AS n,
    count(*) FILTER (WHERE position >= key_at AND position < key_at + key_size) AS n_key
  FROM places JOIN parts USING (word) JOIN templates USING (template) GROUP BY ALL),
found AS (
  SELECT row_no, label, base, start_at, n / len(words)::DOUBLE AS score
  FROM agreed JOIN templates USING (template) WHERE n_key = key_size AND n / len(words)::DOUBLE >= {MIN_SCORE}),
digest AS (
  SELECT row_no, count(*) FILTER (WHERE base) AS n_base, min(start_at) FILTER (WHERE base) AS first_word,
    max(start_at) FILTER (WHERE base) AS last_word, list(label) FILTER (WHERE base) AS base_labels,
    list(label) AS labels, max(score) AS score
  FROM found GROUP BY row_no)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  {join % 'base_labels'} AS base_labels, {join % 'labels'} AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM word_lists LEFT JOIN digest USING (row_no)"""
