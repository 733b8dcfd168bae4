"""Licence notices found by a positional index of rare words, with DataFrame functions only.

The templates are notices as they stand at the top of files. A word's document frequency
over the whole corpus says how rare it is. For every file and template, the ``RAREST`` of
the template's words that the file holds are looked up in the index, whose postings say
where each word stands in the template; each place of such a word in the file then votes
for a shift between template and file. A shift with the votes of ``VOTES`` words or more is
a candidate, and it stands if all mandatory key phrases of the template are within
``SLACK`` words of where it expects them. A file without a word of some mandatory phrase
is not looked up for that template, since it could not pass. A candidate's score is the
share of the template's words at their places.

Besides, base phrases are found wherever their words stand in a row; a file with none but
a base phrase scores ``PHRASE_SCORE``.

Files are scanned once; what is kept of each are the places of the templates' words. A file
with any number of notices stays linear: votes, phrases and words at their places are
grouped by file, template and shift.

Defined results: a null or empty text has no words, no labels and the score 0; labels of a
file without any are the empty string; repeated rows and rows without an id are files of
their own, told apart by row; ties in rarity go by the word; an empty table gives no rows.
Columns other than doc_id and text are ignored, and so none can clash.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codesift.llm.common import let
from codesift.session import written

# Phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Label, notice, mandatory key phrases.
TEMPLATES = [
    ("gpl-3.0", "Licensed under the GNU General Public License, version 3",
     ["gnu general public license version 3"]),
    ("gpl-2.0", "Licensed under the GNU General Public License, version 2",
     ["gnu general public license version 2"]),
    ("gpl-or-later", "This program is free software: you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation, either "
     "version 3 of the License, or (at your option) any later version.",
     ["free software", "gnu general public license", "any later version"]),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of "
     "the GNU Lesser General Public License as published by the Free Software Foundation; either version "
     "2.1 of the License, or (at your option) any later version.",
     ["free software", "gnu lesser general public license", "any later version"]),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of "
     "the GNU Affero General Public License as published by the Free Software Foundation, either version "
     "3 of the License, or (at your option) any later version.",
     ["free software", "gnu affero general public license", "any later version"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ["apache license version 2 0"]),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy "
     "of the License at http://www.apache.org/licenses/LICENSE-2.0",
     ["in compliance with the license", "www apache org licenses license 2 0"]),
    ("mit", "Released under the MIT License", ["mit license"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
     "and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
     "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
     "sublicense, and/or sell copies of the Software",
     ["permission is hereby granted free of charge", "to deal in the software without restriction"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted, provided that the above copyright notice and this permission notice "
     "appear in all copies.", ["for any purpose with or without fee is hereby granted"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met",
     ["redistribution and use in source and binary forms", "with or without modification"]),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
     "copy of the MPL was not distributed with this file, You can obtain one at",
     ["mozilla public license v 2 0"]),
    ("cc-by-4.0", "Licensed under CC BY 4.0", ["cc by 4 0"]),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ["cc by sa 4 0"]),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ["cc by nc 4 0"]),
    ("unlicense", "This is free and unencumbered software released into the public domain.",
     ["free and unencumbered software", "public domain"]),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0",
     ["boost software license version 1 0"]),
]
RAREST = 4
VOTES = 3
SLACK = 5
PHRASE_SCORE = 0.5

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def template_words() -> list[list[str]]:
    return [words_of(text) for _, text, _ in TEMPLATES]


def key_phrases() -> list[list[tuple[int, list[str]]]]:
    """For each template its mandatory phrases and where the first of them stands."""
    found = []
    for words, (_, _, phrases) in zip(template_words(), TEMPLATES):
        places = []
        for phrase in map(str.split, phrases):
            at = [i for i in range(len(words)) if words[i: i + len(phrase)] == phrase]
            places.append((at[0], phrase))
        found.append(places)
    return found


def vocabulary() -> list[str]:
    return sorted({w for words in template_words() for w in words}
                  | {w for phrase in BASE for w in phrase.split()})


def _rows(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A small table as part of the plan."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def scanned(docs: DataFrame) -> DataFrame:
    """``row, doc_id, n_words, hits``: the places ``at`` of the templates' words ``w``."""
    words = F.filter(F.split(F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER), _GAP), lambda w: w != "")
    known = vocabulary()
    split = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words.alias("words"))
    hits = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("w"))),
                    lambda h: h["w"].isin(known))
    return split.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                        F.size("words").cast("long").alias("n_words"), hits.alias("hits"))


def _stands(hits: Column, i: Column, phrase: Column) -> Column:
    """Whether ``phrase`` (an array of words) begins at the ``i``-th hit and goes on without a gap."""
    n = F.size(phrase)
    return (F.transform(F.slice(hits, i + 1, n), lambda h: h["w"]) == phrase) & (
        F.get(hits, i + n - 1)["at"] == F.get(hits, i)["at"] + n - 1)


def _texts(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _starts(hits: Column, phrase: Column) -> Column:
    """Places in the file where the phrase begins."""
    begin = F.filter(F.transform(hits, lambda h, i: F.struct(h["w"].alias("w"), i.alias("i"))),
                     lambda h: h["w"] == F.element_at(phrase, 1))
    at = F.filter(F.transform(begin, lambda h: F.when(_stands(hits, h["i"], phrase), F.get(hits, h["i"])["at"])),
                  lambda a: a.isNotNull())
    return at


def base_places(files: DataFrame) -> DataFrame:
    """``files`` with ``n_base, first_word, last_word, base``, the labels as an array."""
    found = files
    for k, phrase in enumerate(BASE):
        found = found.withColumn(f"_b{k}", _starts(F.col("hits"), _texts(phrase.split())))
    columns = [F.col(f"_b{k}") for k in range(len(BASE))]
    places = F.concat(*columns)
    labels = F.array_compact(F.array(*[
        F.when(F.size(c) > 0, F.lit(label)) for c, label in zip(columns, BASE.values())]))
    return found.select(
        *files.columns, F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"), labels.alias("base"))


def by_rarity(files: DataFrame) -> list[str]:
    """The licence words, the one in fewest files first. At most as many as the vocabulary."""
    counts = files.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["w"]))).alias("w")).groupBy(
        "w").agg(F.count("*").alias("n"))
    often = {r["w"]: r["n"] for r in counts.collect()}
    return sorted(vocabulary(), key=lambda w: (often.get(w, 0), w))


def notices(files: DataFrame) -> DataFrame:
    """``row, label, score`` of the templates that stand in a file."""
    spark, order = files.sparkSession, by_rarity(files)
    rank = {w: i for i, w in enumerate(order)}
    texts, phrases = template_words(), key_phrases()
    held = F.transform("hits", lambda h: h["w"])
    asked = F.array(*[F.struct(
        F.lit(t).alias("t"),
        _texts(sorted({w for _, phrase in places for w in phrase})).alias("must"),
        _texts(sorted(set(words), key=rank.__getitem__)).alias("order"),
        F.array(*[F.struct(F.lit(n).alias("no"), F.lit(pos).alias("pos"), _texts(phrase).alias("words"))
                  for n, (pos, phrase) in enumerate(places)]).alias("phrases"))
        for t, (words, places) in enumerate(zip(texts, phrases))])
    files = files.filter(F.size("hits") > 1).select("row", "hits", F.array_distinct(held).alias("held"))
    looked = files.select("row", "hits", F.explode(F.filter(
        asked, lambda a: F.size(F.array_except(a["must"], F.col("held"))) == 0)).alias("a"), "held")
    rare = F.slice(F.array_intersect(F.col("a.order"), F.col("held")), 1, RAREST)
    met = F.flatten(F.transform("a.phrases", lambda p: F.transform(
        _starts(F.col("hits"), p["words"]), lambda at: F.struct(p["no"].alias("no"), (at - p["pos"]).alias("shift")))))
    looked = written(looked.select("row", F.col("a.t").alias("t"), let(rare, lambda r: F.filter(
        "hits", lambda h: F.array_contains(r, h["w"]))).alias("anchors"), met.alias("met")), "looked")
    index = F.broadcast(_rows(spark, ["_t", "_w", "pos"], [
        (t, w, pos) for t, words in enumerate(texts) for pos, w in enumerate(words)]))
    votes = looked.select("row", "t", F.inline("anchors")).join(
        index, (F.col("t") == F.col("_t")) & (F.col("w") == F.col("_w"))).select(
        "row", "t", "w", (F.col("at") - F.col("pos")).alias("shift")).distinct()
    shifts = votes.groupBy("row", "t", "shift").agg(F.count("*").alias("votes")).filter(F.col("votes") >= VOTES)
    # A phrase may stand a little off; blocks of shifts keep the join an equi-join.
    block = SLACK + 1
    near = looked.select("row", "t", F.inline("met")).select(
        F.col("row").alias("_row"), F.col("t").alias("_t"), "no", F.col("shift").alias("_shift"), F.explode(
            F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)),
                        lambda d: F.floor(F.col("shift") / block) + d)).alias("_block"))
    need = _rows(spark, ["_n", "need"], [(t, len(places)) for t, places in enumerate(phrases)])
    stands = shifts.join(near, (F.col("row") == F.col("_row")) & (F.col("t") == F.col("_t")) & (
        F.floor(F.col("shift") / block) == F.col("_block")) & (
        F.abs(F.col("shift") - F.col("_shift")) <= SLACK)).groupBy("row", "t", "shift").agg(
        F.count_distinct("no").alias("n"))
    stands = stands.join(F.broadcast(need), (F.col("t") == F.col("_n")) & (F.col("n") == F.col("need")))
    stands = written(stands.select("row", "t", "shift"), "stands")
    ids = stands.select(F.col("row").alias("_row")).distinct()
    places = files.join(ids, F.col("row") == F.col("_row"), "left_semi").select(
        F.col("row").alias("_row"), F.inline("hits"))
    expected = stands.join(index, F.col("t") == F.col("_t")).select(
        "row", "t", "shift", (F.col("shift") + F.col("pos")).alias("_at"), "_w")
    shares = expected.join(places, (F.col("row") == F.col("_row")) & (F.col("_at") == F.col("at")) & (
        F.col("_w") == F.col("w"))).groupBy("row", "t", "shift").agg(F.count("*").alias("n"))
    labels = F.broadcast(_rows(spark, ["_t", "label", "words"], [
        (t, TEMPLATES[t][0], len(words)) for t, words in enumerate(texts)]))
    return shares.join(labels, F.col("t") == F.col("_t")).select(
        "row", "label", (F.col("n") / F.col("words")).alias("score"))


def licensed(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of each row."""
    files = written(scanned(docs), "scanned")
    found = notices(files).groupBy("row").agg(
        F.collect_set("label").alias("_labels"), F.max("score").alias("_score"))
    rows = base_places(files).drop("hits").join(found.withColumnRenamed("row", "_row"), F.col("row") == F.col("_row"), "left")
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union("base", F.coalesce("_labels", none)))
    alone = F.when(F.size("base") > 0, PHRASE_SCORE).otherwise(0.0)
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.greatest(F.coalesce("_score", F.lit(0.0)), alone).alias("score"))
