"""License statements: phrases word by word, and texts of notices by an exact set join.

Only DataFrame functions are used. A template is found in a block of a text (a line, or
lines up to an empty one) if the block has enough of the template's different words. The join is exact: words in ascending order of how often they occur, so that a block which
reaches the threshold must share one of the template's rarest words (prefix), have enough
words (length), and enough of them left behind the first shared one (position). What passes
is verified by counting the shared words.
"""

import re
from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.llm.staging import staged

#: Phrases that count at any place, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Statements of one line.
STATEMENTS = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-2.0": "This program is licensed under the GNU General Public License, version 2",
    "lgpl": "This library is licensed under the GNU Lesser General Public License",
    "agpl-3.0": "Licensed under the GNU Affero General Public License, version 3",
    "mit": "Released under the MIT License",
    "bsd": "Released under the BSD License",
    "mpl-2.0": "Licensed under the Mozilla Public License, Version 2.0",
    "cc-by-4.0": "Licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "cc0-1.0": "To the extent possible under law the author has waived all copyright under CC0 1.0 Universal",
}

#: Notices of many lines.
NOTICES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,"
        " and to permit persons to whom the Software is furnished to do so, subject to the following conditions"
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on"
        " an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for"
        " the specific language governing permissions and limitations under the License"
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY"
        " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the"
        " GNU General Public License for more details"
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: Redistributions of source code must retain the above copyright notice, this"
        " list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above"
        " copyright notice, this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution"
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,"
        " publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,"
        " for any purpose, commercial or non-commercial, and by any means"
    ),
}

#: Share of a template's different words that a block must have.
STATEMENT_THRESHOLD, NOTICE_THRESHOLD = 1.0, 0.8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Lines of a text, and its stretches between empty lines.
_UNITS = {"line": r"\n", "paragraph": r"\n[\x20\x09\x0B-\x0D]*\n"}


def words_of(text):
    """Words of a text column, lower-cased from A to Z, one blank between them."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.trim(F.regexp_replace(lowered, _NOT_A_WORD, " "))


def _template_words(text: str) -> list:
    return sorted(set(re.sub(_NOT_A_WORD, " ", text.translate(str.maketrans(_UPPER, _LOWER))).split()))


def _any_of(words):
    """Pattern for one of some words in words joined by blanks."""
    return f"(?:^| )(?:{'|'.join(sorted(words))})(?= |$)"


def _phrase_places(words, phrases):
    """at and label of every place of joined words where a phrase starts."""
    firsts = sorted({phrase.split(" ")[0] for phrase in phrases})

    def places(listed):
        def here(word, i):
            starts = []
            for phrase, label in sorted(phrases.items()):
                same = [F.get(listed, i + k) == part for k, part in enumerate(phrase.split(" "))]
                found = F.struct(i.cast("long").alias("at"), F.lit(label).alias("label"))
                starts.append(F.when(reduce(and_, same), found))
            return F.when(word.isin(firsts), F.array_compact(F.array(*starts)))

        return F.flatten(F.filter(F.transform(listed, here), lambda found: found.isNotNull()))

    return F.transform(F.array(F.split(words, " ")), places)[0]


def _local_table(spark, names, rows):
    """A table of a few rows, in the plan itself."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def template_table(statements: dict, notices: dict) -> list:
    """(template, label, unit, words, fewest words that must be there) of each template."""
    kinds = [("line", statements, STATEMENT_THRESHOLD), ("paragraph", notices, NOTICE_THRESHOLD)]
    found = [(label, unit, _template_words(text), share) for unit, of, share in kinds for label, text in of.items()]
    return [(i, label, unit, words, ceil(share * len(words) - 1e-9)) for i, (label, unit, words, share) in enumerate(found) if words]


def word_frequencies(df: DataFrame, vocabulary, text: str = "text") -> dict:
    """How often each word of a vocabulary occurs in all texts; one row per word."""
    each = df.select(F.explode(F.split(words_of(F.col(f"`{text}`")), " ")).alias("word"))
    found = each.filter(F.col("word").isin(sorted(vocabulary))).groupBy("word").agg(F.count("*").alias("n"))
    return {word: 0 for word in vocabulary} | {r["word"]: r["n"] for r in found.collect()}


def scan_licenses(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    statements: dict = STATEMENTS,
    notices: dict = NOTICES,
    phrases: dict = PHRASES,
) -> DataFrame:
    """For every row of ``df``: the key, n_words, n_base (places of phrases), first_word and
    last_word (their smallest and largest start, words from 0; else missing), base_labels
    (of the phrases), labels (with those of templates found; both sorted, joined by commas),
    score (the largest share of a found template's words that one block has; 0 without).

    ``phrases`` from words to labels stand word by word, at least one is needed. Of
    ``statements``, label to text, a line must have all words, of ``notices`` a stretch
    between empty lines four in five; order and other words make no difference, and blocks
    may be of any length. Templates are few: their words go into the plan, and a count for
    each is all that reaches the driver.

    Missing and empty texts have no words. Keys may repeat or be missing: each row is judged
    by itself. Other columns are not read. No rows give no rows.
    """
    templates = template_table(statements, notices)
    seen = word_frequencies(df, {w for *_, words, _ in templates for w in words}, text) if templates else {}
    by_rank = sorted(seen, key=lambda w: (seen[w], w))
    order = {w: i for i, w in enumerate(by_rank)}
    heads = []
    for i, label, unit, words, least in templates:
        ranks = sorted(order[w] for w in words)
        heads += [(r, at, unit, label, len(ranks), least, ranks) for at, r in enumerate(ranks[: len(ranks) - least + 1])]

    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), words_of(F.col(f"`{text}`")).alias("words"))
    blocks = []
    for unit, cut in _UNITS.items():
        rare = sorted({by_rank[h[0]] for h in heads if h[2] == unit})
        # A text without a word of any prefix is not cut, a block without is not kept.
        parts = F.filter(F.transform(F.split("text", cut), words_of), lambda b: b.rlike(_any_of(rare)))
        found = F.when(F.col("words").rlike(_any_of(rare)), parts) if rare else F.lit(None).cast("array<string>")
        blocks.append(found.alias(unit))
    n_blanks = F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit("")))
    scanned = rows.select(
        F.monotonically_increasing_id().alias("row"),
        "key",
        F.when(F.col("words") == "", 0).otherwise(n_blanks + 1).cast("long").alias("n_words"),
        F.when(F.col("words").rlike(_any_of(phrases)), _phrase_places(F.col("words"), phrases)).alias("places"),
        *blocks,
    )
    scanned = staged(scanned, "license-rows")
    found = _joined_templates(scanned, order, heads) if heads else scanned.select("row", F.lit("").alias("label"), F.lit(0.0).alias("share")).limit(0)
    by_row = found.groupBy("row").agg(F.collect_set("label").alias("labels"), F.max("share").alias("score"))
    none = F.array().cast("array<string>")
    base = F.array_distinct(F.coalesce("places.label", none))
    every = F.array_distinct(F.concat(base, F.coalesce("labels", none)))
    return scanned.join(by_row, "row", "left").select(
        F.col("key").alias(key),
        "n_words",
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min("places.at").alias("first_word"),
        F.array_max("places.at").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _joined_templates(scanned, order, heads):
    """row, label and share of the templates found in the blocks of ``scanned``."""
    spark = scanned.sparkSession
    ranked = _local_table(spark, ["word", "rank"], order.items())
    names = ["rank", "place", "unit", "label", "n", "least", "template"]
    prefixes = _local_table(spark, names, heads)
    units = [scanned.select("row", F.lit(u).alias("unit"), F.posexplode(u).alias("block", "words")) for u in _UNITS]
    words = reduce(DataFrame.union, units).select("row", "unit", "block", F.explode(F.array_distinct(F.split("words", " "))).alias("word"))
    # Words of templates only, so a block's set is no larger than all templates together.
    sets = words.join(F.broadcast(ranked), "word").groupBy("row", "unit", "block")
    sets = sets.agg(F.sort_array(F.collect_list("rank")).alias("ranks")).withColumn("size", F.size("ranks"))
    meets = sets.select("*", F.posexplode("ranks").alias("at", "rank")).join(F.broadcast(prefixes), ["rank", "unit"])
    long_enough = F.col("size") >= F.col("least")
    in_prefix = F.col("at") <= F.col("size") - F.col("least")
    in_reach = F.least(F.col("n") - F.col("place"), F.col("size") - F.col("at")) >= F.col("least")
    shared = F.size(F.array_intersect("ranks", "template")).alias("shared")
    pairs = meets.filter(long_enough & in_prefix & in_reach).select("row", "label", "n", "least", shared)
    return pairs.filter("shared >= least").select("row", "label", (F.col("shared") / F.col("n")).alias("share"))


def scan_sql(table: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """The same rows as ``scan_licenses`` with its defaults, in DuckDB's SQL: every template
    against every block."""

    def listed(words):
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    words = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    templates = ",\n  ".join(f"('{label}', '{unit}', {listed(of)}, {least})" for _, label, unit, of, least in template_table(STATEMENTS, NOTICES))
    phrases = ",\n  ".join(f"('{label}', {listed(p.split(' '))})" for p, label in PHRASES.items())
    return f"""
with docs as (
  select {key}, t, regexp_extract_all(t, {words}) as w
  from (select {key}, translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}') as t from {table}) a
),
templates(label, unit, words, least) as (values
  {templates}
),
phrases(label, p) as (values
  {phrases}
),
blocks as (
  select {key}, 'line' as unit, unnest(string_split(t, chr(10))) as b from docs union all
  select {key}, 'paragraph', unnest(regexp_split_to_array(t, '\\n[\\x20\\x09\\x0B-\\x0D]*\\n')) from docs
),
sets as (select {key}, unit, list_distinct(regexp_extract_all(b, {words})) as s from blocks),
hits as (
  select {key}, label, cast(len(list_intersect(s, words)) as double) / len(words) as share
  from sets join templates using (unit) where len(list_intersect(s, words)) >= least
),
found as (select {key}, list(distinct label) as labels, max(share) as score from hits group by {key}),
places as (
  select {key}, label, i - 1 as at_word
  from (select {key}, w, unnest(range(1, len(w) + 1)) as i from docs) x join phrases on w[i:i + len(p) - 1] = p
),
base as (
  select {key}, count(*) as n, min(at_word) as first_word, max(at_word) as last_word, list(distinct label) as labels
  from places group by {key}
)
select {key}, cast(len(w) as bigint) as n_words, coalesce(n, 0) as n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') as base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ',') as labels,
       coalesce(score, 0.0) as score
from docs left join base using ({key}) left join found using ({key})"""
