"""License scan by a positional index of rare license words, in DataFrame operations only.

Texts are lower-cased in A-Z; words are runs of ASCII letters and digits and of all characters beyond
ASCII. A template is a license name or notice with a label, its words, and key phrases that a match
must hold. The index has, per template, the places of its rarest words: those of highest inverse document
frequency in the scanned corpus, one for a name and a third of a notice's words (two to eight) otherwise.

* A file's highest-IDF license words are those of its words that the index holds; each is looked up, however
  many there are.
* Word ``p`` of the file and place ``q`` of a template put the template at ``p - q``. Postings of
  one template that agree on that relative position are intersected by sorting them; a name needs its one rare
  word, a notice two of them (three of eight).
* Around each such place, all key phrases of the template must stand word for word. Names have no
  slack: the phrase stands exactly there. Notices have some words of slack on both sides, as a copy may
  have a few words more or less. A match's share is the part of the template's different words found there.

A row is handled where it lies: nothing is shuffled but the counts of license words, whose number is that
of the templates' words. The driver holds these counts only.

Defined cases: null and empty texts have no words, no places, empty label lists and score 0; repeated rows and
rows without an id are scanned each for itself; an empty table gives an empty table; equally rare words are
taken in alphabetical order; long texts take time in proportion to their length; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value of the contract: what stands between words, after lower-casing.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]
    name: bool = False

    @cached_property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def slack(self) -> int:
        return 0 if self.name else 4 + len(self.words) // 4

    @property
    def rare(self) -> int:
        return 1 if self.name else min(8, max(2, len(self.words) // 3))

    @property
    def agree(self) -> int:
        return 1 if self.name else 2 + (self.rare >= 8)


#: License names of the contract.
NAMES = [
    Template("gpl", "gnu general public license", ("gnu general public license",), True),
    Template("apache", "apache license", ("apache license",), True),
    Template("cc-by", "cc by", ("cc by",), True),
    Template("mit", "mit license", ("mit license",), True),
]

#: The usual short notices of public licenses, and what a match must hold.
NOTICES = [
    Template("mit-notice", "released under the mit license", ("under the mit license",)),
    Template("mit-notice", "licensed under the mit license", ("licensed under the mit license",)),
    Template(
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template(
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at",
        ("apache license version 2 0", "except in compliance with the license"),
    ),
    Template(
        "gpl-3.0", "this work is licensed under the gnu general public license version 3",
        ("gnu general public license version 3",),
    ),
    Template(
        "gpl-2.0", "this work is licensed under the gnu general public license version 2",
        ("gnu general public license version 2",),
    ),
    Template(
        "gpl-notice",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version",
        ("free software", "gnu general public license as published"),
    ),
    Template(
        "lgpl-notice",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
        "general public license as published by the free software foundation either version",
        ("gnu lesser general public license",),
    ),
    Template(
        "agpl-notice",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero "
        "general public license as published by the free software foundation either version",
        ("gnu affero general public license",),
    ),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-nd-4.0", "licensed under cc by nd 4 0", ("cc by nd 4 0",)),
    Template(
        "cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0 international",),
    ),
    Template(
        "bsd-notice",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer",
        ("redistribution and use in source and binary forms", "following conditions are met"),
    ),
    Template(
        "isc-text",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        ("with or without fee is hereby granted",),
    ),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at",
        ("mozilla public license v 2 0",),
    ),
    Template(
        "unlicense", "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
]

TEMPLATES = NAMES + NOTICES


def words_of(text: Column) -> Column:
    """Words of a text, lower-cased in A-Z; null has none."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, BETWEEN), "")


def array_of(values: list, kind: str) -> Column:
    """A literal array, of the type even when it is empty."""
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def document_counts(rows: DataFrame, templates: list[Template]) -> dict[str, int]:
    """In how many rows each of the templates' words stands; ``rows`` have ``words``."""
    known = sorted({w for t in templates for w in t.words})
    own = rows.select(F.explode(F.array_intersect("words", array_of(known, "string"))).alias("word"))
    found = {r.word: r["count"] for r in own.groupBy("word").count().collect()}  # a row per template word at most
    return {w: found.get(w, 0) for w in known}


def postings(templates: list[Template], counts: dict[str, int]) -> dict[str, list[tuple[int, int]]]:
    """``(template, place)`` of each indexed word."""
    index: dict[str, list[tuple[int, int]]] = {}
    for number, template in enumerate(templates):
        rarest = sorted(set(template.words), key=lambda w: (counts[w], w))[: template.rare]
        for place, word in enumerate(template.words):
            if word in rarest:
                index.setdefault(word, []).append((number, place))
    return index


def matches(words: Column, templates: list[Template], index: dict[str, list[tuple[int, int]]]) -> Column:
    """``t, d, share`` of every verified place ``d`` of template ``t``."""
    if not index:
        return F.array().cast("array<struct<t:int,d:int,share:double,holds:boolean>>")
    none = F.array().cast("array<struct<t:int,d:int>>")
    entry = "array<struct<t:int,q:int>>"
    at = F.create_map(
        *[
            c
            for word, places in index.items()
            for c in (F.lit(word), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(q).alias("q")) for t, q in places]).cast(entry))
        ]
    )
    agree = array_of([t.agree for t in templates], "int")
    size = array_of([len(t.words) for t in templates], "int")
    slack = array_of([t.slack for t in templates], "int")
    keys = F.array(*[array_of([f" {k} " for k in t.keys], "string") for t in templates])
    different = F.array(*[array_of(sorted(set(t.words)), "string") for t in templates])

    spots = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda p: F.get(words, p).isin(*index))
    placed = F.flatten(
        F.transform(
            spots,
            lambda s: F.transform(
                F.element_at(at, F.get(words, s)), lambda e: F.struct(e["t"].alias("t"), (s - e["q"]).alias("d"))
            ),
        )
    )
    # rows without a license word skip the walk over their words
    found = F.when(F.arrays_overlap(words, array_of(list(index), "string")), F.array_sort(placed)).otherwise(none)

    def places(ordered: Column) -> Column:
        """The first of each stretch of equal postings that is as long as the template asks."""
        heads = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: ((i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))
            & F.coalesce(F.get(ordered, i + F.get(agree, F.get(ordered, i)["t"]) - 1) == F.get(ordered, i), F.lit(False)),
        )
        return F.when(F.size(ordered) > 0, F.transform(heads, lambda h: F.get(ordered, h))).otherwise(none)

    def judged(place: Column) -> Column:
        t, d = place["t"], place["d"]
        around = F.get(slack, t)
        first = F.greatest(d - around, F.lit(0))
        part = F.slice(words, first + 1, F.greatest(d + F.get(size, t) + around - first, F.lit(0)))
        text = F.concat(F.lit(" "), F.array_join(part, " "), F.lit(" "))
        known = F.get(different, t)
        return F.struct(
            t.alias("t"),
            d.alias("d"),
            (F.size(F.array_intersect(known, part)) / F.size(known)).alias("share"),
            F.forall(F.get(keys, t), lambda key: F.contains(text, key)).alias("holds"),
        )

    # one lambda holds the sorted postings, so that they are sorted once
    whole = F.flatten(F.transform(F.array(found), lambda o: F.transform(places(o), judged)))
    return F.filter(whole, lambda m: m["holds"])


def scan(docs: DataFrame, key: Column, text: Column, templates: list[Template] | None = None) -> DataFrame:
    """``doc_id, n_words, matches`` per row; a match has ``label, name, d, share``."""
    templates = TEMPLATES if templates is None else templates
    rows = docs.select(key.alias("doc_id"), words_of(text).alias("words"))
    index = postings(templates, document_counts(rows, templates))
    labels = array_of([t.label for t in templates], "string")
    names = array_of([t.name for t in templates], "boolean")
    found = rows.select("doc_id", "words", matches(F.col("words"), templates, index).alias("found"))
    return found.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.transform(
            "found",
            lambda m: F.struct(
                F.get(labels, m["t"]).alias("label"), F.get(names, m["t"]).alias("name"), m["d"].alias("d"), m["share"].alias("share")
            ),
        ).alias("matches"),
    )


def digest(scanned: DataFrame) -> DataFrame:
    """Counts, places and label lists per row of ``scan``."""
    rows = scanned.select("*", F.filter("matches", lambda m: m["name"]).alias("base"))

    def labels(of: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda m: m["label"]))), ",")

    starts = F.transform("base", lambda m: m["d"].cast("long"))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels("base").alias("base_labels"),
        labels("matches").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"),
    )


def oracle(templates: list[Template] | None = None) -> str:
    """The same as ``digest(scan(documents))`` in DuckDB's SQL: joins and counts in place of the index."""
    templates = TEMPLATES if templates is None else templates

    def quoted(values) -> str:
        return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"

    rows = ",\n    ".join(
        f"({i}, '{t.label}', {str(t.name).lower()}, {quoted(t.words)}, {quoted(t.keys)}, {t.slack}, {t.rare}, {t.agree})"
        for i, t in enumerate(templates)
    )
    return rf"""
WITH template(t, label, name, words, keys, slack, rare, agree) AS (
  VALUES {rows}
), doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), spot AS (
  SELECT r, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS p FROM doc
), place AS (
  SELECT t, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS q FROM template
), held AS (
  SELECT word, count(DISTINCT r) AS docs FROM spot WHERE word IN (SELECT word FROM place) GROUP BY word
), ranked AS (
  SELECT t, word, row_number() OVER (PARTITION BY t ORDER BY coalesce(docs, 0), word) AS rank
  FROM (SELECT DISTINCT t, word FROM place) LEFT JOIN held USING (word)
), posting AS (
  SELECT place.t, place.word, q FROM place JOIN ranked USING (t, word) JOIN template USING (t) WHERE rank <= rare
), candidate AS (
  SELECT r, t, p - q AS d FROM spot JOIN posting USING (word) JOIN template USING (t)
  GROUP BY r, t, d HAVING count(*) >= max(agree)
), part AS (
  SELECT r, t, d, template.words AS own, keys, doc.words[greatest(d - slack, 0) + 1 : greatest(d + len(template.words) + slack, 0)] AS words
  FROM candidate JOIN template USING (t) JOIN doc USING (r)
), verified AS (
  SELECT r, t, d, len(list_filter(list_distinct(own), lambda w: list_contains(words, w))) / len(list_distinct(own)) AS share
  FROM part
  WHERE len(list_filter(keys, lambda k: NOT contains(' ' || array_to_string(words, ' ') || ' ', ' ' || k || ' '))) = 0
), hit AS (
  SELECT r, count(*) FILTER (name) AS n, min(d) FILTER (name) AS low, max(d) FILTER (name) AS high,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (name) AS base,
         string_agg(DISTINCT label, ',' ORDER BY label) AS every, max(share) AS share
  FROM verified JOIN template USING (t) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, low::BIGINT AS first_word,
       high::BIGINT AS last_word, coalesce(base, '') AS base_labels, coalesce(every, '') AS labels,
       coalesce(share, 0)::DOUBLE AS score
FROM doc LEFT JOIN hit USING (r)
"""
