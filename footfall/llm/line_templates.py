"""Line dedup by a log-template tree, in DataFrame operations only.

A line's tokens are its runs of non-space characters; a token with a digit is a variable field and
becomes ``<*>``. The tree has a fixed depth: token count first, then the ``depth`` leading masked
tokens; lines of one leaf differ in later tokens only. Two kinds of template recur:

* the masked line itself, when at least ``min_docs`` documents hold it;
* a leaf's generalised templates, of which it can have any number: in each line the tokens of later
  positions are ranked by how many of the leaf's different lines have them there; for every such
  count that occurs in the line, the tokens with at least that count (at least two) are constants
  and the others variables. With the leading tokens, constants make up ``similarity`` of the tokens.
  The template recurs when ``min_docs`` documents hold a line that has it.

Documents with the same set of masked lines are copies of one document and count once, so that
copies don't make their own text recur; a document that is mostly boilerplate counts like any other.
Each line with a recurring template is dropped from every document, however short; lines without a token
are no lines of text and stay.

Defined cases: a null text stays null and an empty one empty; a document that loses all its lines
keeps an empty text; documents without a key are known by their text; rows equal in key and text
are one document to the counts and are all rewritten; an empty table gives an empty table; further
columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.session import materialise

MASK = "<*>"
TEMPLATE = ["t", "t2"]
DOCUMENT = ["d", "d2"]


def masked(text: Column) -> Column:
    """The text with every token that has a digit replaced, and with spaces as its only blanks in lines."""
    field = "[^ \\t\\n\\x0B\\f\\r0-9]*+[0-9][^ \\t\\n\\x0B\\f\\r]*"
    fields = F.when(text.rlike("[0-9]"), F.regexp_replace(text, field, F.lit(MASK))).otherwise(text)
    blanks = F.translate(fields, "\t\r\x0b\x0c", "    ")
    return F.when(text.rlike("[\\t\\r\\x0B\\f]"), blanks).otherwise(fields)


def tokens(line: Column) -> Column:
    """Tokens of a masked line; a line without any has one empty token."""
    trimmed = F.trim(line)
    # a pattern of one plain character is split without a regular expression
    return F.when(trimmed.contains("  "), F.split(trimmed, " +")).otherwise(F.split(trimmed, " "))


def place(words: Column, depth: int) -> list[Column]:
    """Template (two hashes), leaf and token count."""
    return [
        F.xxhash64(words).alias("t"),
        F.xxhash64(F.lit(1), words).alias("t2"),
        F.xxhash64(F.size(words), F.slice(words, 1, depth)).alias("leaf"),
        F.size(words).alias("n"),
    ]


def document(key: Column, text: Column) -> list[Column]:
    return [F.xxhash64(key, text).alias("d"), F.xxhash64(F.lit(1), text, key).alias("d2")]


def line_rows(docs: DataFrame, key: Column, text: Column) -> DataFrame:
    """``d, d2, i, w``: the tokens of each line and its number, from 0."""
    lines = docs.select(*document(key, text), F.posexplode(F.split(masked(text), "\n")).alias("i", "line"))
    return lines.select(*DOCUMENT, "i", tokens(F.col("line")).alias("w"))


def general_members(
    docs: DataFrame, key: Column, text: Column, leaves: DataFrame, templates: DataFrame, min_docs: int, depth: int, similarity: float
) -> DataFrame:
    """``p, p2, t, t2, sure``: generalised templates that may recur, and the different lines that have them.

    A template with a line that recurs by itself is ``sure`` to recur: nothing need be counted for it.
    """
    lines = line_rows(docs, key, text).select("w", *place(F.col("w"), depth))
    lines = lines.join(leaves, "leaf", "left_semi").dropDuplicates(TEMPLATE)
    rest = F.posexplode(F.slice("w", depth + 1, F.greatest(F.col("n") - depth, F.lit(0))))
    spots = materialise(lines.select("leaf", *TEMPLATE, "n", rest.alias("pos", "token")), "leaf-spots")
    spot = ["leaf", "pos", "token"]
    common = materialise(spots.groupBy(*spot).agg(F.count("*").alias("c")).where("c > 1"), "leaf-tokens")
    ranked = Window.partitionBy(*TEMPLATE).orderBy(F.desc("c"))  # equal counts come in together
    pattern = spots.join(common, spot).select(
        "leaf", *TEMPLATE, "n", F.count("*").over(ranked).alias("constants"),
        F.bit_xor(F.xxhash64(*spot)).over(ranked).alias("p"),
        F.bit_xor(F.xxhash64(F.lit(1), *spot)).over(ranked).alias("p2"),
    )
    # without a variable it is the line itself
    wide = pattern.where((F.col("constants") + depth >= similarity * F.col("n")) & (F.col("constants") + depth < F.col("n")))
    wide = wide.dropDuplicates(["p", "p2", *TEMPLATE]).join(templates.select(*TEMPLATE, "docs"), TEMPLATE)
    wide = materialise(wide.select("p", "p2", *TEMPLATE, "docs"), "patterns")
    held = wide.groupBy("p", "p2").agg(F.sum("docs").alias("most"), (F.max("docs") >= min_docs).alias("sure"))
    return wide.join(held.where(F.col("most") >= min_docs).drop("most"), ["p", "p2"]).drop("docs")


def recurring(
    docs: DataFrame,
    key: Column,
    text: Column,
    min_docs: int = 10,
    depth: int = 3,
    similarity: float = 0.7,
) -> DataFrame:
    """``d, d2, gone``: the documents that lose lines, and the numbers of those lines."""
    filled = F.col("w")[0] != ""
    found = line_rows(docs, key, text).select(*DOCUMENT, "i", *place(F.col("w"), depth), filled.alias("filled"))
    found = found.where(F.col("filled"))
    lines = materialise(
        found.groupBy(*DOCUMENT, *TEMPLATE, "leaf", "n").agg(F.collect_set("i").alias("at")), "lines"
    )
    often = F.col("docs") >= min_docs
    # a set's hash does not depend on the order of its lines
    sets = lines.groupBy(*DOCUMENT).agg(
        F.bit_xor("t").alias("s"), F.bit_xor("t2").alias("s2"), F.count("*").alias("size")
    )
    first = sets.groupBy("s", "s2", "size").agg(F.min(F.struct(*DOCUMENT)).alias("first")).select("first.*")
    first = materialise(first, "first-copies")
    counted = materialise(lines.join(first, DOCUMENT, "left_semi").select(*DOCUMENT, *TEMPLATE, "leaf"), "counted-lines")

    templates = materialise(counted.groupBy("leaf", *TEMPLATE).agg(F.count("*").alias("docs")), "templates")
    leaves = templates.groupBy("leaf").agg(F.sum("docs").alias("docs"), F.count("*").alias("kinds"))
    leaves = materialise(leaves.where(often & (F.col("kinds") > 1)).select("leaf"), "leaves")
    members = general_members(docs, key, text, leaves, templates, min_docs, depth, similarity)
    members = materialise(members, "members")
    # lines of the other templates are each in fewer than ``min_docs`` documents, so no key is hot
    general = (
        counted.select(*DOCUMENT, *TEMPLATE).join(members.where("not sure"), TEMPLATE).select("p", "p2", *DOCUMENT).distinct()
        .groupBy("p", "p2").agg(F.count("*").alias("docs")).where(often)
    )
    bad = templates.where(often).select(*TEMPLATE).union(members.where("sure").select(*TEMPLATE)).union(
        members.where("not sure").join(general, ["p", "p2"], "left_semi").select(*TEMPLATE)
    )
    bad = materialise(bad.distinct(), "bad-templates")
    return lines.join(bad, TEMPLATE, "left_semi").groupBy(*DOCUMENT).agg(
        F.flatten(F.collect_list("at")).alias("gone")
    )


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores before them as none of the columns has."""
    taken = {c.lower() for c in df.columns}
    lead = "_"
    while any(f"{lead}{n}".lower() in taken for n in names):
        lead += "_"
    return [f"{lead}{n}" for n in names]


def drop_recurring(docs: DataFrame, key: str = "doc_id", text: str = "text", **rules) -> DataFrame:
    """``docs`` with the recurring lines taken out of ``text``; every row stays."""
    rest, lines = free_names(docs, "rest", "lines")
    marked = mark_recurring(docs, key, text, rest, lines, **rules)
    return marked.select(*[F.col(rest).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def mark_recurring(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rest: str = "rest", lines: str = "lines", **rules
) -> DataFrame:
    """All rows and columns of ``docs``, with ``rest`` (the text that stays) and ``lines`` (numbers of those that don't, or null).

    The names of both new columns must be free.
    """
    k, body = F.col(f"`{key}`"), F.col(f"`{text}`")
    d, d2, gone = free_names(docs, "d", "d2", "gone")
    found = materialise(recurring(docs, k, body, **rules), "gone").select(
        F.col("d").alias(d), F.col("d2").alias(d2), F.array_sort("gone").alias(gone)
    )
    own, own2 = document(k, body)
    joined = docs.join(found, (own == F.col(d)) & (own2 == F.col(d2)), "left")

    def kept(all_lines: Column) -> Column:
        numbers = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col(gone))
        return F.array_join(F.transform(numbers, lambda i: F.get(all_lines, i)), "\n")

    # one lambda holds the lines, so that the text is split once
    whole = F.transform(F.array(F.split(body, "\n")), kept)[0]
    return joined.withColumn(rest, F.when(F.col(gone).isNull(), body).otherwise(whole)).withColumnRenamed(gone, lines).drop(d, d2)
