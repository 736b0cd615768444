"""Line dedup by a log-template tree, in DataFrame functions only.

Lines are parsed by a tree of fixed depth.  A line's tokens are its runs of
anything but white space; tokens with a digit are variable fields and read as
``<*>``.  The tree branches by the number of tokens, then by the first
``depth`` tokens; lines of one leaf differ in later tokens only.  In a leaf, a
token at a place is constant if lines of ``min_docs`` texts have it there, and
a variable field otherwise.  A line's template is its leaf with its constant
tokens in their places; it counts only if at least ``similarity`` of the
tokens are constant, else the line stands for itself.

A template that recurs, i.e. whose lines occur in ``min_docs`` different texts
or more, is dropped from every document but the one with the smallest id, so
that no content goes from the corpus altogether.  So is a line that recurs
exactly, token by token, in ``exact_docs`` texts, or ``short_docs`` if it has
fewer than ``min_tokens`` tokens; such short lines have no variable fields.

What is counted is (line, text): equal texts count once, a line that a text
repeats counts once, and two lines of one template in one text count twice.

Defined cases: a null text stays null; a text that loses all lines becomes
empty; blank lines stay; rows with the same id and text are treated alike (all
keep the template, or none); a null id counts as larger than any other id;
very long lines and texts need no special care; an empty table gives an empty
one; extra columns pass through, but for those that ``lines`` and ``dropped`` name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import SMALL_BYTES, free, small, written

# A token with a digit, and white space inside a line that isn't one space.
FIELD = r"(?<!\S)[^\s0-9]*+[0-9]\S*+"
SPACES = r"[ \t\x0B\f\r]{2,}+|[\t\x0B\f\r]"


def spaced(line: Column) -> Column:
    """The line with single spaces between tokens."""
    return F.when(line.rlike(r"[\t\x0B\f\r]|  "),
                  F.trim(F.regexp_replace(line, SPACES, " "))).otherwise(F.trim(line))


def masked(line: Column) -> Column:
    """A spaced line with ``<*>`` for tokens with a digit."""
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, FIELD, "<*>")).otherwise(line)


def parsed_lines(docs: DataFrame, key: str, text: str, depth: int, min_tokens: int) -> DataFrame:
    """(id, text_hash, at, line, tokens, leaf, exact): the lines that aren't blank, masked.

    A line of fewer than ``min_tokens`` tokens isn't masked and is a leaf of its own.
    ``exact``: hash of the line itself if masking changed it, else null.
    """
    # masked inside the array, so that a line is masked once, whatever reads it
    lines = F.transform(F.transform(F.split(F.col(text), "\n"), spaced),
                        lambda x: F.struct(x.alias("plain"), F.size(F.split(x, " ")).alias("tokens"),
                                           masked(x).alias("line")))
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("text_hash"),
                       F.posexplode(lines).alias("at", "both"))
    short = F.col("tokens") < min_tokens
    rows = (rows.select("id", "text_hash", "at", "both.*").where("plain <> ''")
            .withColumn("line", F.when(short, F.col("plain")).otherwise(F.col("line"))))
    start = F.when(short, F.col("line")).otherwise(F.substring_index("line", " ", depth))
    return (rows.withColumn("leaf", F.xxhash64("tokens", start))
            .withColumn("exact", F.when(F.col("plain") != F.col("line"), F.xxhash64("plain"))).drop("plain"))


def recurring_lines(docs: DataFrame, rows: DataFrame, key: str, text: str, depth: int, min_tokens: int,
                    min_docs: int, similarity: float, exact_docs: int, short_docs: int) -> DataFrame:
    """(leaf, hash, keeper): the lines whose template recurs or that recur with
    all tokens constant, and the id that keeps them.

    ``rows``: (id, text_hash, at, leaf, hash, exact, short) of all parsed lines.
    """
    least = F.when(F.col("short"), short_docs).when(F.col("exact").isNull(), exact_docs).otherwise(min_docs)
    lines = (rows.withColumn("least", least)
             .groupBy("leaf", "hash", "text_hash").agg(F.min("id").alias("id"), F.max("least").alias("least"))
             .groupBy("leaf", "hash").agg(F.count("*").alias("n"), F.min("id").alias("first"),
                                          F.max("least").alias("least")))
    lines = written(lines, "lines")
    # leaves in which something can recur, and where lines differ
    leaves = (lines.groupBy("leaf").agg(F.sum("n").alias("m"), F.count("*").alias("variants"))
              .where(F.col("m") >= min_docs))
    leaves = written(leaves, "leaves")
    alone = lines.where("n >= least").select("leaf", "hash", F.col("first").alias("keeper"))
    mixed = small(leaves.where("variants > 1").select("leaf"), 8)
    # the tokens of each distinct line in the other leaves
    spelled = (parsed_lines(docs, key, text, depth, min_tokens).select("leaf", "line")
               .join(mixed, "leaf").withColumn("hash", F.xxhash64("line"))
               .groupBy("leaf", "hash").agg(F.min("line").alias("line")))
    spelled = written(spelled.join(lines, ["leaf", "hash"]), "spelled")
    tokens = spelled.select("leaf", "hash", "n", F.posexplode(F.split("line", " ")).alias("at", "token"))
    tokens = tokens.withColumn("token", F.xxhash64("token"))
    constant = (tokens.groupBy("leaf", "at", "token").agg(F.sum("n").alias("c"))
                .where(F.col("c") >= min_docs).select("leaf", "at", "token"))
    # an order-free digest of (place, token) over the constant tokens of a line
    shape = (tokens.join(written(constant, "constant"), ["leaf", "at", "token"])
             .groupBy("leaf", "hash")
             .agg(F.count("*").alias("k"),
                  F.sum(F.xxhash64("at", "token").cast("decimal(38,0)")).cast("string").alias("shape")))
    width = F.size(F.split("line", " "))
    template = F.when(F.col("k") >= similarity * width, F.col("shape")).otherwise(
        F.concat(F.lit("line "), F.col("hash").cast("string")))
    named = written(spelled.join(shape, ["leaf", "hash"], "left")
                    .select("leaf", "hash", "n", "first", template.alias("template")), "templates")
    recurring = (named.groupBy("leaf", "template")
                 .agg(F.sum("n").alias("m"), F.min("first").alias("keeper"))
                 .where(F.col("m") >= min_docs).drop("m"))
    # a template's keeper is the smaller one, as its lines include the line
    return (alone.unionByName(named.join(recurring, ["leaf", "template"]).select("leaf", "hash", "keeper"))
            .groupBy("leaf", "hash").agg(F.min("keeper").alias("keeper")))


def recurring_fields(rows: DataFrame, exact_docs: int) -> DataFrame:
    """(exact, keeper): the lines with variable fields that recur with the same fields."""
    return (rows.where("exact is not null").groupBy("exact", "text_hash").agg(F.min("id").alias("id"))
            .groupBy("exact").agg(F.count("*").alias("n"), F.min("id").alias("keeper"))
            .where(F.col("n") >= exact_docs).drop("n"))


def drop_recurring(docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = 3,
                   min_tokens: int = 4, min_docs: int = 5, similarity: float = 0.8,
                   exact_docs: int = 2, short_docs: int = 10, lines: str | None = None, dropped: str | None = None) -> DataFrame:
    """``docs`` without the lines of recurring templates (see the module text).

    ``lines`` and ``dropped`` name optional columns for the number of lines and
    of those dropped.
    """
    rows = written(parsed_lines(docs, key, text, depth, min_tokens)
                   .select("id", "text_hash", "at", "leaf", F.xxhash64("line").alias("hash"), "exact",
                           (F.col("tokens") < min_tokens).alias("short")), "rows")
    gone = written(recurring_lines(docs, rows, key, text, depth, min_tokens, min_docs, similarity, exact_docs,
                                   short_docs), "recurring")
    same = written(recurring_fields(rows, exact_docs), "recurring-fields")
    places = ["id", "text_hash", "at", "keeper"]
    drops = (rows.join(small(gone, 24), ["leaf", "hash"]).select(places)
             .unionByName(rows.where("exact is not null").join(small(same, 16), "exact").select(places))
             .where(~F.col("id").eqNullSafe(F.col("keeper")))
             .groupBy("id", "text_hash").agg(F.collect_set("at").alias("__drop")))
    names = {c: free(docs, f"__{c}") for c in ("id", "text_hash", "drop")}
    drops = written(drops.withColumnsRenamed({"id": names["id"], "text_hash": names["text_hash"],
                                              "__drop": names["drop"]}), "drops")
    gone_at = F.col(names["drop"])
    size = drops.agg(F.sum(F.size(gone_at) * 4 + 48)).first()[0] or 0
    joined = docs.join(F.broadcast(drops) if size <= SMALL_BYTES else drops,
                       docs[key].eqNullSafe(F.col(names["id"]))
                       & (F.xxhash64(docs[text]) == F.col(names["text_hash"])), "left")
    kept = F.when(gone_at.isNull(), docs[text]).otherwise(F.array_join(
        F.filter(F.split(docs[text], "\n"), lambda x, i: ~F.array_contains(gone_at, i)), "\n"))
    out = [kept.alias(c) if c == text else docs[c] for c in docs.columns if c not in (lines, dropped)]
    if lines:
        out.append(F.coalesce(F.size(F.split(docs[text], "\n")), F.lit(0)).alias(lines))
    if dropped:
        out.append(F.when(gone_at.isNull(), 0).otherwise(F.size(gone_at)).alias(dropped))
    return joined.select(*out)
