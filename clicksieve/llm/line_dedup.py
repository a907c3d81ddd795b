"""Dropping lines whose template recurs across documents.

Each line walks a tree of fixed depth. Its first level is the number of tokens,
the next ones are the leading tokens, with variable fields (tokens that hold a
digit or an @) replaced by a wildcard. Below a leaf the rest of the line is cut
into ``PARTS`` parts of almost equal length. A template of the leaf fixes all
parts, or all but one, which then stands for a field that varies: lines of a
leaf that agree outside one part share a template, whatever the part holds.
Where fewer than ``MIN_CONSTANT`` of the tokens are constant (rows of numbers),
the wildcards would say nothing: such a line recurs by its unmasked text only.

A template that occurs in at least ``min_docs`` documents recurs. Its lines are
dropped from every document but the first (smallest id), so a text that many
documents share stays in the corpus once. Short templates say less, since running
text repeats a word or a greeting by itself: lines without a rest below the leaf,
and open templates of lines with fewer than two tokens a part, recur from
``SHORT_TIMES`` times ``min_docs`` documents and ``SHORT_PERCENT`` of all documents
on, whichever is more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicksieve.functions.unfold import bind, unfold
from clicksieve.llm.common import BLANK, BLANKS, keep_table, replace_columns, words_of

WILDCARD = "<*>"  # fixed value
DEPTH = 3  # leading tokens that are levels of the tree
PARTS = 4  # parts of the rest; one of them may vary
MIN_CONSTANT = 0.5  # least share of constant tokens in a masked template
MIN_DOCS = 5
SHORT_TIMES = 4  # so many times MIN_DOCS for a short template
SHORT_PERCENT = 1  # and so many of a hundred documents


def template_keys(line: Column, depth: int = DEPTH, parts: int = PARTS) -> Column:
    """Hashes of the templates a line belongs to; none for a blank line.

    The first is the line with its variable fields as wildcards, the others leave
    one part open. Lines that end within the leaf have the first only, lines of
    mostly variable fields the hash of their unmasked tokens. The lowest bit of a
    hash is 1 for a short template.
    """
    variable = r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*"
    masked = F.when(line.rlike("[0-9@]"), F.regexp_replace(line, variable, WILDCARD)).otherwise(line)

    def keys(tokens: Column) -> Column:
        n = F.size(tokens)
        rest = n - depth
        at = [F.lit(depth + 1) + F.floor(rest * i / parts).cast("int") for i in range(parts + 1)]
        pieces = F.array(*[F.xxhash64(F.slice(tokens, at[i], at[i + 1] - at[i])) for i in range(parts)],
                         F.xxhash64(n, *[F.element_at(tokens, i + 1) for i in range(depth)]))

        def flagged(key: Column, short: Column) -> Column:
            return F.shiftleft(key, 1).bitwiseOR(F.when(short, F.lit(1)).otherwise(F.lit(0)).cast("long"))

        def combine(p: Column) -> Column:
            opened = [F.xxhash64(F.lit(i), p[parts], *[p[j] for j in range(parts) if j != i]) for i in range(parts)]
            return F.array(F.shiftleft(F.xxhash64(F.lit(-1), p), 1), *[flagged(o, rest < 2 * parts) for o in opened])

        none = F.array().cast("array<bigint>")
        constant = F.size(F.array_remove(tokens, WILDCARD))
        return F.when(n == 0, none).when(
            constant < n * MIN_CONSTANT, F.array(flagged(F.xxhash64(F.lit(-2), words_of(line)), rest <= 0))).when(
            rest <= 0, F.array(flagged(F.xxhash64(F.lit(-1), n, tokens), F.lit(True)))).otherwise(bind(pieces, combine))

    # bound, since words_of reads its text twice
    return bind(masked, lambda m: bind(words_of(m), keys))


def recurring_lines(lines: DataFrame, min_docs: int, short_docs: int) -> DataFrame:
    """(id, hash, pos) of the lines to drop from a table (id, hash, pos, keys)."""
    least = F.when(F.col("key").bitwiseAND(1) == 1, short_docs).otherwise(min_docs)
    keyed = unfold(lines, ["id", "hash", "pos"], F.col("keys"), "key")
    per_doc = keyed.filter(F.col("id").isNotNull()).groupBy("key", "id").agg(F.lit(1).alias("one"))
    recurring = per_doc.groupBy("key").agg(F.count("*").alias("docs"), F.min("id").alias("first")) \
        .filter(F.col("docs") >= least).select("key", "first")
    return keyed.join(recurring, "key").filter(F.col("id") > F.col("first")).select("id", "hash", "pos")


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         min_docs: int = MIN_DOCS) -> DataFrame:
    """Documents without recurring lines, with n_lines and n_dropped added.

    Lines end at ``\\n``. Blank lines stay. Rows with an id count as documents.
    A null text stays null with 0 lines, an empty text is one line. A document
    with a null id keeps its lines and counts for no template. Rows that share an
    id count as one document and keep the lines that are first in it. An empty
    table gives an empty table. Columns named n_lines or n_dropped are replaced.
    """
    text = F.col(text_col)
    tagged = docs.withColumn("__hash", F.xxhash64(F.coalesce(text, F.lit(""))))
    lines = tagged.select(F.col(id_col).alias("id"), F.col("__hash").alias("hash"),
                          F.posexplode_outer(F.split(text, "\n")).alias("pos", "line")) \
        .filter(F.col("line").isNotNull())
    # blank lines have no keys; a filter on the keys would compute them twice
    full = lines.filter(F.trim("line", F.lit(BLANKS)) != "")
    lines = keep_table(full.select("id", "hash", "pos", template_keys(F.col("line")).alias("keys")), "lines")
    n_docs = docs.select(F.count(id_col)).first()[0]
    short_docs = max(SHORT_TIMES * min_docs, -(-SHORT_PERCENT * n_docs // 100))
    gone = recurring_lines(lines, min_docs, short_docs).groupBy("id", "hash").agg(F.collect_set("pos").alias("__gone"))
    out = tagged.join(gone, (tagged[id_col] == gone.id) & (tagged["__hash"] == gone.hash), "left") \
        .drop(gone.id, gone.hash)
    rows = F.split(text, "\n")
    kept = bind(rows, lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone")), lambda i: lines[i]), "\n"))
    return replace_columns(out, {
        text_col: F.when(F.col("__gone").isNull(), text).otherwise(kept),
        "n_lines": F.coalesce(F.when(text.isNotNull(), F.size(rows)), F.lit(0)),
        "n_dropped": F.coalesce(F.size("__gone"), F.lit(0)),
    }).drop("__gone", "__hash")
