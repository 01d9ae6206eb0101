"""Lines that recur across documents with other values in their variable fields.

A log-template tree of fixed depth: lines are parted by their number of words and their
leading words. Within a leaf, a word at a place where enough documents have it is part of the
template, any other word is a variable field. (A document counts for each of its
different lines.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.tables import bounded, stored

#: Leading words in the path to a leaf.
DEPTH = 3
#: Documents in which a template must occur.
DOCUMENTS = 3
#: Least share of a line's words that its template fixes.
FIXED = 0.6
#: Leaves, and lines taken out, that may be broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Stands for a word with a digit in it.
FIELD = "<*>"


def _plain(line: Column) -> Column:
    """A line's words with one space between them; one with a digit is a field."""
    odd = line.rlike("[0-9\\t\\r\\x0B\\f]") | line.contains("  ") | line.startswith(" ") | line.endswith(" ")
    masked = F.regexp_replace(line, "[^ \\t\\r\\x0B\\f]*[0-9][^ \\t\\r\\x0B\\f]*", FIELD)
    return F.when(odd, F.trim(F.regexp_replace(masked, "[ \\t\\r\\x0B\\f]+", " "))).otherwise(line)


def _leaf(plain: Column) -> Column:
    """The place in the tree: the number of words and the leading ones."""
    return F.xxhash64(F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit(""))), F.substring_index(plain, " ", DEPTH))


def drop_recurring(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without lines whose template recurs, with ``n_lines`` and ``n_dropped``.

    A template that at least ``DOCUMENTS`` documents have and that fixes at least
    ``FIXED`` of its words recurs. Its first line stays, in order of key and place;
    every other one goes. Lines without words stay. A null text stays null and has no
    lines; an empty one has one line. Rows with a null key lose nothing and count for
    nothing. Rows that repeat a key are one document: they lose the same places, so
    equal rows stay equal. Other columns are kept; the two counts replace columns of
    their names.

    Hashes of words are shuffled for leaves only that enough documents reach. The texts
    are not, while the leaves and the places taken out are few enough to be broadcast;
    beyond, the joins shuffle them.
    """
    each = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).where("id is not null")
    each = each.select("id", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    # Asked of the raw line: a condition on its plain form would work that out twice.
    each = each.where(F.col("line").rlike("[^ \\t\\r\\x0B\\f]")).select("id", "at", _plain(F.col("line")).alias("line"))
    each = each.select("id", "at", "line", _leaf(F.col("line")).alias("leaf"))
    reach = each.groupBy("leaf", "id").agg(F.lit(1).alias("one")).groupBy("leaf").agg(F.count("*").alias("n"))
    reach = stored(reach.where(f"n >= {DOCUMENTS}").select("leaf"))
    lines = each.join(bounded(reach, BROADCAST_ROWS), "leaf")
    words = F.transform(F.split("line", " "), lambda w: F.hash(w))
    lines = stored(lines.select("leaf", F.xxhash64("line").alias("line"), "id", "at", words.alias("words")))
    # From here on a line's words are looked at once, however many documents have it.
    owners = lines.groupBy("leaf", "line", "id").agg(F.lit(1).alias("one")).groupBy("leaf", "line").agg(F.count("*").alias("n"))
    single = lines.groupBy("leaf", "line").agg(F.first("words").alias("words")).join(owners, ["leaf", "line"])
    spread = stored(single).select("leaf", "line", "n", F.size("words").alias("size"), F.posexplode("words").alias("place", "word"))
    common = spread.groupBy("leaf", "place", "word").agg(F.sum("n").alias("docs")).where(f"docs >= {DOCUMENTS}")
    fixed = spread.join(common, ["leaf", "place", "word"])
    # Fixed words add up to the template: which, where, how many of how many.
    templates = (
        fixed.groupBy("leaf", "line", "size")
        .agg(
            F.count("*").alias("fixed"),
            F.sum(F.xxhash64("place", "word").bitwiseAND(F.lit((1 << 40) - 1))).alias("h"),
            F.bit_xor(F.xxhash64("word", "place")).alias("x"),
        )
        .where(f"fixed >= {FIXED} * size")
        .select("leaf", "line", F.xxhash64("leaf", "fixed", "h", "x").alias("template"))
    )
    templates = stored(lines.select("leaf", "line", "id", "at").join(templates, ["leaf", "line"]).select("id", "at", "template"))
    recurring = (
        templates.groupBy("template", "id")
        .agg(F.min("at").alias("at"))
        .groupBy("template")
        .agg(F.count("*").alias("n"), F.min(F.struct("id", "at")).alias("first"))
        .where(f"n >= {DOCUMENTS}")
    )
    gone = (
        templates.join(recurring.select("template", "first"), "template")
        .where("id != first.id or at != first.at")
        .groupBy("id")
        .agg(F.collect_set("at").alias("gone"))
    )
    carry = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    names = [f"c{k}" for k in range(len(carry))]
    base = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(carry, names)])
    body = names[carry.index(text)]
    base = base.withColumn("id", F.col(names[carry.index(key)]).cast("long"))
    gone = stored(gone.withColumnRenamed("id", "gone_id"))
    taken = gone.select(F.explode("gone"))
    cut = base.join(bounded(gone, BROADCAST_ROWS, taken), F.col("id") == F.col("gone_id"), "left")
    parts = F.split(F.col(body).cast("string"), "\n", -1)
    kept = F.array_join(F.filter(parts, lambda line, at: ~F.array_contains("gone", at)), "\n")
    new = F.when(F.col("gone").isNull(), F.col(body)).otherwise(kept)
    n_gone = F.size(F.filter("gone", lambda at: at < F.size(parts)))
    return cut.select(
        *[(new if n == body else F.col(n)).alias(c) for n, c in zip(names, carry)],
        F.when(F.col(body).isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull() | F.col(body).isNull(), 0).otherwise(n_gone).cast("long").alias("n_dropped"),
    )


def digests(docs: DataFrame) -> DataFrame:
    """What is left of each document, as a hash."""
    left = drop_recurring(docs.select("doc_id", "text"))
    return left.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    )
