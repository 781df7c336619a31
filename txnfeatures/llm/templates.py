"""Line dedup by a log-template tree, in DataFrame operations only.

The tree has a fixed depth: a line's leaf is its number of tokens and its first
``DEPTH`` tokens, those with a digit replaced by a wildcard.  Inside a leaf a
token stays in the template where enough lines agree on it at its position; any
other position is a variable field.  A template recurs, and its lines are
dropped from all documents, on two grounds:

* without any variable field it is one line, token for token: two different
  texts that hold it are enough, however short it is;
* with variable fields it takes ``MIN_DOCS`` different texts, and at least half
  of its tokens must be fixed, so that lines alike in their shape alone stay.

Only leaves that recur are looked into, and equal lines are one row with a
count before any of their tokens is, so a line that a third of the documents
share costs as much as a rare one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnfeatures.llm.store import stored

DEPTH = 3
#: Different texts in which a line recurs token for token.
MIN_TEXTS = 2
#: Different texts in which a template with fields recurs; lines that agree on a token for it to be part of a template.
MIN_DOCS = 10
#: Fixed tokens of a template with fields, in per cent of its tokens.
FIXED_PERCENT = 50
WILD = "<*>"
TOKEN = r"([^\x20\x09-\x0D]+)"


def masked(token):
    return F.when(token.rlike("[0-9]"), F.lit(WILD)).otherwise(token)


def drop_templates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    depth: int = DEPTH,
    min_docs: int = MIN_DOCS,
    min_texts: int = MIN_TEXTS,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_lines``, ``n_dropped`` and the ``text`` that is left.

    Lines are split at ``\\n``; the ones kept are joined by it again.  A line goes
    when ``min_texts`` different texts have it token for token, or ``min_docs``
    have a line of its template: exact copies of a document count once, near
    copies are different texts and lose what they share.  A null text stays null with 0 lines, an empty one
    has one empty line; lines without tokens are never dropped.  Ids may be null
    or repeated; rows with equal id and text get equal results.  Other columns are ignored.
    """
    source = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).withColumn("seen", F.xxhash64("text"))
    lines = source.where("text IS NOT NULL").select("doc", "seen", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    tokens = F.expr(f"regexp_extract_all(line, r'{TOKEN}', 1)")
    lines = lines.withColumn("tokens", tokens).where(F.size("tokens") > 0)
    lead = F.transform(F.slice("tokens", 1, depth), masked)
    leaf = F.concat_ws(" ", F.size("tokens").cast("string"), lead)
    # Tokens travel as one string, a fraction of the array's size.
    lines = lines.select("doc", "seen", "pos", leaf.alias("leaf"), F.concat_ws(" ", "tokens").alias("body"))
    recurring = lines.select("leaf", "seen").distinct().groupBy("leaf").agg(F.count("*").alias("docs"))
    enough = F.col("docs") >= min(min_texts, min_docs)
    leaves = stored(recurring.where(enough).select("leaf", (F.col("docs") >= min_docs).alias("wide")), "leaves")
    # The planner broadcasts the leaves where they are few, by its own limit, and shuffles otherwise.
    found = stored(
        lines.join(leaves, "leaf").select(
            "doc", "seen", "pos", "leaf", "wide", "body", F.md5(F.col("body").cast("binary")).alias("line")
        ),
        "lines",
    )
    key = ["leaf", "line", "wide", "body"]
    distinct = found.select(*key, "seen").distinct().groupBy(*key).agg(F.count("*").alias("docs"))
    distinct = stored(distinct.where(F.col("wide") | (F.col("docs") >= min_texts)), "distinct")
    parsed = distinct.where("wide").select("leaf", "line", "docs", F.posexplode(F.transform(F.split("body", " "), masked)).alias("at", "token"))
    agreed = parsed.where(F.col("token") != WILD).groupBy("leaf", "at", "token").agg(F.sum("docs").alias("lines"))
    agreed = agreed.where(F.col("lines") >= min_docs).select("leaf", "at", "token", F.lit(True).alias("fixed"))
    general = parsed.join(agreed, ["leaf", "at", "token"], "left")
    field = F.when(F.col("fixed"), F.col("token")).otherwise(F.lit(WILD))
    templates = (
        general.groupBy("leaf", "line")
        .agg(
            F.bit_xor(F.xxhash64("at", field)).alias("fields"),
            F.count("fixed").alias("n_fixed"),
            F.count("*").alias("n"),
        )
        .where(100 * F.col("n_fixed") >= FIXED_PERCENT * F.col("n"))
        .select("leaf", "line", "fields")
    )
    same = distinct.select("leaf", "line", (F.col("docs") >= min_texts).alias("same"))
    kinds = same.join(templates, ["leaf", "line"], "left").where(F.col("same") | F.col("fields").isNotNull())
    named = stored(found.select("doc", "seen", "pos", "leaf", "line").join(stored(kinds, "templates"), ["leaf", "line"]), "named")
    counts = named.where("fields IS NOT NULL").select("leaf", "fields", "seen").distinct().groupBy("leaf", "fields")
    common = counts.agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs).select("leaf", "fields", F.lit(True).alias("common"))
    dropped = named.join(stored(common, "common"), ["leaf", "fields"], "left").where(F.col("same") | F.col("common"))
    dropped = dropped.groupBy("doc", "seen").agg(F.collect_set("pos").alias("gone"))
    dropped = stored(dropped.withColumnsRenamed({"doc": "in_doc", "seen": "in_seen"}), "dropped")
    out = source.join(dropped, F.col("doc").eqNullSafe(F.col("in_doc")) & (F.col("seen") == F.col("in_seen")), "left")
    every = F.split("text", "\n", -1)
    left = F.filter(every, lambda line, i: ~F.coalesce(F.array_contains("gone", i), F.lit(False)))
    return out.select(
        F.col("doc").alias(id_col),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(every)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias(text_col),
    )
