"""Line dedup by a log-template tree. DataFrame operations only.

A line's tokens are what stands between white space; a token with a digit is a variable field. The tree has fixed depth: token count,
then ``DEPTH`` leading tokens. Two kinds of templates come from a leaf:

* a line itself, fields made variable;
* the leaf's pattern: a token stays where most of the leaf's document lines have it, other places are variable. A line belongs to
  it if at least ``SIMILAR`` of its tokens stand in the pattern.

A template recurs if at least ``MIN_DOCS`` different documents have it. Its lines are dropped everywhere but in its first document
(smallest id), so that what many documents share is kept once. A line of at least ``LONG`` tokens recurs by itself, fields and all,
from ``LONG_DOCS`` documents on: so long a line isn't equal by chance, a short or generalised one may be.

Equal lines are counted before anything is compared, so a very frequent line is one row. Blank lines are kept.

Defined cases: a null text has no lines and stays null; an empty text has one blank line; ids that are null are told apart by
their text; repeated rows are one document and keep or lose the same lines; extra columns, whatever their names, pass
through ``dedup_lines``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import cut, discard, light, stored

DEPTH, MIN_DOCS, SIMILAR = 3, 10, 0.7
LONG, LONG_DOCS = 50, 2
#: Most fixed tokens of patterns that are broadcast to the lines of their leaves.
FIXED_TOKENS = 500_000
SPACE = r"[\x20\x09-\x0D]+"


def _lines(docs: DataFrame) -> DataFrame:
    """Every line that isn't blank: doc, key, line_no, exact (hash of a long line), tokens, fields made variable."""
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    doc = F.coalesce(F.col("doc_id").cast("long"), key)
    lines = docs.where("text IS NOT NULL").select(doc.alias("doc"), key.alias("key"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    text = F.regexp_replace(F.btrim("line", F.lit(" \t\n\x0b\f\r")), SPACE, " ")
    exact = F.when(F.regexp_count(text, F.lit(" ")) >= LONG - 1, F.xxhash64(F.lit(2), text))
    text = F.when(F.col("line").rlike("[0-9]"), F.regexp_replace(text, r"[^ ]*[0-9][^ ]*", "<*>")).otherwise(text)
    return lines.select("doc", "key", "line_no", exact.alias("exact"), F.split(text, " ").alias("tokens"))


def _addresses(lines: DataFrame, depth: int) -> DataFrame:
    """Leaf and line hash of each line."""
    leaf = F.xxhash64(F.size("tokens"), F.slice("tokens", 1, depth))
    return lines.withColumns({"leaf": leaf, "hash": F.xxhash64(F.lit(1), "tokens")})


def recurring(docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, similar: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """All lines (doc, key, line_no, exact, leaf, hash) and those that recur (leaf, hash, first)."""
    lines = stored(_addresses(_lines(docs), depth).drop("tokens"), "lines")
    each = lines.groupBy("leaf", "hash").agg(F.count_distinct("doc").alias("n"), F.min("doc").alias("first"))
    each = stored(each, "line-counts")
    leaves = each.groupBy("leaf").agg(F.sum("n").alias("total"), F.count("*").alias("variants")).where((F.col("total") >= min_docs) & (F.col("variants") > 1))
    leaves = cut(leaves)
    # the tokens of the lines of those leaves, each line once
    texts = _addresses(_lines(docs), depth).select("leaf", "hash", "tokens").join(light(leaves.select("leaf")), "leaf").groupBy("leaf", "hash").agg(F.first("tokens").alias("tokens"))
    variants = cut(texts.join(each, ["leaf", "hash"]).select("leaf", "hash", "tokens", "n"))
    places = variants.select("leaf", "n", F.posexplode("tokens").alias("place", "token")).groupBy("leaf", "place", "token").agg(F.sum("n").alias("n"))
    fixed = places.join(leaves, "leaf").where(F.col("n") * 2 > F.col("total")).groupBy("leaf").agg(F.map_from_entries(F.collect_list(F.struct("place", "token"))).alias("fixed"))
    same = F.size(F.filter(F.transform("tokens", lambda t, i: t == F.try_element_at("fixed", i)), lambda x: x))
    fixed = light(cut(fixed), FIXED_TOKENS, F.size("fixed"))
    members = variants.join(fixed, "leaf").where(same >= similar * F.size("tokens")).select("leaf", "hash")
    members = cut(members)
    patterns = lines.join(members, ["leaf", "hash"]).groupBy("leaf").agg(F.count_distinct("doc").alias("n"), F.min("doc").alias("first")).where(F.col("n") >= min_docs).select("leaf", F.col("first").alias("pattern_first"))
    by_pattern = members.join(light(cut(patterns)), "leaf")
    by_line = each.where(F.col("n") >= min_docs).select("leaf", "hash", "first")
    both = by_line.join(by_pattern, ["leaf", "hash"], "full_outer")
    again = cut(both.select("leaf", "hash", F.coalesce("pattern_first", "first").alias("first")))
    discard(each)
    return lines, again


def dropped_lines(docs: DataFrame, long_docs: int | None = LONG_DOCS, **options) -> DataFrame:
    """doc, key (hash of the text) and the numbers of the lines to drop, where there are any. Without ``long_docs`` long lines are
    treated like others."""
    lines, again = recurring(docs, **options)
    gone = lines.join(again, ["leaf", "hash"]).where(F.col("doc") != F.col("first")).select("doc", "key", "line_no")
    if long_docs is not None:
        whole = lines.where("exact IS NOT NULL").select("doc", "key", "line_no", "exact")
        often = whole.groupBy("exact").agg(F.count_distinct("doc").alias("n"), F.min("doc").alias("first")).where(F.col("n") >= long_docs)
        gone = gone.union(whole.join(often, "exact").where(F.col("doc") != F.col("first")).select("doc", "key", "line_no"))
    gone = cut(gone.groupBy("doc", "key").agg(F.collect_set("line_no").alias("drop")))
    discard(lines)
    return gone


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """All columns of ``docs`` in ``row``, n_lines, n_dropped and kept, the text without the dropped lines."""
    gone = dropped_lines(docs, **options)
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.coalesce(F.col("doc_id").cast("long"), key).alias("doc"), key.alias("key"))
    joined = rows.join(gone, ["doc", "key"], "left")
    lines = F.split("row.text", "\n")
    kept = F.when(F.col("drop").isNull(), F.col("row.text")).otherwise(F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("drop", i)), "\n"))
    return joined.select("row", F.coalesce(F.when(F.col("row.text").isNotNull(), F.size(lines)), F.lit(0)).alias("n_lines"), F.coalesce(F.size("drop"), F.lit(0)).alias("n_dropped"), kept.alias("kept"))


def op6_linededup(spark, sf_dir: str) -> DataFrame:
    """Lines of every document and how many recurring ones go; digest of what stays."""
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("row.doc_id").cast("long").alias("doc_id"), F.col("n_lines").cast("long"), F.greatest("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; a document of which nothing is left goes. n_chars follows the text. Long lines have no
    bound of their own here."""
    out = dedup_lines(docs, long_docs=None).where("n_dropped <= 0 OR trim(kept) <> ''")
    fields = {"text": F.col("kept"), "n_chars": F.when(F.col("n_dropped") > 0, F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*(fields[c].alias(c) if fields.get(c) is not None else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
