"""Line dedup by a tree of line templates.

A line is parsed to a fixed depth: number of words, then its LEAD first words, words with a digit being variable
(``<*>``). Below that node lines of the same template agree in all words (exact), or, from LONG words on, in all but
one of SEGMENTS equal parts of the rest: that part is the variable field. A line is dropped if a document of smaller
doc_id has a line of the same template; the first document keeps it. Lines of fewer than SHORT words always stay.

Everything is built-in functions. Lines become one narrow row of hashes each. First the nodes: minima of doc_id by
node, combined before the shuffle. Nodes seen in one document only, nearly all of them, are out; in the rest a node
with one template alone needs nothing more, and only lines of mixed nodes get their generalised keys counted. A very
common line is one group of a partial aggregate, and joins on its node can be split. What returns to a text is the
list of its own dropped lines.

Hashes: 64 bits of node and exact template; generalised keys add 32 bits to their node's 64.

Defined results: a null text has one empty line and gives an empty text; null doc_ids come after all others and never
lose a line to one another; rows of one doc_id are one document, they don't lose lines to one another; a document of
which nothing is left keeps its row with an empty text. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .store import written

LEAD = 6
SEGMENTS = 4
LONG = 10
SHORT = 3
BLANKS = r"[\x20\x09-\x0D]+"
#: A word with a digit.
VARIABLE = r"[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
LAST = (1 << 63) - 1


def words_of(line: Column) -> Column:
    """Lower-case words, variable ones generalised."""
    low = F.lower(line)
    return F.array_remove(F.split(F.when(low.rlike("[0-9]"), F.regexp_replace(low, VARIABLE, "<*>")).otherwise(low), BLANKS), "")


def line_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per line of SHORT words or more: ``doc`` (null ids last), ``place`` (line number and hash of the text), hashes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.hash(text).alias("h"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    words = lines.select("doc", F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col("h").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("place"), words_of(F.col("line")).alias("w"))
    words = words.withColumn("n", F.size("w")).where(F.col("n") >= SHORT)
    w, n = F.col("w"), F.col("n")
    rest = n - LEAD

    def without(k: int) -> Column:
        start, stop = F.floor(rest * k / SEGMENTS).cast("int"), F.floor(rest * (k + 1) / SEGMENTS).cast("int")
        return F.hash(F.slice(w, LEAD + 1, start), F.slice(w, stop + (LEAD + 1), rest - stop)).cast("long")

    def two(a: Column, b: Column) -> Column:
        return F.when(n >= LONG, F.shiftleft(a, 32).bitwiseOR(b.bitwiseAND(F.lit(0xFFFFFFFF))))

    return words.select("doc", "place", F.xxhash64(n, F.slice(w, 1, LEAD)).alias("node"), F.xxhash64(w).alias("exact"), two(without(0), without(1)).alias("g01"), two(without(2), without(3)).alias("g23"))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, place`` of the lines whose template an earlier document has."""
    lines = written(line_rows(docs, id_col, text_col), "lines")
    # Nodes of more than one document, with their first one, and whether all their lines are alike.
    nodes = lines.groupBy("node").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.min("exact").alias("e0"), F.max("exact").alias("e1")).where("first < last").select("node", "first", (F.col("e0") == F.col("e1")).alias("alike"))
    shared = written(lines.join(nodes, "node"), "shared-lines")
    plain = shared.where("alike and doc > first").select("doc", "place")
    mixed = shared.where("not alike").select("doc", "place", "node", "exact", "g01", "g23")
    low = F.lit(0xFFFFFFFF)
    # The exact template under 0, the generalised ones under 1 to 4 for long lines.
    keys = F.array(F.struct(F.lit(0).alias("k"), F.col("exact").alias("h")), *[F.struct(F.lit(k + 1).alias("k"), F.when(F.lit(k % 2 == 0), F.shiftright(F.col(g), 32)).otherwise(F.col(g).bitwiseAND(low)).alias("h")) for k, g in enumerate(("g01", "g01", "g23", "g23"))])
    each = mixed.select("doc", "place", "node", F.inline(keys)).where("h is not null")
    first = each.groupBy("node", "k", "h").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").drop("last")
    general = each.join(first, ["node", "k", "h"]).where("doc > first").select("doc", "place").distinct()
    return plain.unionByName(general)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str = "_lines") -> DataFrame:
    """``docs`` with the text less its dropped lines, and a struct ``count_col`` (all, dropped) as the last column, in place of one of that name."""
    gone = dropped_lines(docs, id_col, text_col).select("doc", F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).alias("h"), F.shiftright("place", 32).cast("int").alias("pos"))
    gone = gone.groupBy("doc", "h").agg(F.collect_set("pos").alias("_gone")).withColumnsRenamed({"doc": "_gone_doc", "h": "_gone_h"})
    text = F.coalesce(F.col("_text"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("_row") if len(docs.columns) > 1 else F.lit(0).alias("_row"), F.col(text_col).alias("_text"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("_doc"))
    both = rows.withColumn("_h", F.hash(text).cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).join(gone, (F.col("_doc") == F.col("_gone_doc")) & (F.col("_h") == F.col("_gone_h")), "left")
    lines = both.withColumn("_all", F.split(text, "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_all") - 1), "_gone")
    left = F.when(F.col("_gone").isNull(), text).otherwise(F.array_join(F.transform(kept, lambda i: F.get("_all", i)), "\n"))
    done = lines.select("_row", left.alias("_left"), F.struct(F.size("_all").alias("all"), F.coalesce(F.size("_gone"), F.lit(0)).alias("dropped")).alias("_lines"))
    return done.select(*[F.col("_left").alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c != count_col], F.col("_lines").alias(count_col))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The documents with what is left of their texts; those that lost all their words go. ``chars_col`` follows the text."""
    counts = "_lines"
    while counts in docs.columns:
        counts += "_"
    out = dedup_lines(docs, id_col, text_col, counts)
    out = out.where((F.col(f"{counts}.dropped") == 0) | F.col(text_col).rlike(r"[^\x20\x09-\x0D]")).drop(counts)
    if chars_col in docs.columns:
        out = out.withColumn(chars_col, F.length(text_col).cast(docs.schema[chars_col].dataType))
    return out


#: The same in SQL, by strings in place of hashes; for tables without null or repeated ids.
ORACLE = r"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS pos FROM docs),
parsed AS (
  SELECT doc_id, pos, line,
         list_filter(regexp_split_to_array(regexp_replace(lower(line), '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM lines),
sized AS (SELECT doc_id, pos, w, len(w) AS n FROM parsed WHERE len(w) >= 3),
keys AS (
  SELECT doc_id, pos, n, -1 AS k, w AS key FROM sized
  UNION ALL
  SELECT doc_id, pos, n, s.k, list_concat(w[1:6 + ((n - 6) * s.k) // 4], w[7 + ((n - 6) * (s.k + 1)) // 4:n]) AS key
  FROM sized, (SELECT unnest(range(0, 4)) AS k) s WHERE n >= 10),
firsts AS (SELECT n, k, key, min(doc_id) AS first FROM keys GROUP BY n, k, key),
gone AS (SELECT DISTINCT doc_id, pos FROM keys JOIN firsts USING (n, k, key) WHERE doc_id > first),
marked AS (SELECT l.doc_id, l.pos, l.line, g.pos IS NOT NULL AS lost FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos)
SELECT doc_id, count(*)::INT AS n_lines, count(*) FILTER (WHERE lost)::INT AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '') AS text
FROM marked GROUP BY doc_id
"""
