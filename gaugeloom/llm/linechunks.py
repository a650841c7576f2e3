"""Global removal of repeated line chunks with content-defined boundaries.

A text is cut into lines and the lines into chunks. A chunk ends after a line where the rolling hash over the hashes of the
last two lines falls into a fixed share of its range, so lines put in or taken out move boundaries only nearby. A line of more than
``LONG_WORDS`` words (counted by spaces) always is a chunk of its own. Chunks of at least two lines, and long
lines, that stand at several places of the corpus stay only at the first (smallest doc_id, then earliest line).

The pipeline's stage also takes *runs*: lines that follow each other (blank ones are passed over), have more than ``LONG_WORDS`` words
together and stand at an earlier place. From each line, forwards and backwards, the fewest lines of so many words are one piece; equal runs
have equal pieces, and the pieces inside a run cover it from its first line to its last, wherever chunks end. Only lines that stand
at several places are put in pieces. A piece that overlaps its own first place stays. A text
of several lines that equals an earlier one, blank lines aside, goes as a whole, however short. ``op9`` removes chunks alone, as its SQL does.

Everything is built-in functions. Hashes only pick the candidates; two chunks are taken for equal when their bytes are, as they meet
in a join on the text itself; two pieces of a run, when the SHA-256 digests of their lines are. Only candidates' texts are shuffled for it. The first place is an aggregate, so a chunk that
a third of all documents share is no burden to any task.

Defined cases: a null text stays null, and has no lines. Blank chunks (spaces and line ends only) are never removed. A text whose chunks all
go becomes empty. Rows with the same doc_id and text count as one document and are treated alike; a null doc_id counts as larger than
every other. Other columns pass through;
n_lines and n_removed replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeloom.llm.common import keep, load, query

#: A boundary follows where the first hexadecimal digit of the rolling hash is at most this: 5 of 16.
CUT_DIGIT = "4"
MIN_LINES, LONG_WORDS = 2, 50
#: At 16 bytes each, some 32 MB: up to it the repeated hashes are sent to every executor, more are joined by shuffle.
BROADCAST_HASHES = 2_000_000


def chunk_structs(text: Column) -> Column:
    """Array of (start, stop, words) of a text's chunks, by line numbers from 0, ``stop`` not included. Expects column ``_lines``."""
    lines, hashes, long = F.col("_lines"), F.col("_hashes"), F.col("_long")

    def ends(i):
        rolled = F.md5(F.concat(F.when(i > 0, F.element_at(hashes, F.greatest(i, F.lit(1)))).otherwise(F.lit("")), F.element_at(hashes, i + 1)))
        last = i == F.size(lines) - 1
        following = F.element_at(long, F.least(i + 2, F.size(lines)))
        return last | F.element_at(long, i + 1) | following | (F.substring(rolled, 1, 1) <= CUT_DIGIT)

    return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), ends)


def _chunks(docs: DataFrame) -> DataFrame:
    """Rows (_id, _key, start, stop) of the chunks that may be removed, with their text."""
    lined = docs.where("text IS NOT NULL").select(
        F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key"), F.split("text", "\n", -1).alias("_lines"))
    hashed = lined.select(
        "*", F.transform("_lines", F.md5).alias("_hashes"),
        F.transform("_lines", lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) >= LONG_WORDS).alias("_long"))
    cut = hashed.select("*", chunk_structs(F.col("_lines")).alias("_ends"))
    spans = F.transform("_ends", lambda e, i: F.struct(
        F.when(i > 0, F.element_at("_ends", F.greatest(i, F.lit(1))) + 1).otherwise(0).alias("start"), (e + 1).alias("stop")))
    fit = F.filter(spans, lambda c: (c["stop"] - c["start"] >= MIN_LINES) | F.element_at("_long", c["start"] + 1))
    texts = F.transform(fit, lambda c: F.struct(c["start"].alias("start"), c["stop"].alias("stop"),
                                                F.array_join(F.slice("_lines", c["start"] + 1, c["stop"] - c["start"]), "\n").alias("chunk")))
    rows = cut.select("_id", "_key", F.explode(texts).alias("c")).select("_id", "_key", "c.start", "c.stop", "c.chunk")
    return rows.where(F.trim(F.replace("chunk", F.lit("\n"), F.lit(""))) != "")


def _place(prefix: str = "") -> Column:
    return F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_key").alias("key"), F.col("start").alias("start"))


def _full_lines(docs: DataFrame) -> DataFrame:
    """(_id, _key, n, line, words, h, digest) of the lines that aren't blank; n counts only these, words are counted by spaces."""
    lined = docs.where("text IS NOT NULL").select(
        F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key"), F.split("text", "\n", -1).alias("_lines"))
    numbered = F.filter(F.transform("_lines", lambda x, i: F.struct(i.alias("line"), x.alias("text"))), lambda x: F.trim(x["text"]) != "")
    rows = lined.select("_id", "_key", F.posexplode(numbered).alias("n", "x")).select("_id", "_key", "n", "x.line", F.col("x.text").alias("_line"))
    words = F.length(F.trim("_line")) - F.length(F.replace(F.trim("_line"), F.lit(" "), F.lit(""))) + 1
    return rows.select("_id", "_key", "n", "line", words.alias("words"), F.xxhash64("_line").alias("h"), F.sha2("_line", 256).alias("digest"))


def _run_pieces(docs: DataFrame) -> DataFrame:
    """(_id, _key, start, stop, h, chunk) of the shortest pieces of more than ``LONG_WORDS`` words of lines that all stand at several places."""
    lines = _full_lines(docs)
    place = F.xxhash64("_id", "_key", "n")
    common = keep(lines.groupBy("h").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("h"), "repeated_lines")
    few = common.count() <= BROADCAST_HASHES
    doc = ["_id", "_key"]
    rows = lines.join(F.broadcast(common) if few else common, "h", "left_semi").repartition(*doc).dropDuplicates([*doc, "n"])
    rows = rows.withColumn("run", F.col("n") - F.row_number().over(Window.partitionBy(*doc).orderBy("n")))
    run = Window.partitionBy(*doc, "run")
    rows = rows.withColumns({"through": F.sum("words").over(run.orderBy("n").rowsBetween(Window.unboundedPreceding, 0)), "total": F.sum("words").over(run)})
    rows = rows.where(F.col("total") > LONG_WORDS).withColumn("before", F.col("through") - F.col("words"))
    # A line has a word at least, so no piece has more than LONG_WORDS + 1 lines.
    forwards, backwards = run.orderBy("before").rangeBetween(0, LONG_WORDS), run.orderBy("through").rangeBetween(-LONG_WORDS, 0)
    pieces = [F.struct(F.min("line").over(w).alias("start"), (F.max("line").over(w) + 1).alias("stop"), F.sum("words").over(w).alias("words"),
                       F.collect_list("digest").over(w).alias("digests")) for w in (forwards, backwards)]
    rows = rows.select(*doc, *[x.alias(f"_piece{i}") for i, x in enumerate(pieces)]).select(*doc, F.explode(F.array("_piece0", "_piece1")).alias("p"))
    rows = rows.where(F.col("p.words") > LONG_WORDS).select(*doc, "p.start", "p.stop", F.sha2(F.concat_ws("", "p.digests"), 256).alias("chunk"))
    return rows.distinct().select(*doc, "start", "stop", F.xxhash64("chunk").alias("h"), "chunk")


def _whole_texts(docs: DataFrame) -> DataFrame:
    """(_id, _key, start, stop, h, chunk) of texts of at least ``MIN_LINES`` lines that aren't blank, each as one piece."""
    lined = docs.where("text IS NOT NULL").select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key"), F.split("text", "\n", -1).alias("_lines"))
    full = F.filter("_lines", lambda x: F.trim(x) != "")
    rows = lined.where(F.size(full) >= MIN_LINES).select(
        "_id", "_key", F.lit(0).alias("start"), F.size("_lines").alias("stop"), F.concat(F.lit("text "), F.sha2(F.array_join(full, "\n"), 256)).alias("chunk"))
    return rows.select("_id", "_key", "start", "stop", F.xxhash64("chunk").alias("h"), "chunk")


def _merged(spans: DataFrame) -> DataFrame:
    """Spans (_id, _key, start, stop) of a text that overlap or touch, as one."""
    order = Window.partitionBy("_id", "_key").orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = spans.withColumn("opens", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1)))
    rows = rows.withColumn("part", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("_id", "_key", "part").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("part")


def repeated_chunks(docs: DataFrame, runs: bool = False) -> DataFrame:
    """(_id, _key, start, stop) of the chunks that stand at an earlier place too; with ``runs``, of all lines that such chunks, runs and whole texts cover."""
    rows = _chunks(docs).withColumn("h", F.xxhash64("chunk"))
    # First by hash, without any text: most chunks stand at one place.
    places = keep(rows.groupBy("h").agg(F.min(_place()).alias("first"), F.max(_place()).alias("last")).where("first <> last").select("h"), "repeated")
    few = places.count() <= BROADCAST_HASHES
    likely = rows.join(F.broadcast(places) if few else places, "h", "left_semi")
    if runs:
        likely = likely.select("_id", "_key", "start", "stop", "h", "chunk").unionByName(keep(_run_pieces(docs), "run_pieces")).unionByName(_whole_texts(docs))
    # Then by the bytes: the group's key, and the join's, is the chunk itself. The first places are written, so that both
    # sides of the join are shuffles of their own and adaptive execution can split a chunk that stands everywhere.
    first = keep(likely.groupBy("h", "chunk").agg(F.min(F.struct(_place().alias("at"), "stop")).alias("first")), "first_places")
    later = likely.join(first, ["h", "chunk"]).where(_place() != F.col("first.at"))
    if not runs:
        return later.select("_id", "_key", "start", "stop").distinct()
    overlap = F.col("_id").eqNullSafe(F.col("first.at.id")) & (F.col("_key") == F.col("first.at.key")) & (F.col("start") < F.col("first.stop"))
    return _merged(later.where(~overlap).select("_id", "_key", "start", "stop"))


def remove_repeated(docs: DataFrame, runs: bool = False) -> DataFrame:
    """``docs`` with repeated chunks (and runs) cut out of the text, and n_lines and n_removed."""
    gone = repeated_chunks(docs, runs).groupBy(F.col("_id").alias("__lc_id"), F.col("_key").alias("__lc_key")).agg(F.collect_list(F.struct("start", "stop")).alias("__lc_gone"))
    keyed = docs.drop("n_lines", "n_removed").select("*", F.xxhash64("text").alias("__lc_text"))
    joined = keyed.join(gone, keyed["doc_id"].eqNullSafe(gone["__lc_id"]) & (keyed["__lc_text"] == gone["__lc_key"]), "left")
    lines = F.split("text", "\n", -1)
    left = F.filter(lines, lambda x, i: ~F.exists("__lc_gone", lambda g: (i >= g["start"]) & (i < g["stop"])))
    removed = F.coalesce(F.aggregate("__lc_gone", F.lit(0), lambda n, g: n + g["stop"] - g["start"]), F.lit(0))
    names = [c for c in keyed.columns if c != "__lc_text"]
    # Once the chunks are found, only texts that lose some are split again.
    return joined.select(*[F.when(F.col("__lc_gone").isNull(), F.col(c)).otherwise(F.array_join(left, "\n")).alias(c) if c == "text" else keyed[c] for c in names],
                         F.coalesce(F.when(F.col("text").isNotNull(), F.size(lines)), F.lit(0)).cast("bigint").alias("n_lines"), removed.cast("bigint").alias("n_removed"))


_SQL = """
WITH l AS (
  SELECT doc_id, text, CAST(i - 1 AS BIGINT) AS i, x[i] AS line, n,
         length(x[i]) - length(replace(x[i], ' ', '')) >= 50 AS long_line
  FROM (SELECT doc_id, text, string_split(text, chr(10)) AS x, len(string_split(text, chr(10))) AS n,
               unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL))),
e AS (
  SELECT *, i = n - 1 OR long_line OR coalesce(lead(long_line) OVER w, false)
            OR substr(md5(coalesce(md5(lag(line) OVER w), '') || md5(line)), 1, 1) <= '4' AS ends
  FROM l WINDOW w AS (PARTITION BY doc_id, text ORDER BY i)),
g AS (SELECT *, coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY doc_id, text ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM e),
k AS (
  SELECT doc_id, text, c, min(i) AS start, count(*) AS size, bool_or(long_line) AS long_line, string_agg(line, chr(10) ORDER BY i) AS chunk
  FROM g GROUP BY doc_id, text, c),
r AS (
  SELECT *, row_number() OVER (PARTITION BY chunk, fit ORDER BY doc_id, start) > 1 AND fit AS gone
  FROM (SELECT *, (size >= 2 OR long_line) AND trim(replace(chunk, chr(10), '')) <> '' AS fit FROM k)),
t AS (
  SELECT doc_id, text, string_agg(chunk, chr(10) ORDER BY c) FILTER (WHERE NOT gone) AS kept, sum(size) AS n_lines,
         coalesce(sum(size) FILTER (WHERE gone), 0) AS n_removed FROM r GROUP BY doc_id, text)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text,
       CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
FROM documents d LEFT JOIN t ON d.doc_id IS NOT DISTINCT FROM t.doc_id AND d.text = t.text
"""


@query("op9_line_chunks", _SQL)
def deduplicated_lines(spark, sf_dir):
    """Every document without the line chunks that an earlier place holds."""
    return remove_repeated(load(spark, sf_dir, "documents").select("doc_id", "text"))


def line_stage(spark, docs, sf_dir):
    """Documents without repeated chunks and runs; one that loses all its text goes."""
    left = remove_repeated(docs, runs=True)
    return left.where("n_removed = 0 OR trim(replace(text, chr(10), '')) <> ''").select(*docs.columns)
