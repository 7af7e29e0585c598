"""Document fingerprints: 64-bit SimHash of weighted terms, and all documents within a Hamming radius.

A term is a shingle of words (lower case, split at white space); its weight is how often the text has it. Each term's
64-bit hash votes with its weight on every bit, and the majority gives the fingerprint. `likeness` of two fingerprints
is the share of equal bits. `hamming.matches` finds all fingerprints within a radius through permuted block tables; the
report asks it for every row whose id is divisible by ASKED, against all rows.

Defined results: a null text counts as empty, and a text without words has the fingerprint zero. Repeated rows and ids
give a result row each. An empty table gives an empty result. Other columns are ignored, whatever their names. Texts of
any length are used whole. In an order by id, null ids come first and rows with equal ids follow by their texts' hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import hamming, simhash
from tidemark.llm.common import forget, words, written

TERM_WORDS = 3
WORD = r"\S+"
#: Rows that share a bucket of the order by id.
BUCKET_ROWS = 2000
#: Ranges of ids between quantiles; each is cut evenly into as many buckets as its rows need.
RANGES = 64
#: The report searches near fingerprints of rows whose id this divides, within so many bits.
ASKED, RADIUS = 100, 3


def likeness(a: Column, b: Column) -> Column:
    return F.lit(1.0) - simhash.distance(a, b) / F.lit(64.0)


def votes(rows: DataFrame, keys: list[str], text: str = "text", size: int = TERM_WORDS) -> DataFrame:
    """`keys` and `fp`: the fingerprint of each group of equal `keys` (which name one text), and `copies`."""
    split = rows.select(*keys, words(F.lower(F.coalesce(F.col(text), F.lit(""))), WORD).alias("_w"))
    terms = simhash.term_rows(split, keys, "_w", size)
    h = F.when(F.size("_w") > 0, F.xxhash64(*simhash.shingle("_w", size))).otherwise(F.lit(0).cast("long"))
    first = F.sum((F.col("_i") == 0).cast("long")).alias("copies")
    sums = terms.select(*keys, "_i", h.alias("_h")).groupBy(*keys).agg(F.count("*").alias("_n"), first, *simhash.vote_sums(F.col("_h")))
    return sums.select(*keys, simhash.majority(F.col("_n")).alias("fp"), "copies")


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = TERM_WORDS) -> DataFrame:
    """(id_col, fp, fingerprint) for each row."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("text_hash"), "text")
    out = votes(rows, ["id", "text_hash"], size=size)
    out = out.select("id", "fp", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return out.select(F.col("id").alias(id_col), "fp", simhash.hex16(F.col("fp")).alias("fingerprint"))


def within(fps: DataFrame, queries: DataFrame, radius: int = 3, id_col: str = "doc_id") -> DataFrame:
    """(query_id, id, distance): for each row of `queries` all rows of `fps` within `radius`, itself included.

    Search runs over different fingerprints; rows come in by two joins, which expand the classes that were asked for.
    """
    found = hamming.matches(queries, fps, radius)
    asked = queries.select(F.col(id_col).alias("query_id"), F.col("fp").alias("query"))
    return asked.join(found, "query").join(fps.select("fp", F.col(id_col).alias("id")), "fp").select("query_id", "id", "distance")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int = RANGES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(id, h, text, next_id, next_h, next_text): each row beside the next in ascending id; after the last, the first.

    No global sort in one task: rows go once to buckets of neighbouring ids and are sorted there; the last row of each
    bucket then meets the first of the next bucket that has any. The driver gets `ranges` quantiles, nothing that grows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    marks = [i / ranges for i in range(1, ranges)]
    seen = rows.agg(F.count("*"), F.min("id"), F.max("id"), F.percentile_approx("id", marks, 10_000)).first()
    total, low, high = seen[0], seen[1] or 0, seen[2] or 0
    cuts = sorted({low, *(seen[3] or [])})
    cells = max(1, -(-total // (len(cuts) * bucket_rows)))

    def bucket(i: Column) -> Column:
        i = F.coalesce(i, F.lit(low))
        edges = F.array(*[F.lit(c).cast("long") for c in [*cuts, high + 1]])
        q = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c <= i)) - 1
        start, end = F.get(edges, q), F.get(edges, q + 1)
        cell = F.floor((i - start).cast("double") * cells / (end - start))
        return (q * cells + F.least(cell, F.lit(cells - 1))).cast("long")

    rows = rows.select(bucket(F.col("id")).alias("bucket"), "id", F.xxhash64("text").alias("h"), "text")
    order = Window.partitionBy("bucket").orderBy("id", "h")
    ahead = [F.lead(c).over(order).alias(f"next_{c}") for c in ("id", "h", "text")]
    placed = rows.select("*", F.row_number().over(order).alias("place"), F.lead(F.lit(1)).over(order).alias("more"), *ahead)
    inner = placed.where(F.col("more").isNotNull())
    last = placed.where(F.col("more").isNull()).select("bucket", "id", "h", "text")
    head = placed.where(F.col("place") == 1).select("bucket", *[F.col(c).alias(f"next_{c}") for c in ("id", "h", "text")])

    used = rows.select("bucket").distinct().withColumn("q", F.floor(F.col("bucket") / cells).cast("int"))
    firsts = sorted((r[0], r[1]) for r in used.groupBy("q").agg(F.min("bucket")).collect())  # at most `ranges` rows
    after = {q: firsts[(k + 1) % len(firsts)][1] for k, (q, _) in enumerate(firsts)}
    then = F.lead("bucket").over(Window.partitionBy("q").orderBy("bucket"))
    jump = F.create_map(*[x for q, b in after.items() for x in (F.lit(q), F.lit(b))]) if after else F.lit(None).cast("map<int,bigint>")
    follows = used.select("bucket", F.coalesce(then, jump[F.col("q")]).alias("to"))
    last = last.join(follows, "bucket").join(head.withColumnRenamed("bucket", "to"), "to")
    columns = ["id", "h", "text", "next_id", "next_h", "next_text"]
    return inner.select(*columns).unionByName(last.select(*columns))


def edited_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = TERM_WORDS) -> DataFrame:
    """For each row its fingerprint beside that of an edited text and of the next document; and, if ASKED divides its id,
    `n_near`: the number of other rows whose fingerprints are within RADIUS bits of its own (else null).

    The edited text has its last floor(n/2) code points replaced by as many (or all) of the next document's first.
    """
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    pairs = with_next(docs, id_col, text_col)
    pairs = pairs.select("id", "h", "next_id", "next_h", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    keys = ["id", "h", "next_id", "next_h", "n_chars", "sha"]
    pairs = pairs.select("id", "h", "next_id", "next_h", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("sha"), F.explode(F.array(F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("t")), F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("t")))).alias("v"))
    fps = votes(pairs.select(*keys, "v.is_edited", F.col("v.t").alias("text")), [*keys, "is_edited"], size=size)
    both = fps.groupBy(*keys).agg(
        F.max(F.when(~F.col("is_edited"), F.col("fp"))).alias("fp"), F.max(F.when(F.col("is_edited"), F.col("fp"))).alias("edited_fp"), F.max("copies").alias("copies")
    )
    both = written(both, "fingerprints")  # read again below: as the neighbour's next and by the search
    classes = both.groupBy("fp").agg(F.sum("copies").alias("rows"))
    found = hamming.matches(both.where(F.col("id") % ASKED == 0), classes, RADIUS)
    near = found.join(classes, "fp").groupBy(F.col("query").alias("fp")).agg((F.sum("rows") - 1).alias("n_near"))
    other = both.select(F.col("id").alias("o_id"), F.col("h").alias("o_h"), F.col("fp").alias("o_fp")).distinct()
    out = both.join(near, "fp", "left").join(other, F.col("next_id").eqNullSafe(F.col("o_id")) & (F.col("next_h") == F.col("o_h")))
    out = out.select("*", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    out = out.select(
        F.col("id").alias(id_col), "n_chars", F.col("sha").alias("edited_sha256"),
        simhash.hex16(F.col("fp")).alias("fingerprint"), simhash.hex16(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("o_fp")).alias("near_next"),
        F.when(F.col("id") % ASKED == 0, F.col("n_near")).alias("n_near"),
    )
    out = written(out, "fingerprint-report")
    forget(both)
    return out
