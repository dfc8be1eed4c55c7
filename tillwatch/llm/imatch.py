"""I-Match fingerprints over randomised lexicons, in DataFrame operations only.

The lexicon holds the terms whose inverse document frequency lies in a band. A text's fingerprint is made
of its distinct lexicon terms in sorted order, hashed once per randomised subset of the lexicon. Subsets come in
levels: at level l each of the ``SUBSETS`` subsets holds a share of 1 / (SUBSETS * 4^l) of the lexicon. A
text uses the level at which a subset holds about one of its terms, and the one above it, so that texts of
any length keep some hashes when a part of them is edited. The likeness of two fingerprints is the share of
equal hashes among the subsets that either text uses, at the coarser of their two levels.

A text of which less than a quarter of the terms are in the lexicon (one that a large part of the rows copy, say)
has a second part in its fingerprint, made in the same way of all its terms. Where both texts have one,
these parts are compared, for a few lexicon terms say little about such texts.

Terms are 64-bit hashes of the lowered runs between white space and punctuation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillwatch.llm.common import written

SUBSETS = 32
#: Stands in every text, so that a text without lexicon terms keeps its row; it is no term.
_MARK = 0
#: Texts whose lexicon terms are fewer than one in so many of their terms are also hashed over all terms.
FEW = 4
#: Lexicons of more terms are joined by shuffling.
BROADCAST_TERMS = 2_000_000


def distinct_terms(text: Column) -> Column:
    """The distinct lowered words of a text, an empty one among them where the text begins or ends with a break."""
    return F.array_distinct(F.split(F.lower(text), r"[\s\p{Punct}]+"))


def lexicon(docs: DataFrame, text: str, low: float, high: float) -> DataFrame:
    """(term): hashes of the terms that at least ``low`` and at most ``high`` of the documents hold.

    At least two documents have to hold a term. As the documents' distinct terms sum up to at least low * N
    per lexicon term, the lexicon has at most (mean distinct terms per document) / low entries, whatever N.
    """
    n = docs.count()
    terms = docs.select(F.explode(distinct_terms(F.col(text))).alias("word")).where("word <> ''")
    counts = terms.select(F.xxhash64("word").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    band = counts.where((F.col("df") >= max(2, low * n)) & (F.col("df") <= max(2, high * n)) & (F.col("term") != _MARK))
    return written(band.select("term"), "lexicon")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def subset_hashes(terms: Column, size: Column) -> Column:
    """One short hash per subset, '-' for a subset without terms; ``terms`` is sorted."""

    def each(inside: Column) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda s: let(
            F.filter(inside, lambda t: F.pmod(t, size) == s),
            lambda part: F.when(F.size(part) == 0, F.lit("-")).otherwise(
                F.lpad(F.lower(F.hex(F.pmod(F.xxhash64(part), F.lit(65536)))), 4, "0")))), ".")

    return let(F.filter(terms, lambda t: F.pmod(t, size) < SUBSETS), each)


def level_of(size: Column) -> Column:
    """The level at which a subset holds about one of ``size`` terms."""
    return F.greatest(F.lit(0.0), F.ceil(F.log2(F.greatest(size, F.lit(1)) / F.lit(2.0 * SUBSETS)) / 2)).cast("int")


def share_of(level: Column) -> Column:
    """Into how many parts the terms are divided at a level; the first ``SUBSETS`` of them are the subsets."""
    return (F.lit(SUBSETS) * F.pow(F.lit(4.0), level)).cast("long")


def two_levels(terms: Column, level: Column) -> Column:
    """level|hashes at the level|hashes at the next."""
    return let(share_of(level), lambda size: F.concat_ws(
        "|", level.cast("string"), subset_hashes(terms, size), subset_hashes(terms, size * 4)))


def used_terms(words: Column) -> Column:
    """(size, level, terms, whole) of all terms of a text: of the terms only those that fall into a subset."""
    hashed = F.array_sort(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))
    return let(hashed, lambda every: let(level_of(F.size(every)), lambda level: let(share_of(level), lambda size: F.struct(
        F.size(every).alias("size"), level.alias("level"), F.filter(every, lambda t: F.pmod(t, size) < SUBSETS).alias("terms"),
        F.xxhash64(every).alias("whole")))))


def fingerprint(terms: Column, every: Column) -> Column:
    """The text's lexicon terms in two levels, or w|hash of all terms; ~ and all terms in two levels where few are in the lexicon."""
    known = F.when(F.size(terms) == 0, F.concat(F.lit("w|"), F.hex(every["whole"]))).otherwise(
        let(terms, lambda own: let(level_of(F.size(own)), lambda level: two_levels(own, level))))
    few = F.size(terms) * FEW < every["size"]
    return F.when(few, F.concat(known, F.lit("~"), let(every, lambda e: two_levels(e["terms"], e["level"])))).otherwise(known)


def likeness(one: Column, other: Column) -> Column:
    """0 to 1; 1 for equal fingerprints, 0 where one is missing or the levels are further than one apart."""

    def compared(a: Column, b: Column) -> Column:
        words = (F.element_at(a, 1) == "w") | (F.element_at(b, 1) == "w")
        la, lb = (F.when(words, F.lit(0)).otherwise(F.element_at(x, 1).try_cast("int")) for x in (a, b))
        top = F.greatest(la, lb)

        def hashes(parts: Column, level: Column) -> Column:
            return F.split(F.try_element_at(parts, (top - level + 2).cast("int")), r"\.")

        counted = let(F.zip_with(hashes(a, la), hashes(b, lb), lambda x, y: F.when((x == "-") & (y == "-"), F.lit(0)).when(x == y, F.lit(2)).otherwise(F.lit(1))),
                      lambda pairs: F.size(F.filter(pairs, lambda p: p == 2)) / F.nullif(F.size(F.filter(pairs, lambda p: p > 0)), F.lit(0)))
        return F.when(words | (F.abs(la - lb) > 1), 0.0).otherwise(F.coalesce(counted, F.lit(0.0)))

    def part(print_: Column, n: int) -> Column:
        return F.split(F.split_part(print_, F.lit("~"), F.lit(n)), r"\|")

    both = one.contains("~") & other.contains("~")
    sides = F.when(both, F.array(part(one, 2), part(other, 2))).otherwise(F.array(part(one, 1), part(other, 1)))
    return F.when(one.isNull() | other.isNull(), 0.0).when(one == other, 1.0).otherwise(
        let(sides, lambda s: compared(s[0], s[1]))).cast("double")


def neighbours(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, bool]:
    """(id, n, next_id) for each distinct id, the next in descending order (after the last: the first).

    Ids are dealt out by ranges and ordered within each; only one row per range meets in one place. Also
    says whether ids repeat.
    """
    ids = docs.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        F.max(F.char_length(text)).alias("n"), F.count("*").alias("rows"))
    ranged = written(ids.repartitionByRange(F.col("id").desc()).withColumn("part", F.spark_partition_id()), "ids")
    parts = ranged.groupBy("part").agg(F.max("id").alias("top"))
    following = parts.select("part", F.lead("top").over(Window.orderBy(F.col("top").desc())).alias("after"))
    first, repeats = ranged.agg(F.max("id"), F.max("rows")).first()
    inner = ranged.withColumn("own_next", F.lead("id").over(Window.partitionBy("part").orderBy(F.col("id").desc())))
    joined = inner.join(F.broadcast(following), "part", "left")  # as many rows as there are ranges
    return joined.select("id", "n", F.coalesce("own_next", "after", F.lit(first)).alias("next_id")), (repeats or 0) > 1


def edit(text: Column, start: Column) -> Column:
    """The text with its last third replaced by the first as many characters of ``start`` (or all of them)."""
    n = F.char_length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - third), F.substring(F.coalesce(start, F.lit("")), F.lit(1), third))


def edited_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(row, key, text, edited, next_id) of the rows with an id: each text and its edited form.

    Both joins read the same shuffle of the texts; of the next text only the part that is needed moves again.
    """
    links, repeats = neighbours(docs, key, text)
    links = written(links, "next-ids")
    before = links.select(F.col("next_id").alias("id"), F.col("id").alias("for_id"), F.floor(F.col("n") / 3).cast("int").alias("taken"))
    own = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(text).alias("text"))
    starts = own.join(before, "id").select("for_id", F.substring(F.col("text"), F.lit(1), F.col("taken")).alias("start"))
    if repeats:  # of several texts of one id the first in order
        starts = starts.groupBy("for_id").agg(F.min("start").alias("start"))
    rows = own.join(links.select("id", "next_id"), "id").join(starts, F.col("id") == F.col("for_id"), "left")
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col("id").alias(key), "text",
                       edit(F.col("text"), F.col("start")).alias("edited"), "next_id")


def fingerprints(rows: DataFrame, terms: DataFrame, key: str, texts: tuple[str, ...]) -> DataFrame:
    """``rows`` without its texts, with a fingerprint column ``fp_<name>`` for each of them.

    Rows are told apart by (key, row); where they already lie by key, nothing is shuffled but, if at all,
    the lexicon.
    """
    small = terms.count() <= BROADCAST_TERMS
    known = terms.unionByName(terms.sparkSession.range(1).select(F.lit(_MARK).cast("long").alias("term")))
    kept = [F.col(c) for c in rows.columns if c not in texts]
    versions = F.array(*[F.struct(F.lit(n).alias("version"), distinct_terms(F.col(t)).alias("words")) for n, t in enumerate(texts)])
    each = rows.select(*kept, F.explode(versions).alias("v"))
    # what is made of all words is made before they are exploded, and travels with the mark alone
    each = each.select(*kept, "v.version", "v.words", used_terms(F.col("v.words")).alias("every"))
    each = each.select(*kept, "version", "every", F.explode(F.concat("words", F.array(F.lit(None)))).alias("word"))
    marked = F.col("word").isNull()
    found = each.where(marked | (F.col("word") != "")).withColumns({
        "term": F.when(marked, F.lit(_MARK)).otherwise(F.xxhash64("word")), "every": F.when(marked, F.col("every"))}).drop("word")
    found = found.join(F.broadcast(known) if small else known, "term")
    names = [c for c in rows.columns if c not in texts]
    sets = found.groupBy(*names, "version").agg(
        F.array_sort(F.collect_list("term")).alias("terms"), F.first("every", ignorenulls=True).alias("every"))
    made = sets.select(*names, "version", fingerprint(F.array_remove("terms", F.lit(_MARK).cast("long")), F.col("every")).alias("fp"))
    return made.groupBy(*names).agg(*[F.max(F.when(F.col("version") == n, F.col("fp"))).alias(f"fp_{t}") for n, t in enumerate(texts)])


def compare(docs: DataFrame, key: str = "doc_id", text: str = "text", low: float = 0.0005, high: float = 0.1) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are to each other and the next.

    Returns (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). Null texts
    count as empty. The next document is that of the next smaller id (of the smallest: the largest id); of an
    id with several texts the neighbours see the start that sorts first and the fingerprint that sorts
    first. Rows without id have an empty next document. Repeated rows each have their row.
    """
    docs = docs.select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    terms = lexicon(docs, "text", low, high)

    def printed(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns({
            "n_chars": F.char_length("text").cast(T.LongType()), "edited_sha256": F.sha2(F.col("edited").cast("binary"), 256)})
        return written(fingerprints(rows, terms, key, ("text", "edited")), "fingerprints")

    made = printed(edited_texts(docs, key, "text"))
    lost = docs.where(F.col(key).isNull())
    if not lost.isEmpty():
        made = made.unionByName(printed(lost.select(
            F.monotonically_increasing_id().alias("row"), key, "text", edit(F.col("text"), F.lit("")).alias("edited"),
            F.lit(None).cast(docs.schema[key].dataType).alias("next_id"))))
    following = made.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("next_id")).agg(F.min("fp_text").alias("fp_next"))
    return made.join(following, "next_id", "left").select(
        key, "n_chars", "edited_sha256", F.col("fp_text").alias("fingerprint"), F.col("fp_edited").alias("edited_fingerprint"),
        likeness(F.col("fp_text"), F.col("fp_edited")).alias("near_edited"),
        likeness(F.col("fp_text"), F.col("fp_next")).alias("near_next"))
